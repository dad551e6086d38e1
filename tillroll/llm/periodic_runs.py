"""Periodic runs of words: seeds on diagonals, extended once.

A run is a stretch of consecutive words with smallest period q, at least 12 words and
two periods long, that no neighbouring word extends. Words i and i + q are then equal
along a diagonal, at lag q, for at least max(12 - q, q) words, and that is what every
run guarantees: a gram of 6 words twice at a lag below 12, a gram of 12 words
twice at a lag of 12 to 23, of 24 at 24 to 47, and so on. So a text's grams of 6, 12,
24, ... words are indexed until none occurs twice, each level built from pairs of the
one before, and the occurrences of a gram are paired at the lags of its level only.

A gram that overlaps itself by half or more stands in a run of a shorter period, and
its occurrences there are a progression. Pairs within one progression belong to
that shorter period; of two progressions, only pairs with a first member are seeds, as
a diagonal cannot begin inside both. That keeps the number of pairs in proportion to
the words, however often a word is repeated.

Pairs are taken in text order. A table holds, per lag, the furthest word that an
extension has covered, so that each diagonal is extended once. An extension steps
along the gram levels, from long to short, and so costs the logarithm of its length.
Every smaller period of a stretch of two periods divides its period and gives the same
stretch, so of equal stretches the one with the smallest lag is the run.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa

from tillroll.llm.common import id_and_text, numbered_words

SHORTEST = 12  # words in a run
SEED = SHORTEST // 2  # the overlap that every lag guarantees


def _numbered(values):
    """Equal values get equal numbers; the numbers, their order, how many there are."""
    order = np.argsort(values, kind="stable")
    new = np.empty(len(values), dtype=bool)
    new[:1] = True
    in_order = values[order]
    np.not_equal(in_order[1:], in_order[:-1], out=new[1:])
    numbers = np.empty(len(values), dtype=np.int64)
    numbers[order] = np.cumsum(new) - 1
    return numbers, order, int(new.sum())


def gram_levels(words):
    """(gram length, gram number at each place, places by gram, some gram occurs twice),
    for 6, 12, 24, ... words, up to the first level without a repeat."""
    n = len(words)
    if n < SHORTEST:
        return []
    base, _, kinds = _numbered(words)
    here = n - SEED + 1
    codes = base[:here]
    for k in range(1, SEED):
        codes, _, many = _numbered(codes * kinds + base[k : k + here])
    levels, size = [], SEED
    while True:
        codes, order, many = _numbered(codes)
        levels.append((size, codes, order, many < len(codes)))
        if many == len(codes) or len(codes) <= size:
            return levels
        codes = codes[:-size] * many + codes[size:]
        size *= 2


def _spread(lows, highs):
    """Owner and value of every number in the ranges [low, high)."""
    counts = np.maximum(highs - lows, 0)
    owner = np.repeat(np.arange(len(lows)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return owner, lows[owner] + np.arange(len(owner)) - first


def seed_pairs(size, codes, order):
    """Places x and lags q of equal grams at x and x + q, at the lags of this level.

    Of a progression of overlapping grams only pairs with its first member are given.
    """
    wide = len(codes) + 4 * size
    lowest = 1 if size == SEED else size
    keys = codes[order] * wide + order
    steps = np.diff(keys)  # a step to another gram is over wide - len(codes)
    first = np.concatenate([[True], steps > size // 2])
    heads = np.flatnonzero(first)
    after = np.append(heads[1:], len(keys))  # where the next progression begins
    key = keys[heads]
    # The first member before, any member of later progressions behind ...
    low = np.searchsorted(keys, key + lowest)
    if size > SEED:
        low = np.maximum(low, after)
    owner, other = _spread(low, np.searchsorted(keys, key + 2 * size))
    x, y = order[heads[owner]], order[other]
    # ... and any member of earlier progressions before, the first member behind.
    low = np.searchsorted(keys, key - 2 * size + 1)
    owner, other = _spread(low, np.searchsorted(keys, key - lowest + 1))
    x = np.concatenate([x, order[other]])
    y = np.concatenate([y, order[heads[owner]]])
    found = np.unique(x * wide + (y - x))
    return found // wide, found % wide


def _reach(words, levels, x, y):
    """How many words from x and y on are equal; x < y."""
    n, at = len(words), 0
    for size, codes, _, _ in reversed(levels):
        while y + at < len(codes) and codes[x + at] == codes[y + at]:
            at += size
    while y + at < n and words[x + at] == words[y + at]:
        at += 1
    return at


def _reach_back(words, levels, x, y):
    """How many words before x and y are equal; x < y."""
    at = 0
    for size, codes, _, _ in reversed(levels):
        while x - at >= size and codes[x - at - size] == codes[y - at - size]:
            at += size
    while x - at > 0 and words[x - at - 1] == words[y - at - 1]:
        at += 1
    return at


def find_runs(words):
    """All runs of a sequence of numbers: sorted (start, length, period)."""
    words = np.asarray(words, dtype=np.int64)
    levels = gram_levels(words)
    period = {}  # of (start, end)
    for size, codes, order, repeats in levels:
        if not repeats:
            break
        covered = {}  # lag: the furthest word that an extension at it has reached
        for x, lag in zip(*(a.tolist() for a in seed_pairs(size, codes, order)), strict=True):
            if x < covered.get(lag, 0):
                continue
            start = x - _reach_back(words, levels, x, x + lag)
            end = x + _reach(words, levels, x, x + lag)
            covered[lag] = end
            if end - start >= max(SHORTEST - lag, lag):
                stretch = (start, end + lag)
                period[stretch] = min(lag, period.get(stretch, lag))
    return sorted((s, e - s, q) for (s, e), q in period.items())


def kept_words(n, runs):
    """Which of n words stay if each run keeps its first period only."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth)[:n] == 0


def tiled(doc_id, n):
    """The reading order of the registered query: the text of one document in ten goes on
    as repeats of a block from some word on. None: the words as they stand."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _runs_of(reading, with_runs):
    fields = ["start", "length", "period", "exponent_milli"]

    def runs_of(batches):
        for batch in batches:
            vocabulary, numbers, counts = numbered_words(batch["text"])
            ends = np.cumsum(counts)
            out = {name: [] for name in ["n_runs", *fields, "runs_sha256", "collapsed_sha256"]}
            lists = []
            ids = batch["doc_id"].to_pylist()
            for doc, n, end in zip(ids, counts.tolist(), ends.tolist(), strict=True):
                words = numbers[end - n : end]
                at = reading(doc, n) if reading else None
                words = words if at is None else words[at]
                runs = find_runs(words)
                out["n_runs"].append(len(runs))
                best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
                milli = 1000 * best[1] // best[2] if runs else None
                for name, value in zip(fields, (*best, milli), strict=True):
                    out[name].append(value)
                listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
                out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
                kept = words[kept_words(n, runs)] if runs else words
                text = b" ".join([vocabulary[w] for w in kept.tolist()])
                out["collapsed_sha256"].append(hashlib.sha256(text).hexdigest())
                if with_runs:
                    names = ("start", "length", "period")
                    lists.append([dict(zip(names, run, strict=True)) for run in runs])
            arrays = {"doc_id": batch["doc_id"]}
            for name, values in out.items():
                arrays[name] = pa.array(
                    values, pa.string() if name.endswith("sha256") else pa.int64()
                )
            if with_runs:
                run = pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])
                arrays["runs"] = pa.array(lists, pa.list_(run))
            yield pa.RecordBatch.from_pydict(arrays)

    return runs_of


def periodic_runs(docs, doc_id="doc_id", text="text", reading=None, with_runs=False):
    """Per row: ``doc_id``, ``n_runs``, the longest run's ``start``, ``length``, ``period`` and
    ``exponent_milli`` (ties: smallest start, then period; NULL without a run), and
    ``runs_sha256`` and ``collapsed_sha256`` of all runs and of the words that stay if
    each run keeps its first period. ``with_runs`` adds them as ``runs``.

    ``reading(doc_id, n)`` may give the numbers of a text's n words in another order.
    NULL and empty texts have no word and no run. Rows with a NULL or repeated id are
    rows like any other, only ids and texts are read of the table, whatever else its
    columns are called, and an empty table gives no row. A text is looked at as a whole,
    however long; time and memory follow its words times the levels of grams it has.
    """
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_runs long, start long, length long, period long,"
        " exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )
    if with_runs:
        schema += ", runs array<struct<start: long, length: long, period: long>>"
    return rows.mapInArrow(_runs_of(reading, with_runs), schema)
