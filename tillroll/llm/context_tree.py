"""LM scoring by context-tree weighting over bytes.

A text is coded as one stream of bytes: its words in lower case, a space behind each,
and a line end. The context of a byte is the ``DEPTH`` bytes before it, whatever words
they belong to; before a text's first byte stand line ends. So the order of words
counts, and how they are set apart does not: texts that differ in white space alone
score alike. Every byte is eight binary choices down a tree of 255 nodes, and every node
has a context tree of its own: at each depth the Krichevsky-Trofimov estimate of the
counts seen in that context is mixed with what the deeper contexts say, half and half
before any data; the weights after the training text follow from how well each coded it.

One pass over the texts counts words, another windows, a byte with its context; both are
added up within a task first. Distinct windows grow with the corpus and are spread over the
cluster throughout. The trees are solved in buckets of windows that share the last
``TOP`` bytes of context, since trees meet only above that, and a bucket holds as many
windows as a task can take: their number follows from the number of windows. What the
nodes above come to, at most 65,536 contexts of two bytes, is solved on the driver.

A third pass scores the texts. The most common windows and words are looked up where the
text is read: words that make up a ``1 / FREQUENT``-th of all tokens or more are at most
``FREQUENT``. The rest are joined to the tables of windows and words.
"""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from tillroll.llm.common import (
    as_bytes,
    give_back,
    kept,
    numbered_words,
    slices,
    text_sizes,
    whole_text,
    written,
)

DEPTH = 6  # bytes of context
TOP = 3  # windows in a bucket share whole contexts of so many bytes
BUCKET_WINDOWS = 40_000  # about as many windows are solved at once
END = b"\n"
FREQUENT = 500_000
LONGEST_FREQUENT = 64
STREAM_AT_ONCE = 2 << 20
WORDS_AT_ONCE = 4 << 20
HELD = 2_500_000  # windows that a task counts before it hands them on
ROWS_AT_ONCE = 1 << 17  # counts of windows in a batch
WINDOWS_HELD = 3_000_000  # windows looked up where the text is read
HALF = np.log(0.5)


def lowered_words(texts):
    """The words of an Arrow text column, with A-Z lowered; see ``numbered_words``."""
    return numbered_words(pc.ascii_lower(texts))


# --- context trees ------------------------------------------------------------


def log_gamma(x):
    """The logarithm of the gamma function, for arguments of a half and more."""
    x = np.asarray(x, dtype=np.float64)
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    z = x + 8
    terms = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
    series = sum(t / z ** (2 * k + 1) for k, t in enumerate(terms))
    whole = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series
    small = x < 1e30
    return whole - np.where(small, np.log(product), 8 * np.log(x))


def log_kt(zeros, ones):
    """The block probability that the KT estimator gives to these counts."""
    return (
        log_gamma(zeros + 0.5)
        + log_gamma(ones + 0.5)
        - log_gamma(zeros + ones + 1.0)
        - np.log(np.pi)
    )


class Level:
    """The nodes of one depth: sorted keys (context, choice), counts, probabilities."""

    def __init__(self, keys, zeros, ones, below=None):
        zeros, ones = zeros.astype(np.float64), ones.astype(np.float64)
        self.keys, self.zeros, self.ones = keys, zeros, ones
        kt = log_kt(zeros, ones)
        if below is None:
            self.log_p, self.weight = kt, np.ones(len(keys))
        else:
            self.log_p = np.logaddexp(HALF + kt, HALF + below)
            self.weight = np.exp(HALF + kt - self.log_p)
        self.chance = (ones + 0.5) / (zeros + ones + 1.0)

    def find(self, keys):
        """The place of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def mix(self, given, rest):
        """Take what is mixed so far into this level: what deeper levels start from."""
        return given + rest * self.weight * self.chance, rest * (1 - self.weight)


def _up(keys, depth):
    """The keys one level up: without the farthest byte of context."""
    return keys & ((1 << 8 * depth) - 1)


def choices(grams):
    """Per window and choice: its key at full depth, and the way taken."""
    context, byte = grams >> 8, grams & 255
    steps = np.arange(8)
    nodes = (1 << steps) | (byte[:, None] >> (8 - steps))
    taken = (byte[:, None] >> (7 - steps)) & 1
    return (context[:, None] << 8) | nodes, taken.astype(bool)


def levels(grams, counts, top):
    """The levels from ``DEPTH`` up to ``top``, by depth."""
    seen = counts > 0
    keys, taken = choices(grams[seen])
    weights = np.repeat(counts[seen].astype(np.float64), 8)
    keys, which = np.unique(keys.ravel(), return_inverse=True)
    which, taken = which.ravel(), taken.ravel()
    ones = np.bincount(which, weights * taken, len(keys))
    zeros = np.bincount(which, weights * ~taken, len(keys))
    found = {DEPTH: Level(keys, zeros, ones)}
    for depth in range(DEPTH - 1, top - 1, -1):
        found[depth] = _level_above(found[depth + 1], depth)
    return found


def _level_above(level, depth):
    # One byte of choice and ``depth`` bytes of context remain.
    keys, which = np.unique(_up(level.keys, depth + 1), return_inverse=True)
    which = which.ravel()
    return Level(
        keys,
        np.bincount(which, level.zeros, len(keys)),
        np.bincount(which, level.ones, len(keys)),
        np.bincount(which, level.log_p, len(keys)),
    )


class Crown:
    """What contexts of up to two bytes leave to deeper ones: per (context, choice)."""

    def __init__(self, given, rest, keys, given_two, rest_two):
        self.given, self.rest = given, rest  # of one byte, for all bytes and choices
        self.keys, self.given_two, self.rest_two = keys, given_two, rest_two

    @classmethod
    def solve(cls, keys, zeros, ones, below):
        """From the nodes of depth 2, with what is below them summed up."""
        order = np.argsort(keys)
        two = Level(keys[order], zeros[order], ones[order], below[order])
        one = _level_above(two, 1)
        none = _level_above(one, 0)
        given, rest = np.zeros(256), np.ones(256)
        at_none = none.keys
        after = none.mix(given[at_none], rest[at_none])
        given[:], rest[:] = 0.5, 0.0  # choices never met: an even chance
        given[at_none], rest[at_none] = after
        # A byte of context never met adds nothing but an even chance for the rest.
        all_given = np.repeat((given + rest * 0.5)[None], 256, axis=0)
        all_rest = np.zeros((256, 256))
        byte, choice = one.keys >> 8, one.keys & 255
        all_given[byte, choice], all_rest[byte, choice] = one.mix(given[choice], rest[choice])
        byte, choice = two.keys >> 8 & 255, two.keys & 255
        passed = two.mix(all_given[byte, choice], all_rest[byte, choice])
        return cls(all_given, all_rest, two.keys, *passed)

    def find(self, keys):
        """The place of each (context of two bytes, choice), or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def log_chances(grams, found, crown):
    """The base-10 logarithm of each window's chance of its last byte."""
    passed = {}
    for depth in range(TOP, DEPTH + 1):
        level = found[depth]
        if depth == TOP:
            above = crown.find(_up(level.keys, TOP))
            given, rest = crown.given_two[above], crown.rest_two[above]
        else:
            above = found[depth - 1].find(_up(level.keys, depth))
            given, rest = (p[above] for p in passed[depth - 1])
        passed[depth] = level.mix(given, rest)
    keys, taken = choices(grams)
    keys, taken = keys.ravel(), taken.ravel()
    # A choice not met in a context is even there; the deepest known context tells
    # what is left to it.
    chance = np.empty(len(keys))
    open_keys = np.arange(len(keys))
    for depth in range(DEPTH, TOP - 1, -1):
        at = found[depth].find(_up(keys[open_keys], depth + 1))
        hit = at >= 0
        given, rest = passed[depth]
        chance[open_keys[hit]] = given[at[hit]] + 0.5 * rest[at[hit]]
        open_keys = open_keys[~hit]
    at = crown.find(_up(keys[open_keys], TOP))
    hit = at >= 0
    chance[open_keys[hit]] = crown.given_two[at[hit]] + 0.5 * crown.rest_two[at[hit]]
    open_keys = open_keys[~hit]
    byte, choice = (keys[open_keys] >> 8) & 255, keys[open_keys] & 255
    chance[open_keys] = crown.given[byte, choice] + 0.5 * crown.rest[byte, choice]
    logs = np.log10(np.where(taken, chance, 1 - chance))
    return logs.reshape(-1, 8).sum(axis=1)


def _below_top(table):
    """Phase one: one bucket's share of the nodes of two bytes of context."""
    level = levels(table["gram"].to_numpy(), table["n"].to_numpy(), TOP)[TOP]
    keys, which = np.unique(_up(level.keys, TOP), return_inverse=True)
    which = which.ravel()
    sums = {"zeros": level.zeros, "ones": level.ones, "log_p": level.log_p}
    return pa.table(
        {"key": pa.array(keys)}
        | {
            c: pa.array(np.bincount(which, x, len(keys)), pa.float64()) for c, x in sums.items()
        }
    )


def _solve(crown):
    """Phase two: the chances of one bucket's windows."""

    def solve(table):
        grams = table["gram"].to_numpy()
        found = levels(grams, table["n"].to_numpy(), TOP)
        return pa.table(
            {
                "gram": pa.array(grams),
                "log_chance": pa.array(log_chances(grams, found, crown)),
                "n_all": table["n_all"],
            }
        )

    return solve


def gram_chances(grams):
    """``gram``, ``log_chance``, ``n_all`` of a written table with ``gram``, its training count
    ``n``, and ``n_all``."""
    buckets = max(1, -(-grams.count() // BUCKET_WINDOWS))
    context = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1))
    bucket = F.pmod(F.xxhash64(context), F.lit(buckets))
    grouped = grams.select(bucket.alias("bucket"), "gram", "n", "n_all").groupBy("bucket")
    nodes = grouped.applyInArrow(_below_top, "key long, zeros double, ones double, log_p double")
    # At most 65,536 contexts times 255 choices, of which languages use few.
    two = nodes.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log_p")])
    found = two.toArrow()
    columns = [found[c].to_numpy() for c in ("key", "zeros", "ones", "log_p")]
    crown = Crown.solve(columns[0].astype(np.int64), *columns[1:])
    return grouped.applyInArrow(_solve(crown), "gram long, log_chance double, n_all long")


# --- whole texts --------------------------------------------------------------


def text_windows(texts):
    """The windows of all bytes of whole texts, and what the texts are made of.

    A text's bytes are its words, a space behind each, and a line end, as one
    stream: contexts reach back over the spaces, and at its start over line ends.
    Returns the windows and the text of each.
    """
    front = END * DEPTH
    streams = [front + b" ".join([*t.lower().split(), END]) for t in as_bytes(texts)]
    sizes = np.array([len(x) for x in streams], dtype=np.int64)
    raw = np.frombuffer(b"\0" + b"".join(streams) + b"\0", np.uint8)
    # A window and the byte before it, wherever it starts, are eight bytes in order.
    many = max(0, len(raw) - 2 - DEPTH)
    eights = np.ndarray((many,), dtype=">i8", buffer=raw, strides=(1,))
    grams = eights.astype(np.int64)
    grams &= (1 << 8 * (DEPTH + 1)) - 1
    # Those that reach over the end of a text are none.
    of = np.repeat(np.arange(len(sizes)), sizes - DEPTH)
    at = of * DEPTH
    at += np.arange(len(of))
    return grams[at], of


class Lookup:
    """The places of whole numbers in an array, by hashing; the numbers are distinct."""

    def __init__(self, keys):
        self.keys = keys
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._first(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            # Of those that wanted one slot, one has it.
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _first(self, keys):
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> self.shift).astype(np.int64)

    def find(self, keys):
        """The place of each key, or -1."""
        at = self._first(keys)
        found = self.slots[at]
        if not len(self.keys):
            return found
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            here = self.slots[at]
            found[open_] = here
            more = (here >= 0) & (self.keys[here] != keys[open_])
            open_, at = open_[more], at[more]
        return found


def _summed(keys, counts):
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_words(batches):
    """The words of each slice of texts, with how often training and all texts have them."""
    for batch in batches:
        give_back()
        train = ~batch["held_out"].to_numpy(zero_copy_only=False)
        for lo, hi in slices(text_sizes(batch["text"]), WORDS_AT_ONCE):
            yield _word_counts(batch["text"].slice(lo, hi - lo), train[lo:hi])


def _word_counts(texts, train):
    words, numbers, counts = lowered_words(texts)
    n_all = np.bincount(numbers, minlength=len(words))
    n_train = np.bincount(numbers[np.repeat(train, counts)], minlength=len(words))
    return pa.RecordBatch.from_pydict(
        {
            "word": pa.array([*words, END], pa.binary()),
            "n_train": pa.array(np.append(n_train, np.count_nonzero(train))),
            "n_all": pa.array(np.append(n_all, len(train))),
        }
    )


def _count_windows(batches):
    """Windows with their counts, added up within a task up to ``HELD`` of them. Counts of
    one window may come in several rows."""
    held, size = [], 0
    for batch in batches:
        give_back()
        train = ~batch["held_out"].to_numpy(zero_copy_only=False)
        for lo, hi in slices(text_sizes(batch["text"]), STREAM_AT_ONCE):
            held.append(_slice_counts(batch["text"].slice(lo, hi - lo), train[lo:hi]))
            size += len(held[-1][0])
            if size > HELD:
                _add_up(held)
                size = len(held[0][0])
                if size > HELD // 2:
                    # The rare ones go, and the others are met again.
                    rare, more = _by_count(*held.pop())
                    held, size = [more], len(more[0])
                    yield from _count_rows(*rare)
                    del rare, more
                give_back()
    if held:
        _add_up(held)
        yield from _count_rows(*held.pop())


def _slice_counts(texts, train):
    """Sorted windows, twice each and one more for training texts, with their counts."""
    keys, of = text_windows(texts)
    keys <<= 1
    keys |= train[of]
    del of
    return np.unique(keys, return_counts=True)


def _add_up(held):
    """Make one run of all runs of ``held``, which are let go on the way."""
    keys, counts = map(np.concatenate, zip(*held, strict=True))
    held.clear()
    held.append(_summed(keys, counts))


def _by_count(keys, counts):
    """The three quarters that are met least, and the others."""
    rare = counts <= np.quantile(counts, 0.75)
    return (keys[rare], counts[rare]), (keys[~rare], counts[~rare])


def _count_rows(keys, counts):
    """In batches that are small for the JVM as well, which holds each one whole."""
    for at in range(0, len(keys), ROWS_AT_ONCE):
        some, n = keys[at : at + ROWS_AT_ONCE], counts[at : at + ROWS_AT_ONCE]
        yield pa.RecordBatch.from_pydict(
            {"gram": pa.array(some >> 1), "n_train": pa.array(n * (some & 1)), "n_all": pa.array(n)}
        )


def counted(rows, count, key):
    """``key`` with ``n`` in training texts and ``n_all``; ``rows``: ``held_out``, ``text``."""
    parts = rows.select("held_out", "text").mapInArrow(count, f"{key}, n_train long, n_all long")
    return parts.groupBy(key.split()[0]).agg(
        F.sum("n_train").alias("n"), F.sum("n_all").alias("n_all")
    )


def _at_least(counts, most):
    """The count from which on at most ``most`` rows of a table have it.

    Counts are looked at by their powers of two first, then within the power that
    decides, by steps that halve it: 64 rows reach the driver each time.
    """
    low, high = 0, 63
    size = counts.groupBy((F.length(F.bin("n_all")) - 1).alias("p")).count()
    by_power = {r["p"]: r["count"] for r in size.collect()}
    above = 0
    for power in range(high, low - 1, -1):
        if above + by_power.get(power, 0) > most:
            break
        above += by_power.get(power, 0)
    else:
        return 1
    start, width = 1 << power, 1 << power
    while width > 1:
        step = max(1, width // 64)
        place = F.floor((F.col("n_all") - F.lit(start)) / step).cast("int")
        inside = counts.where(F.col("n_all").between(start, start + width - 1))
        size = inside.groupBy(place.alias("p")).count()
        by_step = {r["p"]: r["count"] for r in size.collect()}
        for at in range(width // step - 1, -1, -1):
            if above + by_step.get(at, 0) > most:
                break
            above += by_step.get(at, 0)
        start, width = start + at * step, step
    return start + 1


def _window_key(gram):
    # A space and the seven bytes; no word holds a space.
    return F.unhex(F.hex(gram + F.lit(0x20 << 56)))


STREAM = "row long, doc_id {}, held_out boolean, key binary, n long, n_tokens long, n_bytes long,"
STREAM += " n_known long, base double, score double"


def _known(often, floor):
    """The tables of frequent words and windows, for lookups."""
    words, counts, grams, logs = often
    return {
        "word": {w: i for i, w in enumerate(words)},
        "known": np.append(counts > 0, False).astype(np.float64),
        "base": np.append(np.log10(counts + 0.1) - floor, 0.0),
        # Behind the chances stands 0 for windows that are not there.
        "grams": Lookup(grams),
        "logs": logs,
    }


def _score_texts(often, floor):
    """Sums over frequent words and windows, and one row per other one of each document."""
    name = uuid.uuid4().hex

    def score(batches):
        give_back()
        table = kept(name, lambda: _known(often.value, floor))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi in slices(text_sizes(batch["text"]), STREAM_AT_ONCE):
                yield _slice_scores(batch.slice(lo, hi - lo), row, table)
                row += hi - lo
            give_back()

    return score


def _slice_scores(rows, row, table):
    """Of consecutive rows, the first of which has the number ``row``."""
    grams_known, logs = table["grams"], table["logs"]
    docs, part = rows.num_rows, rows["text"]
    words, numbers, counts = lowered_words(part)
    grams, of = text_windows(part)
    size = np.bincount(of, minlength=docs)
    at = grams_known.find(grams)
    sums = np.bincount(of, logs[at], docs)
    rest = np.flatnonzero(at < 0)
    own, which = np.unique(grams[rest], return_inverse=True)
    code, n = np.unique(of[rest] * len(own) + which, return_counts=True)
    doc, code = np.divmod(code, max(1, len(own)))
    far = (own[code] | (0x20 << 56)).astype(">i8").view("S8")
    # Words; every text has an end.
    get = table["word"].get
    known = np.array([get(w, -1) for w in words], dtype=np.int64)[numbers]
    of_word = np.repeat(np.arange(docs), counts)
    end = get(END)
    n_known = np.bincount(of_word, table["known"][known], docs) + table["known"][end]
    base = np.bincount(of_word, table["base"][known], docs) + table["base"][end]
    rest = np.flatnonzero(known < 0)
    width = max(1, len(words))
    pairs, n_words = np.unique(of_word[rest] * width + numbers[rest], return_counts=True)
    doc_words, code = np.divmod(pairs, width)
    # One row per document has its own sums and a key that nothing has.
    names = [b" " * 9 + b"%d" % (row + i) for i in range(docs)]
    names += [words[c] for c in code]
    keys = pa.concat_arrays(
        [
            pa.array(names, pa.binary()),
            pa.Array.from_buffers(
                pa.binary(),
                len(far),
                [
                    None,
                    pa.py_buffer(np.arange(0, 8 * len(far) + 1, 8, dtype=np.int32)),
                    pa.py_buffer(far.tobytes()),
                ],
            ),
        ]
    )
    more = len(keys) - docs
    place = np.concatenate([np.arange(docs), doc_words, doc])
    times = np.concatenate([np.zeros(docs, dtype=np.int64), n_words, n])

    def first(values):
        return pa.concat_arrays([values, pa.nulls(more, values.type)])

    return pa.RecordBatch.from_arrays(
        [
            pa.array(row + place),
            first(rows["doc_id"]),
            first(rows["held_out"]),
            keys,
            pa.array(times),
            first(pa.array(counts + 1)),
            first(pa.array(size)),
            first(pa.array(n_known.astype(np.int64))),
            first(pa.array(base)),
            first(pa.array(sums)),
        ],
        names=[c.split()[0] for c in STREAM.split(", ")],
    )


def score_texts(
    docs, doc_id="doc_id", text="text", held_out=None, frequent=FREQUENT, windows_held=WINDOWS_HELD
):
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``, ``bits_per_byte``.

    The model learns from the rows that are not held out, by default those whose
    CRC-32 of the id's text leaves a remainder mod 10. ``base_score`` is that of smoothed
    word frequencies, ``score`` the base-10 logarithm of the text's chance.

    NULL and empty texts have one token, the end; rows with a NULL id are held out by the
    empty text's checksum; rows that repeat are scored and counted each; equal texts score
    alike. A very long text is taken whole. Only ids and texts are read, so other columns
    may have any name. An empty table gives no row, and without training rows
    every byte costs eight bits. The layout of the files does not matter.
    """
    if held_out is None:
        name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
        held_out = F.crc32(name.cast("binary")) % 10 == 0
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        whole_text(text).alias("text"),
    )
    words = written(counted(rows, _count_words, "word binary"), "words").where("n_all > 0")
    words = words.select("word", F.col("n").alias("n_train"), "n_all")
    counts = written(counted(rows, _count_windows, "gram long"), "windows")
    total = words.agg(
        F.coalesce(F.sum("n_train"), F.lit(0)).alias("train"),
        F.count_if(F.col("n_train") > 0).alias("distinct"),
        F.coalesce(F.sum("n_all"), F.lit(0)).alias("n"),
    ).first()
    floor = float(np.log10(total["train"] + 0.1 * (total["distinct"] + 1)))
    often = (F.col("n_all") * F.lit(frequent) >= total["n"]) & (F.length("word") <= LONGEST_FREQUENT)
    often = often | (F.col("word") == F.lit(END))
    top = words.where(often).select("word", "n_train").toArrow()
    least = _at_least(counts, windows_held)
    chances = written(gram_chances(counts), "window-chances")
    held = chances.where("n_all >= %d" % least).select("gram", "log_chance").toArrow().sort_by("gram")
    known = (
        top["word"].to_pylist(),
        top["n_train"].to_numpy().astype(np.float64),
        held["gram"].to_numpy(),
        np.append(held["log_chance"].to_numpy(), 0.0),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    pairs = rows.mapInArrow(
        _score_texts(docs.sparkSession.sparkContext.broadcast(known), floor), STREAM.format(kind)
    )
    rest = words.where(~often).select(
        F.col("word").alias("key"), F.col("n_train").alias("seen"), F.lit(0.0).alias("log")
    )
    rest = rest.unionByName(
        chances.where("n_all < %d" % least).select(
            _window_key(F.col("gram")).alias("key"),
            F.lit(None).cast("long").alias("seen"),
            F.col("log_chance").alias("log"),
        )
    )
    n, seen = F.col("n"), F.col("seen")
    joined = pairs.join(rest, "key", "left").select(
        "row",
        "doc_id",
        "held_out",
        "n_tokens",
        "n_bytes",
        F.coalesce("n_known", F.when(seen > 0, n), F.lit(0)).alias("n_known"),
        F.coalesce("base", n * (F.log10(seen + 0.1) - F.lit(floor)), F.lit(0.0)).alias("base"),
        F.coalesce("score", n * F.col("log"), F.lit(0.0)).alias("score"),
    )
    sums = ["n_tokens", "n_bytes", "n_known", "base", "score"]
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            *[F.sum(c).alias(c) for c in sums],
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(total["train"]).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"),
            "score",
            (F.col("score") / F.lit(-float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"),
        )
    )
