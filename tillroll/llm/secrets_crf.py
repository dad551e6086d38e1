"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The patterns find what looks the same everywhere (assignments, access keys, hex
strings) and are always reported. The random field tags every word of a text as
secret begin (B), inside (I) or outside (O) from the word's shape, its neighbours
and the text as a whole, and is decoded by Viterbi; it adds what no pattern names,
also where a value runs on behind the end of a pattern's match.

It is trained on a bounded sample (``SAMPLE`` texts with a pattern match and as many
without). Pattern matches are its labels. In half of its windows the words that
make a pattern match (key names, the AKIA prefix) are hidden and the values are
replaced by chance ones of other alphabets, so it must learn what secrets
themselves look like.

Features depend on a word alone, so a word is looked at once per task and stands
for a row of weights afterwards. Viterbi runs over all texts of a batch at once,
cut into blocks of equal length: each block is solved for every tag it may start
from, the blocks are chained, and the best path is read back, whatever the length
of one text.
"""

import json
import operator
import re
import string
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillroll.llm.common import (
    Memo,
    as_bytes,
    free_name,
    give_back,
    numbered_words,
    slices,
    text_sizes,
    whole_text,
)

# The patterns and least lengths of the three fixed kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A maximal run, so 24 or more letters are what [0-9a-f]+ would give.
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ["assign", "access", "hex", "crf"]

# What a text holds that matches the first pattern, in lower case.
KEY_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
MAY_MATCH = re.compile(rb"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KEY_NAME = re.compile(rb"pass|secret|token|api_?key|credential|auth|private", re.IGNORECASE)
PLAIN = re.compile(rb"[\"'(]?(?:[A-Za-z]|[\x80-\xff])+[.,;:!?\"')]{0,3}")
EDGE = "\"'`()[]{}<>.,;:!?"
IDLE = EDGE + string.whitespace
TAGS = "OBI"
CHARACTER_KINDS = bytes(
    ord("0" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "-")
    for c in map(chr, range(128))
) + b"-" * 128
ALPHABETS = [
    string.hexdigits[:16],
    string.digits + string.ascii_lowercase,
    string.digits + string.ascii_uppercase,
    string.digits + string.ascii_letters,
    string.digits + string.ascii_letters + "_-",
    string.digits + string.ascii_letters + "+/",
]
SAMPLE = 1200  # texts with a pattern match, and texts without, to train on
SPOTS = 4  # training windows per text at most
WINDOW = 8  # words on either side of a training spot
BLOCK = 128
TEXT_AT_ONCE = 3 << 20


def base_spans(text):
    """The pattern matches of one text as (kind number, start, end), by start, then kind."""
    found = [
        (0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE
    ]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(2, *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


def core(word):
    """Where the value of a word stands: without quotes, punctuation and a key before = or :."""
    start, end = 0, len(word)
    while end > start and word[end - 1] in EDGE:
        end -= 1
    cut = max(word.rfind("=", 0, max(start, end - 6)), word.rfind(":", 0, max(start, end - 6)))
    if cut >= 0:
        start = cut + 1
    while start < end and word[start] in EDGE:
        start += 1
    return start, end


def _bucket(x, bounds):
    return sum(x >= b for b in bounds)


def features(word):
    """The features of one word given as bytes, as names; ``~`` marks those that name a key."""
    if len(word) < 24 and PLAIN.fullmatch(word):
        shape = "lower" if word.islower() else "upper" if word.isupper() else "mixed"
        size = "short" if len(word) < 8 else "long"
        names = ["plain", f"plain {shape}", f"plain {size}"]
        return names + ["~key name"] * bool(KEY_NAME.search(word))
    text = word.decode("utf-8", "replace")
    start, end = core(text)
    value = text[start:end]
    n = len(value)
    kinds = value.encode("ascii", "replace").translate(CHARACTER_KINDS)
    digits, uppers, lowers = kinds.count(b"0"), kinds.count(b"A"), kinds.count(b"a")
    other = n - digits - uppers - lowers
    turns = sum(map(operator.ne, kinds, kinds[1:]))
    varied = len(set(value)) / max(n, 1)
    names = [
        f"length {_bucket(n, (4, 6, 8, 12, 16, 20, 24, 32, 48))}",
        f"digits {_bucket(digits / max(n, 1), (0.01, 0.15, 0.3, 0.6, 0.99))}",
        f"classes {(digits > 0) + (uppers > 0) + (lowers > 0) + (other > 0)}",
        f"mix {'0' * (digits > 0)}{'A' * (uppers > 0)}{'a' * (lowers > 0)}{'-' * (other > 0)}",
        f"turns {_bucket(turns / max(n, 1), (0.05, 0.15, 0.3, 0.5))}",
        f"varied {_bucket(varied, (0.2, 0.4, 0.6, 0.8))}",
        f"long and mixed {n >= 12 and digits > 0 and uppers + lowers > 0 and turns >= 4}",
        f"hex only {n >= 12 and all(c in '0123456789abcdef' for c in value)}",
        f"odd inside {any(c in value for c in '/:,;()|&')}",
        f"at sign {'@' in value}",
        f"address {'://' in text}",
        f"dots and slashes {_bucket(value.count('.') + value.count('/'), (1, 2, 3))}",
        f"repeated end {word[-1:] * 3 == word[-3:]}",
    ]
    if start:
        names.append("~set by = or :")
    if text.endswith(("=", ":")):
        names.append("~ends in = or :")
    if KEY_NAME.search(word):
        names.append("~key name")
    if value.startswith("AKIA"):
        names.append("~access key")
    return names


def text_features(words, hits):
    """Features of the text as a whole: how many of its words are not plain."""
    share = hits / max(words, 1)
    return [f"text {_bucket(share, (0.001, 0.01, 0.05, 0.2))}", f"text words {_bucket(words, (50, 500))}"]


def _expand(names):
    """A word's features as seen from itself, the word after it and the word before it."""
    return [f"0 {n}" for n in names], [f"-1 {n}" for n in names], [f"+1 {n}" for n in names]


class Field:
    """A trained random field: weights per feature and tag, transitions, start."""

    def __init__(self, index, weights, transitions, start):
        self.index, self.weights = index, weights
        self.transitions, self.start = transitions, start

    def score(self, names):
        rows = [self.index[n] for n in names if n in self.index]
        return self.weights[rows].sum(axis=0) if rows else np.zeros(3)

    def rows(self, names):
        return np.stack([self.score(side) for side in _expand(names)])


def labels_of(spans, tokens):
    """Tags of the words that pattern matches cover."""
    tags = np.zeros(len(tokens), dtype=np.int64)
    starts = np.array([t[0] for t in tokens])
    for _, a, b in spans:
        first = max(0, int(np.searchsorted(starts, a, side="right")) - 1)
        last = max(first + 1, int(np.searchsorted(starts, b, side="left")))
        if tags[first] == 0:
            tags[first] = 1
        tags[first + 1 : last] = 2
    return tags


def disguised(word, pick):
    """The word with its value replaced by a chance one of another alphabet and length."""
    text = word.decode()
    start, end = core(text)
    letters = ALPHABETS[pick.integers(len(ALPHABETS))]
    value = "".join(letters[i] for i in pick.integers(len(letters), size=pick.integers(14, 45)))
    return (text[:start] + value + text[end:]).encode()


def decoy(words, pick):
    """A word that is odd and no secret: an address, path, date, version or setting."""
    a, b = (words[i].strip(EDGE.encode()).decode().lower() or "x" for i in pick.integers(len(words), size=2))
    n, m = pick.integers(1, 2000, size=2)
    return [
        f"https://www.{a}.com/{b}/{n}?p={m}",
        f"http://{a}.org/{b}-{a}.html",
        f"{a}.{b}{n % 100}@{b}{m % 10}.example.com",
        f"/{a}/{b}/{a}_{n}.txt",
        f"{2000 + n % 40}-{m % 12 + 1:02}-{n % 28 + 1:02}T{m % 24:02}:{n % 60:02}:00Z",
        f"v{n % 20}.{m % 30}.{n % 7}-{a}",
        f"{a}={n}",
        f"{a}:{b}",
        f"{a}-{b}-{a}-{n}",
        f"+{n % 99} {m}-{n}",
    ][pick.integers(10)].encode()


def training_windows(text, pick):
    """Windows of one text: (features per word, text features, tags).

    They stand around pattern matches, words that are not plain, and one chance
    word; ``pick`` is the text's own source of chance.
    """
    tokens = [m.span() for m in WORD.finditer(text)]
    if not tokens:
        return []
    words = [text[a:b].encode() for a, b in tokens]
    tags = labels_of(base_spans(text), tokens)
    odd = np.array([not PLAIN.fullmatch(w) for w in words])
    spots = pick.permutation(np.flatnonzero(tags == 1))[: SPOTS // 2].tolist()
    spots.append(int(pick.integers(len(words))))
    spots += pick.permutation(np.flatnonzero(odd & (tags == 0)))[: SPOTS - len(spots)].tolist()
    windows = []
    for spot in spots:
        lo, hi = max(0, spot - WINDOW), min(len(words), spot + WINDOW + 1)
        hide = pick.random() < 0.5
        seen = words[lo:hi]
        if hide:
            seen = [
                disguised(w, pick) if t == 1 else w
                for w, t in zip(seen, tags[lo:hi], strict=True)
            ]
        if tags[spot] == 0 and pick.random() < 0.5:
            seen = [decoy(words, pick) if lo + i == spot else w for i, w in enumerate(seen)]
        names = [[n for n in features(w) if not (hide and n[0] == "~")] for w in seen]
        windows.append((names, text_features(len(words), int(odd.sum())), tags[lo:hi].tolist()))
    return windows


def _windows(batches):
    for batch in batches:
        out = []
        for value in as_bytes(batch["t"]):
            pick = np.random.default_rng(zlib.crc32(value))
            out += [json.dumps(w) for w in training_windows(value.decode(), pick)]
        yield pa.RecordBatch.from_pydict({"window": pa.array(out, pa.string())})


def fit(windows, rounds=60, penalty=1.0):
    """Train by maximum likelihood with an L2 penalty (AdaGrad over all windows)."""
    index = {}
    rows, columns = [], []
    size = max((len(w[0]) for w in windows), default=1)
    mask = np.zeros((len(windows), size), dtype=bool)
    tags = np.zeros((len(windows), size), dtype=np.int64)
    for w, (names, whole, gold) in enumerate(windows):
        mask[w, : len(names)] = True
        tags[w, : len(names)] = gold
        sides = [_expand(n) for n in names]
        for i in range(len(names)):
            found = sides[i][0] + whole
            found = found + (sides[i - 1][1] if i else []) + (sides[i + 1][2] if i + 1 < len(names) else [])
            for n in found:
                rows.append(w * size + i)
                columns.append(index.setdefault(n, len(index)))
    rows, columns = np.array(rows, dtype=np.int64), np.array(columns, dtype=np.int64)
    weights, transitions, start = np.zeros((len(index), 3)), np.zeros((3, 3)), np.zeros(3)
    # A secret goes on only after it has begun.
    transitions[0, 2] = start[2] = -4.0
    if not windows or not (tags == 1).any():
        weights[:] = 0
        start[1] = transitions[0, 1] = -20.0
        return Field(index, weights, transitions, start)
    squares = [np.full(p.shape, 1e-8) for p in (weights, transitions, start)]
    gold = np.eye(3)[tags] * mask[..., None]
    gold_pairs = np.einsum("wia,wib->ab", gold[:, :-1], gold[:, 1:])
    for _ in range(rounds):
        emissions = np.zeros((len(windows) * size, 3))
        for k in range(3):
            emissions[:, k] = np.bincount(rows, weights[columns, k], len(emissions))
        emissions = emissions.reshape(len(windows), size, 3)
        chance, pairs = _marginals(emissions, transitions, start, mask)
        miss = (gold - chance * mask[..., None]).reshape(-1, 3)
        slope = np.stack(
            [np.bincount(columns, miss[rows, k], len(index)) for k in range(3)], axis=1
        )
        slopes = (
            slope - penalty * weights,
            gold_pairs - pairs - penalty * transitions,
            gold[:, 0].sum(axis=0) - chance[:, 0].sum(axis=0) - penalty * start,
        )
        for p, g, s in zip((weights, transitions, start), slopes, squares, strict=True):
            s += g * g
            p += 0.5 * g / np.sqrt(s)
    return Field(index, weights, transitions, start)


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _marginals(emissions, transitions, start, mask):
    """Tag chances per word and expected transitions, by forward and backward sums."""
    n, size, _ = emissions.shape
    forward, backward = np.zeros_like(emissions), np.zeros_like(emissions)
    forward[:, 0] = start + emissions[:, 0]
    for i in range(1, size):
        step = _log_sum(forward[:, i - 1, :, None] + transitions, 1) + emissions[:, i]
        forward[:, i] = np.where(mask[:, i, None], step, forward[:, i - 1])
    for i in reversed(range(size - 1)):
        step = _log_sum(transitions + (emissions[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
        backward[:, i] = np.where(mask[:, i + 1, None], step, 0)
    total = _log_sum(forward[:, -1], 1)
    chance = np.exp(forward + backward - total[:, None, None])
    pairs = np.zeros((3, 3))
    for i in range(size - 1):
        joint = (
            forward[:, i, :, None]
            + transitions
            + (emissions[:, i + 1] + backward[:, i + 1])[:, None, :]
        )
        joint = np.exp(joint - total[:, None, None])
        pairs += (joint * mask[:, i + 1, None, None]).sum(axis=0)
    return chance, pairs


def viterbi(emissions, first, transitions, start, block=BLOCK):
    """The best tags of many texts laid end to end; ``first`` marks each text's first word."""
    n = len(emissions)
    if not n:
        return np.zeros(0, dtype=np.int8)
    blocks = -(-n // block)
    padded = np.zeros((blocks * block, 3))
    padded[:n] = emissions
    resets = np.ones(blocks * block, dtype=bool)
    resets[:n] = first
    padded, resets = padded.reshape(blocks, block, 3), resets.reshape(blocks, block)
    fresh = np.broadcast_to(start, (3, 3))
    # best[b, s, x]: the best path through block b that comes from tag s and is at x.
    best = np.where(np.eye(3, dtype=bool), 0.0, -np.inf)[None].repeat(blocks, axis=0)
    back = np.zeros((block, blocks, 3, 3), dtype=np.int8)
    for t in range(block):
        step = np.where(resets[:, t, None, None], fresh, transitions)
        paths = best[:, :, :, None] + step[:, None]
        back[t] = paths.argmax(axis=2)
        best = paths.max(axis=2) + padded[:, t, None, :]
    # Chain the blocks: which tag each one starts from.
    at, came = np.zeros(3), np.zeros((blocks, 3), dtype=np.int64)
    for b in range(blocks):
        paths = at[:, None] + best[b]
        came[b] = paths.argmax(axis=0)
        at = paths.max(axis=0)
        at -= at.max()
    tag = int(at.argmax())
    start_tag, end_tag = np.zeros(blocks, dtype=np.int64), np.zeros(blocks, dtype=np.int64)
    for b in reversed(range(blocks)):
        end_tag[b], start_tag[b] = tag, came[b, tag]
        tag = start_tag[b]
    tags, now, lane = np.zeros((blocks, block), dtype=np.int8), end_tag, np.arange(blocks)
    for t in reversed(range(block)):
        tags[:, t] = now
        now = back[t, lane, start_tag, now]
    return tags.ravel()[:n]


class Scanner:
    """Finds all spans of many texts with a trained field."""

    def __init__(self, field):
        self.field = field
        self.known = Memo()
        self.classes, self.rows = {}, []
        self.flags = []  # per class: a pattern may match, not plain

    def _learn(self, word):
        may = MAY_MATCH.search(word) is not None
        names = tuple(features(word))
        key = (names, may)
        if key not in self.classes:
            self.classes[key] = len(self.rows)
            self.rows.append(self.field.rows(names))
            self.flags.append((may, not names or names[0] != "plain"))
        return self.classes[key]

    def spans(self, texts):
        """Per text of an Arrow column its spans as (kind number, start, end)."""
        words, numbers, counts = numbered_words(texts)
        classes = self.known.values(words, lambda new: [self._learn(w) for w in new])
        ids = np.array(classes, dtype=np.int64)[numbers]
        found = [[] for _ in counts]
        if not len(ids):
            return found
        rows, flags = np.stack(self.rows), np.array(self.flags)
        ends = np.cumsum(counts)
        starts = ends - counts
        first = np.zeros(len(ids), dtype=bool)
        first[starts[counts > 0]] = True
        emissions = rows[ids, 0]
        follows = ~first[1:]
        emissions[1:][follows] += rows[ids[:-1][follows], 1]
        emissions[:-1][follows] += rows[ids[1:][follows], 2]
        of = np.repeat(np.arange(len(texts)), counts)
        odd = np.bincount(of, flags[ids, 1], len(texts)).astype(int)
        whole = [self.field.score(text_features(int(n), int(o))) for n, o in zip(counts, odd, strict=True)]
        emissions += np.array(whole)[of]
        tags = viterbi(emissions, first, self.field.transitions, self.field.start)
        may = np.bincount(of, flags[ids, 0], len(texts)) > 0
        tagged = np.bincount(of, tags > 0, len(texts)) > 0
        for i in np.flatnonzero(may | tagged):
            text = texts[int(i)].as_py()
            base = base_spans(text) if may[i] else []
            more = _tagged_spans(text, tags[starts[i] : ends[i]]) if tagged[i] else []
            found[i] = with_added(base, more, text)
        return found


def _tagged_spans(text, tags):
    spans, at = [], None
    words = [m.span() for m in WORD.finditer(text)]
    for (a, b), tag in zip(words, tags, strict=True):
        lo, hi = core(text[a:b])
        lo, hi = (a + lo, a + hi) if lo < hi else (a, b)
        if tag == 2 and at is not None:
            spans[at][1] = hi
        elif tag:
            at = len(spans)
            spans.append([lo, hi])
        if not tag:
            at = None
    return [(3, a, b) for a, b in spans]


def with_added(base, more, text):
    """The pattern spans and, whole, those of the field that reach outside of them.

    A span of the field adds nothing if only white space and punctuation of it stand
    outside the pattern spans.
    """
    # Merge the pattern spans, so that one search per span tells.
    starts, ends = [], []
    for _, a, b in base:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    added = []
    for span in more:
        at, last = span[1:]
        i = bisect_right(ends, at)  # the first pattern span that ends after it starts
        while at < last:
            known = i < len(starts) and starts[i] < last
            if text[at : starts[i] if known else last].strip(IDLE):
                added.append(span)
                break
            at = ends[i] if known else last
            i += 1
    return sorted(base + added, key=lambda s: (s[1], s[0], s[2]))


def spelled(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text, spans):
    """The text with each span replaced by its kind; spans that meet are one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def train(docs, text="text", sample=SAMPLE):
    """A field trained on at most ``sample`` texts with a pattern match and as many without.

    Texts are chosen by hash, so the choice does not depend on order or layout.
    """
    texts = docs.select(whole_text(text).alias("t"), F.xxhash64(whole_text(text)).alias("h"))
    lowered = F.lower("t")
    may = F.col("t").contains("AKIA") | F.col("t").rlike("[0-9a-f]{24}")
    for name in KEY_WORDS:
        may = may | lowered.contains(name)
    # First hashes alone, so that copies meet as nine bytes and not as texts.
    hashes = texts.select("h", may.alias("may")).dropDuplicates()
    chosen = [hashes.where(w).orderBy("h").limit(sample) for w in (F.col("may"), ~F.col("may"))]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]).select("h"))  # 2 * sample rows
    sampled = texts.join(chosen, "h").groupBy("h").agg(F.min("t").alias("t")).select("t")
    # At most SPOTS windows of 2 * WINDOW + 1 words per text reach the driver, as
    # short feature names, however long the texts are.
    rows = sampled.mapInArrow(_windows, "window string").collect()
    return fit([json.loads(w) for w in sorted(r["window"] for r in rows)])


def spans_column(text, field):
    """All spans of a text column: ``array<struct<kind int, start int, end int>>``."""
    scanners = []

    def scan(texts: pa.Array) -> pa.Array:
        give_back()
        if not scanners:
            scanners.append(Scanner(field))
        found = []
        for lo, hi in slices(text_sizes(texts), TEXT_AT_ONCE):
            found += scanners[0].spans(texts.slice(lo, hi - lo))
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array(
            [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found], kind
        )

    return F.arrow_udf(scan, "array<struct<kind: int, start: int, end: int>>")(text)


def scan(docs, doc_id="doc_id", text="text", field=None):
    """``doc_id`` and ``spans`` of every row; see :func:`spans_column` and ``KINDS``.

    Offsets are code points, ends exclusive. NULL texts are empty and have no
    span; NULL ids and repeated rows are kept; equal texts have equal spans; an
    empty table gives no row and trains a field that finds nothing.
    """
    field = field or train(docs, text)
    return docs.select(
        F.col(doc_id).alias("doc_id"), spans_column(whole_text(text), field).alias("spans")
    )


def _spelled_column(spans):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def summary(spans):
    """Counts and spellings of a span column, as a list of columns."""

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda s: s["kind"] < 3)
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return [
        *counts[:3],
        F.sha2(_spelled_column(base), 256).alias("base_sha256"),
        _spelled_column(spans).alias("spans"),
        counts[3],
    ]


def redact(docs, text="text", field=None, length=None):
    """``docs`` with every span of the text replaced by its kind; NULL texts stay NULL.

    ``length`` names a column that holds the text's code points, if there is one;
    it is set anew where a text changed.
    """
    field = field or train(docs, text)
    scanners = []

    def clean(texts: pa.Array) -> pa.Array:
        """The new text where spans were found, else NULL."""
        give_back()
        if not scanners:
            scanners.append(Scanner(field))
        out = []
        for lo, hi in slices(text_sizes(texts), TEXT_AT_ONCE):
            for i, spans in enumerate(scanners[0].spans(texts.slice(lo, hi - lo)), lo):
                out.append(redacted(texts[i].as_py(), spans) if spans else None)
        return pa.array(out, pa.string())

    name = free_name(docs, "redacted_text")
    rows = docs.withColumn(name, F.arrow_udf(clean, "string")(whole_text(text)))
    new = {text: F.coalesce(F.col(name), F.col(f"`{text}`"))}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        changed = F.length(name).cast(kind)
        new[length] = F.when(F.col(name).isNotNull(), changed).otherwise(F.col(f"`{length}`"))
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
