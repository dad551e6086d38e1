import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import periodic_runs as periodic


def slow_runs(words):
    """Every lag of a text, word by word; of equal stretches the smallest lag."""
    period = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                period.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, size, q) for (s, size), q in period.items())


def slow_row(doc, text, reading=None):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if reading == "tiled" and doc is not None and words:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    longest = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    start, length, period = longest[0] if longest else (None, None, None)
    milli = 1000 * length // period if longest else None
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc, len(runs), start, length, period, milli, *digests)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=14), st.integers(1, 6)),
        max_size=6,
    )
)
def test_blocks_of_repeats(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert periodic.find_runs(words) == slow_runs(words)


@pytest.mark.parametrize("kinds", [1, 2, 3, 50])
def test_random_texts(kinds):
    rng = np.random.default_rng(kinds)
    for n in (0, 1, 11, 12, 13, 24, 47, 48, 49, 150, 400):
        words = rng.integers(0, kinds, n).tolist()
        assert periodic.find_runs(words) == slow_runs(words)
        both = words + words + words[: n // 2]
        assert periodic.find_runs(both) == slow_runs(both)


def test_as_many_runs_as_words_allow():
    """Two progressions back to back: a run around the border for every odd period."""
    words = [0, 1] * 150 + [0, 0] + [1, 0] * 150
    assert periodic.find_runs(words) == slow_runs(words)


def test_pairs_grow_with_the_words():
    """One word over and over gives no pair above the first level, a long period few."""
    for words in (np.zeros(50_000, int), np.tile(np.arange(5_000), 10)):
        for size, codes, order, _ in periodic.gram_levels(words):
            pairs = periodic.seed_pairs(size, codes, order)
            assert len(pairs[0]) <= 3 * len(words)
    assert periodic.find_runs(np.zeros(300_000, int)) == [(0, 300_000, 1)]


def test_a_period_of_half_the_text():
    words = list(range(40_000)) * 2
    assert periodic.find_runs(words) == [(0, 80_000, 40_000)]


def test_words_that_stay():
    runs = [(0, 12, 3), (8, 14, 2)]
    kept = periodic.kept_words(25, runs)
    assert np.flatnonzero(kept).tolist() == [0, 1, 2, 22, 23, 24]


TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b"),
    (4, "one"),
    (5, "a b c " * 5),
    (5, "a b c " * 5),
    (6, "x " * 12),
    (7, "x " * 11),
    (8, "\x1cé 日本\x85 z  " * 9),
    (None, "a b " * 8 + "c " + "d e f g h i j " * 4),
    (9, "head " + "w1 w2 w3 w4 w5 w6 w7 " * 3 + "mid " + "p q " * 12 + "tail"),
    (10, "p q " * 7 + "x y z " + "r s " * 7),  # as long as each other: the first
]


@pytest.mark.parametrize("reading", [None, "tiled"])
def test_over_a_table(spark, reading):
    more = [(i, " ".join(f"w{(i * j) % 17}" for j in range(i))) for i in range(11, 120)]
    rows = TEXTS + more
    docs = spark.createDataFrame(
        [(d, t, "x", 1) for d, t in rows], "doc_id long, text string, runs string, START long"
    ).repartition(3)
    how = periodic.tiled if reading else None
    got = periodic.periodic_runs(docs, reading=how).collect()
    want = [slow_row(d, t, reading) for d, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_runs_on_demand_and_long_text(spark):
    long_text = "never again " + "la di da " * 200_000
    docs = spark.createDataFrame([("a", long_text), ("b", "x")], "key string, body string")
    rows = periodic.periodic_runs(docs, "key", "body", with_runs=True).collect()
    found = {r.doc_id: [tuple(run) for run in r.runs] for r in rows}
    assert found == {"a": [(2, 600_000, 3)], "b": []}


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.periodic_runs(docs).count() == 0
