import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import importance
from tillroll.llm.common import importable

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_features(text, most=1):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    runs = [
        " ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)
    ]
    return len(words), runs


def slow_resample(docs, target, most=1, buckets=10000, min_words=20, percent=10):
    def hashed(text):
        return [zlib.crc32(f.encode()) % buckets for f in slow_features(text, most)[1]]

    s = Counter(b for _, text in docs for b in hashed(text))
    t = Counter(b for text in target for b in hashed(text))
    ss, tt = sum(s.values()), sum(t.values())
    rows = []
    for doc, text in docs:
        found = hashed(text)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets))))
            for b in found
        )
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        fit = score is not None and slow_features(text)[0] >= min_words
        rows.append([doc, len(found), weight, score, None, fit])
    fit = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0], -r[1]))
    for place, row in enumerate(fit[: len(fit) * percent // 100]):
        row[4] = place + 1
    return [tuple(r[:5]) for r in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=30))
def test_checksums(strings):
    assert importance.checksums(strings).tolist() == [zlib.crc32(s) for s in strings]


def test_checksums_of_long_strings():
    strings = [b"x" * 70_000, b"", b"y" * 70_000, b"abc"]
    assert importance.checksums(strings).tolist() == [zlib.crc32(s) for s in strings]


def corpus():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÄB", "straße", "日本", "O'Neil", "x_y", "7"]
    docs = [(0, None), (1, ""), (2, "- _ \x7f"), (3, "one two"), (None, "w1 " * 30), (None, "w1 " * 30)]
    for i in range(4, 300):
        docs.append((i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 60))))))
    docs += [docs[20], docs[21], (500, docs[22][1]), (501, "w3 " * 50_000)]
    target = [None, "", *(" ".join(rng.choice(vocabulary[:12], 40)) for _ in range(5))]
    return docs, target


def test_by_brute_force(spark):
    importable(spark)
    docs, target = corpus()
    rows = spark.createDataFrame(
        [(d, t, 1, "x") for d, t in docs], "doc_id long, text string, place long, RANK string"
    ).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for options in ({}, {"most": 2, "buckets": 50, "min_words": 1, "percent": 50}):
        got = importance.resample(rows, wanted, **options).collect()
        want = slow_resample(docs, target, **options)
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    importable(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(i, f"a b c {i}") for i in range(30)], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    got = importance.resample(some, none, min_words=2).collect()
    want = slow_resample([(i, f"a b c {i}") for i in range(30)], [], min_words=2)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_ranks_of_many_equal_scores(spark):
    """Ties fill no single range: the row's number parts them."""
    rows = spark.range(5_000).selectExpr("id", "id % 3 AS score")
    got = importance.ranked(rows, rows["score"].desc(), rows["id"]).collect()
    want = sorted(((r.id % 3, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert [r.place for r in sorted(got, key=lambda r: (-r.score, r.id))] == list(range(1, 5_001))
    assert len(want) == 5_000
