import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tillroll.llm import weighted_sampling as cws


def weights(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text))


def jaccard(a, b):
    a, b = weights(a), weights(b)
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def edited(text, following):
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def chained(value, size, seed):
    return xxhash.xxh64(value.to_bytes(size, "little"), seed=seed).intdigest()


def slow_print(text):
    """The sampled word and level of each sample, a word at a time."""
    found = []
    for number in range(cws.SAMPLES):
        best = None
        for word, weight in weights(text).items():
            h = xxhash.xxh64(word.encode(), seed=42).intdigest()
            first = chained(number, 4, chained(h, 8, 42))
            second = chained(number, 4, chained(first, 8, 42))

            def unit(bits, width):
                return ((bits & ((1 << width) - 1)) + 0.5) / (1 << width)

            r, c = (-math.log(unit(x >> 38, 26) * unit(x >> 12, 26)) for x in (first, second))
            b = unit(first << 12 | second & 4095, 24)
            t = math.floor(math.log(weight) / r + b)
            value = math.log(c) - r * (t - b + 1)
            if best is None or value < best[0]:
                best = (value, word, t)
        found.append(best and best[1:])
    return found


def corpus(n):
    rng = random.Random(6)
    rows = [(None, "No id, é日本"), (None, "a second one"), (3, None), (4, ""), (5, " \n\t "), (6, "one")]
    for i in range(7, n):
        words = rng.choices([f"w{j}é" for j in range(40)], k=rng.randint(1, 60))
        words += ["often"] * rng.randint(0, 30)
        rows.append((i * 3 - 500, " ".join(words)))
    return rows + [rows[20], rows[20], (rows[21][0], "other text of this id"), (9000, rows[30][1])]


def test_report_over_a_table(spark):
    rows = corpus(260)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, copy int")
    got = cws.edit_report(docs.repartition(4)).collect()
    order = sorted({d for d, _ in rows if d is not None})
    order = [None, *order]
    least = {k: min(t or "" for d, t in rows if d == k) for k in order}
    following = {k: least[order[(i + 1) % len(order)]] for i, k in enumerate(order)}
    want = Counter(
        (d, len(t or ""), hashlib.sha256(edited(t or "", following[d]).encode()).hexdigest())
        for d, t in rows
    )
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    once = {k for k in order if len({t for d, t in rows if d == k}) == 1}
    prints = {r.doc_id: r.fingerprint for r in got if r.doc_id in once}
    text_of = {d: t or "" for d, t in rows}
    print_of_text = {}
    errors = []
    for r in got:
        if r.doc_id not in prints:
            continue
        text = text_of[r.doc_id]
        assert print_of_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == len(r.edited_fingerprint) == cws.HEX * cws.SAMPLES
        if not weights(text):
            assert set(r.fingerprint) == {"0"}
        parts = [
            [p[i : i + cws.HEX] for i in range(0, len(p), cws.HEX)]
            for p in (r.fingerprint, r.edited_fingerprint)
        ]
        assert r.near_edited == np.mean([a == b for a, b in zip(*parts, strict=True)])
        errors.append(r.near_edited - jaccard(text, edited(text, following[r.doc_id])))
        errors.append(r.near_next - jaccard(text, following[r.doc_id]))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1
    for r in [r for r in got if r.doc_id in prints][:100]:
        text = text_of[r.doc_id]
        own = slow_print(text)
        for near, other in ((r.near_edited, edited(text, following[r.doc_id])), (r.near_next, following[r.doc_id])):
            assert near == np.mean([a == b for a, b in zip(own, slow_print(other), strict=True)])


def test_likeness_is_generalised_jaccard_similarity(spark):
    """Counts matter, not words alone."""
    pairs = [
        (" ".join(["a"] * 8 + ["b"] * 2), " ".join(["a"] * 2 + ["b"] * 8)),
        ("a b c d e f g h", "a b c d i j k l"),
        ("x " * 50, "x " * 10),
        ("a b", "a b"),
        ("a b", "c d"),
    ]
    rows = [(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = cws.fingerprints(docs, samples=512)
    prints = {r.doc_id: r.fingerprint for r in found.collect()}
    for i, (a, b) in enumerate(pairs):
        x, y = prints[2 * i], prints[2 * i + 1]
        same = np.mean([x[k : k + 8] == y[k : k + 8] for k in range(0, len(x), 8)])
        assert abs(same - jaccard(a, b)) < 0.08


def test_a_very_long_text(spark):
    long = "some words of a long text " * 100_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in cws.edit_report(docs).collect()}
    assert got[1].near_next == 1.0 and got[1].fingerprint == got[2].fingerprint
    assert got[1].n_chars == len(long) and got[3].near_next == 0.0


@pytest.mark.parametrize("n", [0, 1])
def test_hardly_any_documents(spark, n):
    docs = spark.createDataFrame([(5, "abcd efgh")] * n, "doc_id long, text string")
    got = cws.edit_report(docs).collect()
    assert len(got) == n
    if n:
        assert got[0].near_next == 1.0
        assert got[0].edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest()


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    plan = cws.edit_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
