import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import kd_shards


def corpus(n, seed=1, copies=0):
    rng = random.Random(seed)
    rows = [(None, "no id"), (1, None), (2, ""), (3, "é" * 40)]
    for i in range(4, n):
        words = ["".join(rng.choices("abcdeé日", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60))]
        rows.append((i, rng.choice(rows[3:])[1] if i % 9 == 0 else " ".join(words)))
    return rows + [(i + 10**6, "copy of one text " * 9) for i in range(copies)] + [rows[5]] * 3


def weigh(rows):
    return [len((t or "").encode()) + 16 for _, t in rows]


@pytest.mark.parametrize("copies,shards", [(0, 40), (1500, 40), (0, 7), (0, 1)])
def test_shards_are_near_equal_and_slots_have_no_gap(spark, copies, shards):
    rows = corpus(3000, copies=copies)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, slot int")
    got = kd_shards.shard(docs.repartition(5), shards=shards).collect()
    want = Counter((d, w, zlib.crc32((t or "").encode())) for (d, t), w in zip(rows, weigh(rows)))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) == set(range(shards))
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [sum(r.size for r in own) for own in by_shard.values()]
    mean = np.mean(sizes)
    assert max(abs(s - mean) for s in sizes) <= 0.04 * mean + max(weigh(rows))
    # Equal texts are divided only if there are too many of them for one shard.
    texts = {}
    for r in got:
        texts.setdefault(r.text_crc32, []).append(r)
    limit = kd_shards.GROUP_TOLERANCE * mean
    for own in texts.values():
        if sum(r.size for r in own) <= limit:
            assert len({r.shard for r in own}) == 1


def test_split_of_a_plain_table_is_the_weighted_median(spark):
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.randint(1, 50)) for i in range(500)]
    table = spark.createDataFrame(rows, "place long, x double, size long").select(
        "place", "size", F.array("x", F.lit(0.0)).alias("dims"), F.lit(0.0).alias("tie"), "x"
    )
    got = kd_shards.grow(table, 2, 2).collect()
    left = [r for r in got if r.shard == 0]
    right = [r for r in got if r.shard == 1]
    assert max(r.x for r in left) < min(r.x for r in right)
    total = sum(r[2] for r in rows)
    assert abs(sum(r["size"] for r in left) - total / 2) <= 50


def slow_tree(rows, shards):
    """The shard of each (place, size, dims, tie), a document at a time."""
    total = sum(r[1] for r in rows)
    dims = range(len(rows[0][2]))

    def extent(own, i):
        return max(r[2][i] for r in own) - min(r[2][i] for r in own)

    spans = [extent(rows, i) or 1e-300 for i in dims]

    def split(own, n, first):
        if not own or n == 1:
            return {r[0]: first for r in own}
        dim = max(dims, key=lambda i: (extent(own, i) / spans[i], -i))
        own = sorted(own, key=lambda r: (r[2][dim], r[3], r[0]))
        goal = sum(r[1] for r in own) * (n - n // 2) / n
        groups, at = {}, 0
        for i, r in enumerate(own):
            groups.setdefault((r[2][dim], r[3]), []).append(i)
        for held in groups.values():
            size = sum(own[i][1] for i in held)
            if at + size >= goal:
                break
            at += size
        allowed = kd_shards.GROUP_TOLERANCE * total / shards * (n // 2)
        if min(goal - at, at + size - goal) > allowed:
            for i in held:
                held, size = [i], own[i][1]
                if at + size >= goal:
                    break
                at += size
        cut = held[0] if goal - at <= at + size - goal else held[-1] + 1
        half = n - n // 2
        return split(own[:cut], half, first) | split(own[cut:], n // 2, first + half)

    return split(rows, shards, 0)


@pytest.mark.parametrize("shards,copies", [(7, 60), (40, 150)])
def test_tree_against_a_slow_one(spark, shards, copies):
    rng = random.Random(shards)
    kinds = [(rng.randint(20, 400), (float(rng.randint(0, 30)), rng.random()), float(i)) for i in range(900)]
    chosen = [rng.choice(kinds) for _ in range(900)] + [kinds[5]] * copies + [kinds[6]] * (copies // 5)
    rng.shuffle(chosen)
    rows = [(i, size, dims, tie) for i, (size, dims, tie) in enumerate(chosen)]
    table = spark.createDataFrame(
        [(p, s, list(d), t) for p, s, d, t in rows], "place long, size long, dims array<double>, tie double"
    )
    got = {r.place: r.shard for r in kd_shards.grow(table.repartition(3), shards, 2).collect()}
    assert got == slow_tree(rows, shards)


def test_very_long_texts_and_clashing_names(spark):
    rows = [(i, "short " * (i % 7), "a", 1.0) for i in range(300)] + [(900, "long text " * 300_000, "b", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, dims double")
    got = kd_shards.shard(docs, shards=2).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.size for r in got}[900] == 3_000_016


def test_copies_are_divided_only_if_they_fit_on_no_side(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = kd_shards.shard(docs)
    texts = got.join(docs.select("doc_id", "text"), "doc_id").groupBy("text")
    divided = texts.agg(F.countDistinct("shard").alias("n"), F.count("*").alias("rows"))
    assert divided.where("n > 1").count() <= 2


def test_numbering_in_parts(spark, monkeypatch):
    monkeypatch.setattr(kd_shards, "SLOTS_AT_ONCE", 7)
    docs = spark.createDataFrame(corpus(200), "doc_id long, text string")
    by_shard = {}
    for r in kd_shards.shard(docs, shards=3).collect():
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in by_shard.values())


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_documents_than_shards(spark, n):
    rows = [(i, "same") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = kd_shards.shard(docs).collect()
    assert len(got) == n and all(0 <= r.shard < 40 for r in got)
