import random
import re

import numpy as np
import pytest
import xxhash

from tillroll.llm import simhash

WORDS = [f"w{i}" for i in range(300)]


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """By comparing every pair."""
    prints = [slow_print(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group[max(root(i), root(j))] = min(root(i), root(j))
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if root(k) == root(i) and d is not None]
        out.append((doc, f"{prints[i]:016x}", min(ids, default=None)))
    return out


def corpus(seed, n=160):
    rng = random.Random(seed)
    rows = [(None, "No id here"), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "ONE")]
    for i in range(8, n):
        if i % 3 and len(rows) > 12:
            words = (rng.choice(rows[8:])[1] or "x").split(" ")
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
        else:
            words = [rng.choice(WORDS) for _ in range(rng.choice([3, 4, 60, 400]))]
        rows.append((i, " ".join(words)))
    rows += [rows[20], rows[20], (9, "same id, other text"), (10**6, "ß É \x85 \xa0 x y z " * 9)]
    return rows


@pytest.mark.parametrize("text", ["", " ", "a", "a b c", "a b c d", "A b C d e" * 50, "É ß\x85x 日本"])
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint(text.encode()) == slow_print(text)


def test_components_match_all_pairs(spark):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(docs).select(
        "doc_id", simhash.fingerprint_hex("fp").alias("f"), "component_id"
    )
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(slow_components(rows), key=key)


@pytest.mark.parametrize("chunk", [3, 50])
def test_hot_buckets_are_split_without_losing_links(spark, chunk):
    """Fingerprints around one point: nearly all share their buckets."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 150:
        x = rng.choice(sorted(prints))
        for _ in range(rng.randint(1, 6)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    signed = [int(np.uint64(x).astype(np.int64)) for x in sorted(prints)]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash.print_links(frame, len(signed), chunk=chunk).collect()
    group = {x: x for x in signed}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        group[max(root(a), root(b))] = min(root(a), root(b))
    got = {x: root(x) for x in signed}
    for x in signed:
        for y in signed:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= 4:
                assert got[x] == got[y]
    want = {x: x for x in signed}
    changed = True
    while changed:
        changed = False
        for x in signed:
            least = min(
                want[y] for y in signed if ((x ^ y) & (2**64 - 1)).bit_count() <= 4
            )
            if least < want[x]:
                want[x], changed = least, True
    assert got == want


def test_tasks_follow_the_members_of_cells(spark):
    rng = random.Random(7)
    frame = spark.createDataFrame([(rng.getrandbits(24),) for _ in range(300)], "fp long").distinct()
    distinct = frame.count()
    usual = simhash.print_links(frame, distinct, chunk=20)
    spread = simhash.print_links(frame, distinct, chunk=20, at_once=100)
    # Each fingerprint is in a cell of every table at least, and in more of hot buckets.
    masks = len(simhash.block_masks(4, simhash.kept_blocks(distinct, 4)))
    assert usual.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread.rdd.getNumPartitions() > distinct * masks / 100
    found = [simhash.component_roots(links).collect() for links in (usual, spread)]
    assert sorted(found[0]) == sorted(found[1]) and found[0]


@pytest.mark.parametrize("distinct", [0, 1, 1000, 10**6, 10**9, 10**12])
def test_blocks_hold_every_pair_within_the_radius(distinct):
    masks = simhash.block_masks(4, simhash.kept_blocks(distinct, 4))
    rng = random.Random(distinct)
    for _ in range(200):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(flips & m == 0 for m in masks)


def test_one_row_of_each_group_stays(spark):
    rows = [(i, t, "x", -1) for i, t in corpus(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, FP string, simhash_print int")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    parts = {}
    for doc, f, least in slow_components([r[:2] for r in rows]):
        parts.setdefault(least, []).append(doc)
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == set(parts)
    # Texts that share an id but no link are groups of their own.
    assert len(ids) - len(set(ids)) <= 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0
