import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import context_tree as ctw


def lg_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class SlowTrees:
    """One context tree per choice over the byte streams of texts, solved by recursion
    from the definition."""

    def __init__(self, texts):
        counts = Counter((0, t) for t in texts)
        self.seen = defaultdict(lambda: [0, 0])
        self.after = defaultdict(set)
        for (kind, word), n in counts.items():
            for context, byte in self.bytes_of(kind, word):
                for choice, bit in self.bits(byte):
                    for d in range(ctw.DEPTH + 1):
                        own = context[ctw.DEPTH - d :]
                        self.seen[choice, own][bit] += n
                        if d < ctw.DEPTH:
                            self.after[choice, own].add(context[ctw.DEPTH - d - 1 :])
        self.memo = {}

    @staticmethod
    def bytes_of(kind, text):
        return streams(text)

    @staticmethod
    def bits(byte):
        node = 1
        for k in range(7, -1, -1):
            bit = byte >> k & 1
            yield node, bit
            node = node * 2 + bit

    def log_p(self, choice, context):
        key = (choice, context)
        if key not in self.memo:
            a, b = self.seen.get(key, (0, 0))
            kt = lg_kt(a, b)
            if len(context) == ctw.DEPTH or not a + b:
                self.memo[key] = kt
            else:
                below = sum(self.log_p(choice, c) for c in self.after[key])
                self.memo[key] = float(np.logaddexp(kt, below)) - math.log(2)
        return self.memo[key]

    def chance(self, choice, context, depth=0):
        """The mixture's chance of a one."""
        own = context[ctw.DEPTH - depth :]
        a, b = self.seen.get((choice, own), (0, 0))
        if not a + b:
            return 0.5
        kt = (b + 0.5) / (a + b + 1)
        if depth == ctw.DEPTH:
            return kt
        weight = math.exp(lg_kt(a, b) - math.log(2) - self.log_p(choice, own))
        return weight * kt + (1 - weight) * self.chance(choice, context, depth + 1)

    def word(self, kind, word):
        total = 0.0
        for context, byte in self.bytes_of(kind, word):
            for choice, bit in self.bits(byte):
                p = self.chance(choice, context)
                total += math.log10(p if bit else 1 - p)
        return total


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [ctw.END]


def streams(text):
    coded = b"\n" * ctw.DEPTH + b"".join(w + b" " for w in tokens(text)[:-1]) + b"\n"
    for i in range(ctw.DEPTH, len(coded)):
        yield coded[i - ctw.DEPTH : i], coded[i]


def slow_scores(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows]
    learned = [t or "" for (_, t), h in zip(rows, held, strict=True) if not h]
    train = Counter(w for t in learned for w in tokens(t))
    trees, total, out = SlowTrees(learned), sum(train.values()), []
    for (doc, text), h in zip(rows, held, strict=True):
        words = tokens(text)
        base = sum(
            math.log10((train[w] + 0.1) / (total + 0.1 * (len(train) + 1))) for w in words
        )
        known = sum(w in train for w in words)
        out.append((doc, h, len(words), known, total, base, trees.word(0, text or "")))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    kinds = [["ka", "To", "mi", "ren", "é"], ["日", "x1", "-", "\x00", "ka"]]
    common = [["and", "the", "ka"], ["und", "der"]]
    rows = [(None, "no ID"), (3, None), (4, ""), (5, "\n \t\x0b"), (6, "Mi mi MI mi\x85mi")]
    for i in range(7, n):
        syllables, often = kinds[i % 2], common[i % 2]
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 30))]
        words += rng.choices(often, k=rng.randint(0, 9))
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    return rows + [rows[9], (9, "k" * 3000)]


def test_the_next_byte_has_a_whole_distribution():
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(30)) for _ in range(9)]
    grams, _ = ctw.text_windows(pa.array(texts))
    grams, counts = np.unique(grams, return_counts=True)
    nodes = ctw._below_top(pa.table({"gram": grams, "n": counts}))
    crown = ctw.Crown.solve(*[nodes[c].to_numpy() for c in ("key", "zeros", "ones", "log_p")])
    found = ctw.levels(grams, counts, ctw.TOP)
    for context in (b"\n" * 6, b"bcabc ", b"zzzzzz", b"ab  ab", b"zzzzza", b"xxxxcb", b"xxxacb"):
        start = int.from_bytes(context, "big") << 8
        logs = ctw.log_chances(np.arange(start, start + 256), found, crown)
        assert (10.0**logs).sum() == pytest.approx(1)


def test_buckets_do_not_change_the_chances(spark, monkeypatch):
    """Windows of one common ending are dealt to many buckets."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abc", k=3)) for _ in range(40)) for _ in range(20)]
    grams, counts = np.unique(ctw.text_windows(pa.array(texts))[0], return_counts=True)
    rows = [(int(g), int(c), int(c)) for g, c in zip(grams, counts, strict=True)]
    table = spark.createDataFrame(rows, "gram long, n long, n_all long").cache()
    whole = {r.gram: r.log_chance for r in ctw.gram_chances(table).collect()}
    monkeypatch.setattr(ctw, "BUCKET_WINDOWS", 20)
    dealt = {r.gram: r.log_chance for r in ctw.gram_chances(table).collect()}
    assert set(whole) == set(dealt) == {r[0] for r in rows}
    assert all(dealt[g] == pytest.approx(whole[g], rel=1e-9) for g in whole)


@pytest.mark.parametrize("most", [0, 1, 5, 100, 2_900, 3_000, 10_000])
def test_the_count_that_few_have(spark, most):
    rng = random.Random(1)
    counts = [int(2 ** rng.uniform(0, 40)) for _ in range(1000)] + [1, 2, 3, 7, 8, 64, 65] * 300
    table = spark.createDataFrame([(c,) for c in counts], "n_all long").cache()
    least = ctw._at_least(table, most)
    assert sum(c >= least for c in counts) <= most
    assert least == 1 or sum(c >= least - 1 for c in counts) > most


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_lookup(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 56, n))
    # Many in a row, which hash alike or next to each other, and some that are not there.
    keys = np.unique(np.concatenate([keys, np.arange(3 * n)]))
    table = ctw.Lookup(keys)
    asked = np.concatenate([keys, keys + 1, rng.integers(0, 1 << 56, 50)])
    place = {int(k): i for i, k in enumerate(keys)}
    assert table.find(asked).tolist() == [place.get(int(k), -1) for k in asked]


def test_windows_are_those_of_the_streams():
    texts = ["", " \n", "a", "Ab  cD\té", "x" * 5000, "日本 語"]
    grams, of = ctw.text_windows(pa.array(texts))
    want = [
        (int.from_bytes(context + bytes([byte]), "big"), i)
        for i, t in enumerate(texts)
        for context, byte in streams(t)
    ]
    assert list(zip(grams.tolist(), of.tolist(), strict=True)) == want


@pytest.mark.parametrize("x", [0.5, 1, 1.5, 7.5, 100.5, 1e6 + 0.5, 1e12 + 0.5])
def test_log_gamma(x):
    assert float(ctw.log_gamma(x)) == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("frequent,held", [(3, 0), (3, 40), (ctw.FREQUENT, ctw.WINDOWS_HELD)])
def test_scores_of_whole_texts_equal_the_definition(spark, frequent, held):
    rows = corpus(1, 40)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    want = slow_scores(rows)
    for parts in (1, 4):  # and the layout does not count
        got = ctw.score_texts(docs.repartition(parts), frequent=frequent, windows_held=held).collect()
        assert len(got) == len(want)
        for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
            assert a[:5] == b[:5]
            assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)


def test_the_order_of_words_counts(spark):
    texts = ["the cat sat on the mat and ran home"] * 30 + ["home the ran mat and on cat sat the"]
    docs = spark.createDataFrame([(i, t, i >= 29) for i, t in enumerate(texts)], "doc_id long, text string, h boolean")
    fluent, salad = ctw.score_texts(docs, held_out=docs["h"]).where("doc_id >= 29").orderBy("doc_id").collect()
    assert fluent.base_score == pytest.approx(salad.base_score)
    assert fluent.score > salad.score + 5


def test_whole_texts_beat_words_alone_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = ctw.score_texts(docs).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(0 < r.bits_per_byte < 8 for r in rows)


def test_whole_texts_without_training_or_documents(spark):
    docs = spark.createDataFrame([(1, "ab c", True), (2, None, True)], "doc_id long, text string, h boolean")
    rows = ctw.score_texts(docs, held_out=docs["h"]).collect()
    assert [r.bits_per_byte for r in rows] == pytest.approx([8.0, 8.0])
    assert [(r.n_known, r.train_tokens) for r in rows] == [(0, 0)] * 2
    assert ctw.score_texts(docs.limit(0).drop("h")).count() == 0


def test_white_space_does_not_count(spark):
    texts = ["a  b\nc", "a b c", " a\tb c\n"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert len({round(r.score, 9) for r in ctw.score_texts(docs).collect()}) == 1


@pytest.mark.parametrize("held", [10, 200, 10**6])
def test_counts_do_not_depend_on_what_a_task_holds(monkeypatch, held):
    rng = random.Random(7)
    texts = [" ".join(rng.choices(["ab", "abc", "cb", "é"], k=rng.randint(0, 30))) for _ in range(50)]
    out = [rng.random() < 0.3 for _ in texts]
    monkeypatch.setattr(ctw, "HELD", held)
    monkeypatch.setattr(ctw, "STREAM_AT_ONCE", 100)
    batch = pa.RecordBatch.from_pydict({"held_out": pa.array(out), "text": pa.array(texts)})
    got, want = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for part in ctw._count_windows([batch, batch]):
        for row in part.to_pylist():
            got[row["gram"]][0] += row["n_train"]
            got[row["gram"]][1] += row["n_all"]
    for text, h in zip(texts, out, strict=True):
        for context, byte in streams(text):
            gram = int.from_bytes(context + bytes([byte]), "big")
            want[gram][0] += 2 * (not h)
            want[gram][1] += 2
    assert got == want


def test_counts_of_windows_come_in_small_batches(monkeypatch):
    monkeypatch.setattr(ctw, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(ctw, "HELD", 40)
    monkeypatch.setattr(ctw, "STREAM_AT_ONCE", 100)
    texts = [" ".join(f"w{i * j % 37}" for j in range(60)) for i in range(5)]
    batch = pa.RecordBatch.from_pydict({"held_out": [False, True, False, True, False], "text": texts})
    parts = list(ctw._count_windows([batch, batch]))
    assert max(p.num_rows for p in parts) == 7
    got = {}
    for row in (r for p in parts for r in p.to_pylist()):
        n, n_all = got.get(row["gram"], (0, 0))
        got[row["gram"]] = n + row["n_train"], n_all + row["n_all"]
    grams, of = ctw.text_windows(batch["text"])
    want = {}
    for gram, doc in zip(grams.tolist(), of.tolist(), strict=True):
        n, n_all = want.get(gram, (0, 0))
        want[gram] = n + 2 * (doc % 2 == 0), n_all + 2
    assert got == want
