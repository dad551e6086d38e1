import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import additive_model as additive
from tillroll.llm.common import importable
from tillroll.llm.queries import op11_additive_model

PROSE = "The harbour was quiet before the boats came in, and nobody on the long pier spoke. "


def slow_figures(text):
    raw = (text or "").encode()
    words = raw.split()
    n, bare = len(words), b"".join(words)
    some, inside = max(n, 1), max(len(bare), 1)

    def share(kinds):
        return sum(b in kinds for b in bare) / inside

    upper = sum(65 <= b <= 90 for b in raw)
    lower = sum(97 <= b <= 122 for b in raw)
    return [
        math.log1p(n),
        len(bare) / some,
        upper / max(upper + lower, 1),
        share(b"0123456789"),
        share(b".?"),
        share(b",;:"),
        share(b"!"),
        share(b"|"),
        share(b"#$%&*+/<=>@\\^_`{}~[]"),
        share(range(128, 256)),
        len(set(words)) / min(max(n, 1), 200),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / some,
        max(Counter(words).values(), default=0) / some,
        sum(len(w) <= 3 for w in words) / some,
        sum(len(w) >= 12 for w in words) / some,
        raw.count(b"\n") / some,
    ]


TEXTS = ["", " \n\t", "a", "A a a B! | # é", PROSE * 9, "x y\nx y\n" * 400, "日本語テキスト " * 3]


def test_figures():
    got = additive.figures(pa.array(TEXTS))
    assert np.allclose(got, [slow_figures(t) for t in TEXTS])
    # A text's figures do not depend on its batch.
    alone = np.concatenate([additive.figures(pa.array([t])) for t in TEXTS])
    assert (alone == got).all()


def slow_odds(model, row):
    """The tables, entry by entry."""
    total = model.intercept
    for i, value in enumerate(row):
        total += model.tables[i][sum(value >= c for c in model.cuts[i])]
    for (i, j), table in model.pairs.items():
        at = [sum(row[k] >= c for c in model.pair_cuts[k]) for k in (i, j)]
        total += table[at[0]][at[1]]
    return total


def sample(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(additive.FIGURES)))
    x[:, 5] = rng.integers(0, 2, n)
    # One feature alone, and two that count only together.
    odds = 6 * (x[:, 0] > 0.3) - 3 + 5 * np.where((x[:, 2] > 0.5) == (x[:, 3] > 0.5), 1, -1)
    return x, (odds > rng.logistic(0, 0.5, n)).astype(int)


def test_tables_are_added_up():
    x, y = sample(600)
    model = additive.AdditiveModel.fit(x, y)
    assert np.allclose(model.odds(x), [slow_odds(model, row) for row in x])


def test_single_features_and_pairs_are_learned():
    x, y = sample()
    model = additive.AdditiveModel.fit(x, y)
    fresh, truth = sample(seed=1)
    right = ((model.score(fresh) >= 0.5) == truth).mean()
    assert (2, 3) in model.pairs
    alone = additive.AdditiveModel(model.intercept, model.cuts, model.tables, model.pair_cuts, {})
    assert right > 0.93 > 0.8 > ((alone.score(fresh) >= 0.5) == truth).mean()


def test_best_cut_and_tree_by_trying_all():
    rng = np.random.default_rng(2)
    cls = additive.AdditiveModel
    for _ in range(50):
        g, h = rng.normal(size=9), rng.random(9) * 4 + 0.1

        def worth(a, b):
            return g[a:b].sum() ** 2 / (h[a:b].sum() + cls.RIDGE)

        tried = {
            c: worth(0, c) + worth(c, 9) - worth(0, 9)
            for c in range(1, 9)
            if min(h[:c].sum(), h[c:].sum()) >= cls.LEAST
        }
        gain, at = cls._best_cut(g, h)
        if tried and max(tried.values()) > 0:
            assert np.isclose(gain, max(tried.values())) and np.isclose(tried[at], gain)
        step = cls._tree(g, h)
        assert len(np.unique(step.round(12))) <= 3


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)], [(1, None), (None, 1)]])
def test_labels_of_one_kind_or_none(spark, labels):
    importable(spark)
    docs = spark.createDataFrame([(i, PROSE) for i in range(4)], "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = additive.score_quality(docs, table).collect()
    known = [q for d, q in labels if d is not None and q is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    assert {round(r.score, 9) for r in rows} == {round((sum(known) + 1) / (len(known) + 2), 9)}


def test_odd_rows(spark):
    importable(spark)
    good = [(i, PROSE * (i % 5 + 1), "x", 1.0) for i in range(10, 200)]
    bad = [(i, "BUY!! ### NOW!! | " * (i % 7 + 3), "y", 2.0) for i in range(200, 400)]
    rows = [
        (None, None, None, None),
        (None, "", "z", 0.0),
        (1, PROSE * 30_000, "long", None),
        (2, "same text", "a", 0.0),
        (2, "same text", "b", 0.0),
    ]
    docs = spark.createDataFrame(
        rows + good + bad, "doc_id long, text string, words string, SCORE double"
    ).repartition(4)
    labels = spark.createDataFrame(
        [(d, int(d < 200), 0) for d, *_ in good + bad] * 2 + [(10, 0, 1)],
        "doc_id long, quality int, held_out int",
    )
    got = additive.score_quality(docs, labels).collect()
    assert len(got) == len(rows + good + bad)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(
        r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        for r in got
    )
    by_id = {r.doc_id: r.score for r in got}
    assert all(by_id[d] > 0.7 for d, *_ in good) and all(by_id[d] < 0.7 for d, *_ in bad)
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    # Neither layout nor order matters.
    again = additive.score_quality(docs.repartition(1), labels.repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_a_smaller_sample(spark):
    importable(spark)
    docs = spark.createDataFrame(
        [(i % 3, f"{PROSE} {i}") for i in range(300)], "doc_id long, text string"
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)] * 20, "doc_id long, label int")
    model = additive.fit_on(additive.measured(docs), labels, sample=50)
    assert all(len(c) < 50 for c in model.cuts)


def test_no_documents(spark):
    importable(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    assert additive.score_quality(none, labels).count() == 0


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op11_additive_model(spark, folder).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 0]) < 0.1
