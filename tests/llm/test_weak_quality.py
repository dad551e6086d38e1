import math
import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import weak_quality as quality

PROSE = "The harbour was quiet before the boats came in, and nobody on the long pier spoke. "


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \n\t\x0b\x0c\r ",
    "one",
    "a b c",
    "a b c a b c",
    "a a a a a",
    "x y x y x y # $ é\x85ü \x1c z",
    "line one\nline one\nline one \n\n\n \n \nother",
    PROSE * 20,
    "日本 語 日本 語 日本 語|<>",
    "w " * 30000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert quality.figures((text or "").encode())[0] == slow_counts(text)


def test_judge_over_a_table(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a b c", None), (3, "one", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string")
    got = quality.judge(docs).collect()
    assert len(got) == len(rows)
    for doc, text, _ in rows:
        n, chars, symbols, lines, repeated = slow_counts(text)
        failed = n < 50 or 100 * repeated > 50 * n
        assert any(
            tuple(r)[:7] == (doc, n, chars, symbols, lines, repeated, failed)
            and not (failed and r.kept)
            for r in got
        )
    # The column form of the posterior equals the model's own.
    staged = docs.select(quality._measure(quality.whole_text("text")).alias("f")).select("f.votes")
    model = quality.fit_votes(staged, "votes")
    for r in staged.withColumn("p", model.column(staged["votes"])).collect():
        pattern = [[r.votes // 3**k % 3 for k in range(len(quality.RULES))]]
        assert abs(model.posterior(pattern)[0] - r.p) < 1e-9


def test_trust_is_found_from_agreement():
    """Rules 0 to 2 agree about hidden classes; rule 3 votes bad at random."""
    rng = np.random.default_rng(1)
    n, rules = 20000, len(quality.RULES)
    bad = rng.random(n) < 0.2
    votes = np.full((n, rules), quality.ABSTAIN)
    for r in range(3):
        votes[bad & (rng.random(n) < 0.9), r] = quality.BAD
    votes[rng.random(n) < 0.1, 3] = quality.BAD
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.LabelModel.fit(patterns, counts)
    assert (model.trust[:3, quality.BAD] > 0.9).all()
    assert model.trust[3, quality.BAD] < 0.7
    verdict = model.posterior(votes) < 0.5
    assert (verdict == bad).mean() > 0.95


def slow_model(votes):
    """Expectation-maximisation a document at a time; the posterior of each."""
    rules = len(quality.RULES)
    share, trust, pseudo = 0.75, 0.8, 5
    right = {0: {0: trust, 1: 1 - trust, 2: 1 - share}, 1: {0: 1 - trust, 1: trust, 2: share}}

    def odds(p):
        return math.log(p / (1 - p))

    good = []
    for own in votes:
        x = odds(share)
        for v in own:
            x += {0: -odds(trust) - odds(share), 1: odds(trust) - odds(share), 2: 0}[v]
        good.append(1 / (1 + math.exp(-x)))
    while True:
        part = (sum(good) + pseudo * share) / (len(votes) + pseudo)
        rate = {}
        for r in range(rules):
            kinds = {own[r] for own in votes} | {2}
            for c in (0, 1):
                n = {
                    v: pseudo * right[c][v] + sum(g if c else 1 - g for g, o in zip(good, votes, strict=True) if o[r] == v)
                    for v in kinds
                }
                rate |= {(c, r, v): n[v] / sum(n.values()) for v in kinds}
        before = good
        good = []
        for own in votes:
            x = odds(part) + sum(math.log(rate[1, r, v] / rate[0, r, v]) for r, v in enumerate(own))
            good.append(1 / (1 + math.exp(-x)))
        if max(abs(a - b) for a, b in zip(good, before, strict=True)) < 1e-3:
            return good


@pytest.mark.parametrize("seed", range(4))
def test_model_against_a_slow_one(seed):
    rng = np.random.default_rng(seed)
    votes = []
    for _ in range(150):
        hit = rng.random() < 0.1 + 0.2 * seed
        odd = rng.random(len(quality.RULES))
        votes.append([0 if x < (0.5 if hit else 0.05) else 1 if r == 2 and not hit else 2 for r, x in enumerate(odd)])
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.LabelModel.fit(patterns, counts)
    assert np.abs(model.posterior(patterns)[at.ravel()] - slow_model(votes)).max() < 1e-9


def test_verdicts_against_a_slow_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    found = {d: quality.figures(t) for d, t in texts.items()}
    votes = {d: [quality.votes_of(f) // 3**r % 3 for r in range(len(quality.RULES))] for d, (_, f) in found.items()}
    good = dict(zip(votes, slow_model(list(votes.values())), strict=True))
    for r in quality.judge(docs).collect():
        n, repeated = found[r.doc_id][0][0], found[r.doc_id][0][4]
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert r.kept == (not r.base_failed and good[r.doc_id] >= 0.5)


@pytest.mark.parametrize("others", [[], [2, 8]])
@pytest.mark.parametrize("junk", [100, 1000, 5000, 9000])
def test_junk_that_trips_one_rule_alone(junk, others):
    """It goes, be it little or most of the corpus, and the rest stays."""
    fine = [quality.GOOD if r in others else quality.ABSTAIN for r in range(len(quality.RULES))]
    bad = list(fine)
    bad[3] = quality.BAD
    model = quality.LabelModel.fit([fine, bad], [10_000 - junk, junk])
    kept, gone = model.posterior([fine, bad])
    assert kept > 0.7 and gone < 0.35


def test_an_odd_language_is_not_junk():
    """A third of the documents get no good vote; a few trip four rules at once."""
    rules = len(quality.RULES)
    fine = [quality.GOOD if r in (2, 8) else quality.ABSTAIN for r in range(rules)]
    odd = [quality.GOOD if r == 8 else quality.ABSTAIN for r in range(rules)]
    bad = [quality.BAD if r < 4 else quality.ABSTAIN for r in range(rules)]
    model = quality.LabelModel.fit([fine, odd, bad], [6500, 3300, 200])
    assert list(model.posterior([fine, odd, bad]) >= 0.5) == [True, True, False]
    assert abs(model.share - 0.98) < 0.01


def test_agrees_with_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    judged = quality.judge(docs).where("NOT base_failed").drop("quality").join(labels, "doc_id")
    rows = judged.select("kept", "quality").collect()
    good = [r.kept for r in rows if r["quality"] == 1]
    bad = [r.kept for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_only_good_rows_stay(spark):
    junk = "BUY!! NOW!! $$$ ### *** CHEAP!! | PILLS!! | " * 20
    rows = [(1, PROSE * 8, "a"), (2, junk, "b"), (3, None, "c"), (4, PROSE * 9, None)]
    prose = [(i, " ".join(f"word{j % 57}x" for j in range(i)), "z") for i in range(60, 160)]
    docs = spark.createDataFrame(rows + prose, "doc_id long, text string, quality_figures string")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 2 not in ids and 3 not in ids


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judge(docs).count() == 0
    assert quality.keep_good(docs).count() == 0
