"""Quality rules as weak supervision.

Each rule looks at one figure of a text and votes bad, votes good, or abstains. How
far a vote can be trusted is not stated but estimated: expectation-maximisation
over all documents finds the share of good documents and how often each rule casts
each vote on good and on bad ones. Rules that agree with others gain weight and
rules that stand alone lose it, and abstaining where others vote counts as well. A
document is kept by its posterior probability of being good.

Documents meet the model as vote patterns. There are at most 3 ** rules of them,
so what the driver works on is bounded however many documents there are.
"""

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillroll.llm.common import as_bytes, free_name, give_back, whole_text, written

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
# What running prose is made of in ASCII, besides digits.
MARKS = b".,;:?'\"()-"
PROSE = (string.ascii_letters + string.digits).encode() + MARKS
# Bytes of other scripts count as letters.
LETTERS = bytes(b if b < 128 else ord("a") for b in range(256))
BAD, GOOD, ABSTAIN = 0, 1, 2

# name, figure, which way is bad, the bound for a bad vote, the bound for a good one.
RULES = [
    ("symbols", "symbol_share", "up", 0.10, None),
    ("odd_characters", "odd_share", "up", 0.30, None),
    ("prose_words", "prose_share", "down", 0.70, 0.95),
    ("exclamations", "exclamation_share", "up", 0.20, None),
    ("capitals", "capital_share", "up", 0.40, None),
    ("repeated_words", "repeat_share", "up", 0.30, None),
    ("repeated_lines", "dup_line_share", "up", 0.30, None),
    ("stuttering", "stutter_share", "up", 0.05, None),
    ("variety", "distinct_share", "down", 0.20, 0.40),
    ("word_length", "word_length", "up", 15.0, None),
    ("digits", "digit_share", "up", 0.20, None),
]

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_FIGURES = "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ", votes: int>"


def _repeats(words):
    """Positions covered by a three-word window that occurs twice or more, words
    equal to the one before, and distinct words."""
    codes = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in words], dtype=np.int64)
    base = len(codes)
    again = int(np.count_nonzero(ids[1:] == ids[:-1]))
    if len(ids) < 4:
        return 0, again, base
    if base < 1 << 20:
        windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        _, pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)
        windows = pairs[:-1] * base + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0, again, base
    hit = np.zeros(len(windows), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum()), again, base


def figures(text):
    """The counts of one text given as UTF-8 bytes, and the rules' figures."""
    words = text.split()
    n = len(words)
    bare = b"".join(words)
    # Code points: bytes that do not continue one.
    chars = int(np.count_nonzero(np.frombuffer(bare, np.int8) >= -64))
    symbols = len(bare) - len(bare.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeated, again, distinct = _repeats(words)
    counts = (n, chars, symbols, dup_lines, repeated)
    octets = np.frombuffer(bare, np.uint8)
    upper = int(np.count_nonzero((octets >= 65) & (octets <= 90)))
    lower = int(np.count_nonzero((octets >= 97) & (octets <= 122)))
    as_letters = text.translate(LETTERS).split()
    prose = sum([w.strip(MARKS).isalnum() for w in as_letters])
    ascii_odd = bare.translate(None, PROSE)
    odd = int(np.count_nonzero(np.frombuffer(ascii_odd, np.uint8) < 128))
    digits = len(bare) - len(bare.translate(None, b"0123456789"))
    some = max(n, 1)
    return counts, {
        "n_words": n,
        "symbol_share": symbols / some,
        "odd_share": odd / some,
        "prose_share": prose / some,
        "exclamation_share": bare.count(b"!") / some,
        "capital_share": upper / max(upper + lower, 1),  # of the ASCII letters
        # Repeats in a few lines or words say little, so these two shares are damped.
        "repeat_share": repeated / (n + 30),
        "stutter_share": again / some,
        "dup_line_share": dup_lines / (len(lines) + 3),
        # Long texts repeat words; the share is of what a text of 200 words shows.
        "distinct_share": distinct / max(1, min(n, 200)),
        "word_length": chars / some,
        "digit_share": digits / max(chars, 1),
    }


def votes_of(found):
    """The rules' votes as one number in base three, the first rule lowest."""
    code = 0
    for _, figure, way, bad, good in reversed(RULES):
        x = found[figure] if way == "up" else -found[figure]
        sign = 1 if way == "up" else -1
        is_bad = x >= sign * bad
        is_good = good is not None and x <= sign * good
        code = code * 3 + (BAD if is_bad else GOOD if is_good else ABSTAIN)
    return code


def _measure_batch(texts: pa.Array) -> pa.Array:
    give_back()
    rows = []
    for text in as_bytes(texts):
        counts, found = figures(text)
        rows.append((*counts, votes_of(found)))
    table = np.array(rows, dtype=np.int64).reshape(-1, len(COUNTS) + 1)
    arrays = [pa.array(table[:, i]) for i in range(len(COUNTS))]
    arrays.append(pa.array(table[:, -1].astype(np.int32)))
    return pa.StructArray.from_arrays(arrays, names=[*COUNTS, "votes"])


def _measure(text):
    return F.arrow_udf(_measure_batch, _FIGURES)(text)


def _logit(p):
    return np.log(p) - np.log1p(-p)


def _chance(odds):
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


class LabelModel:
    """How good and bad documents are voted on, and the share of good ones.

    Before any data is seen three documents of four are good (``GOOD_SHARE``), and so
    is any without a vote; a vote is right eight times in ten (``TRUST``). That counts
    as ``PSEUDO`` documents for the share, for each kind of vote that occurs, and for
    abstaining, so it fades as documents come in and speaks where they say nothing:
    rules that never meet in a document cannot judge each other, and their votes stay
    at ``TRUST``, whatever share of the documents they hit. Rounds end when no posterior
    moves by ``SETTLED``: what still drifts then is not decided by the data.
    """

    ROUNDS, SETTLED = 300, 1e-3
    GOOD_SHARE, TRUST, PSEUDO = 0.75, 0.8, 5.0

    def __init__(self, share, rates):
        """``rates``: per class, rule and vote, how often the rule casts it there."""
        self.share, self.rates = share, rates

    @classmethod
    def fit(cls, patterns, counts):
        """``patterns``: one row of votes per pattern; ``counts``: documents of each."""
        patterns = np.asarray(patterns, dtype=np.int64).reshape(-1, len(RULES))
        counts = np.asarray(counts, dtype=np.float64)
        cast = np.stack([patterns == vote for vote in range(3)], axis=2).astype(float)
        occurs = np.einsum("p,prv->rv", counts, cast) > 0
        occurs[:, ABSTAIN] = True
        # Per class what the pseudo-documents vote.
        before = np.zeros((2, 3))
        before[BAD] = cls.TRUST, 1 - cls.TRUST, 1 - cls.GOOD_SHARE
        before[GOOD] = 1 - cls.TRUST, cls.TRUST, cls.GOOD_SHARE
        # At first a vote moves the odds from those of any document to its own.
        common, trust = _logit(cls.GOOD_SHARE), _logit(cls.TRUST)
        first = np.array([-trust - common, trust - common, 0.0])
        posterior = _chance(common + first[patterns].sum(axis=1))
        for _ in range(cls.ROUNDS):
            good = posterior * counts
            share = (good.sum() + cls.PSEUDO * cls.GOOD_SHARE) / (counts.sum() + cls.PSEUDO)
            rates = np.empty((2, len(RULES), 3))
            for kind, weight in ((BAD, counts - good), (GOOD, good)):
                votes = np.einsum("p,prv->rv", weight, cast) + cls.PSEUDO * before[kind] * occurs
                rates[kind] = votes / votes.sum(axis=1, keepdims=True)
            model = cls(share, np.clip(rates, 1e-9, 1.0))
            last, posterior = posterior, model.posterior(patterns)
            if np.abs(posterior - last).max(initial=0.0) < cls.SETTLED:
                break
        return model

    @property
    def trust(self):
        """How often each rule's votes are right, for (bad, good)."""
        weighed = self.rates * np.array([1 - self.share, self.share])[:, None, None]
        among = weighed / weighed.sum(axis=0)
        return np.stack([among[BAD, :, BAD], among[GOOD, :, GOOD]], axis=1)

    def weights(self):
        """Log odds for good: the constant, and one per rule and vote (bad, good, none)."""
        return float(_logit(self.share)), np.log(self.rates[GOOD]) - np.log(self.rates[BAD])

    def odds(self, patterns):
        """Log odds of each pattern for good."""
        constant, weights = self.weights()
        return constant + weights[np.arange(len(RULES)), np.asarray(patterns)].sum(axis=1)

    def posterior(self, patterns):
        return _chance(self.odds(patterns))

    def column(self, votes):
        """The posterior of a column of vote numbers, as an expression."""
        constant, weights = self.weights()
        odds = F.lit(constant)
        for r, row in enumerate(weights):
            vote = F.pmod(F.floor(votes / F.lit(3**r)), F.lit(3)).cast("int")
            options = F.array(*[F.lit(float(w)) for w in row])
            odds = odds + F.get(options, vote)
        return 1 / (1 + F.exp(-odds))


def fit_votes(rows, votes):
    """The label model of all rows' votes; at most 3 ** rules counts reach the driver."""
    found = rows.groupBy(F.col(votes).alias("votes")).agg(F.count(F.lit(1)).alias("n")).collect()
    found = sorted((r["votes"], r["n"]) for r in found)
    patterns = [[code // 3**r % 3 for r in range(len(RULES))] for code, _ in found]
    return LabelModel.fit(patterns, [n for _, n in found])


def _base_failed(n_words, repeated):
    return (n_words < MIN_WORDS) | (100 * repeated > 50 * n_words)


def judge(docs, doc_id="doc_id", text="text"):
    """Per row: ``doc_id``, the counts, ``base_failed``, ``kept``, ``quality`` (the posterior).

    NULL texts have no word and fail; NULL ids and repeated rows are judged like
    any other; equal texts get equal verdicts; an empty table gives no row. Texts of
    any length are read whole, each in one call. Other columns of ``docs`` are not
    read, so their names cannot clash.
    """
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"), _measure(whole_text(text)).alias("f")
        ).select("doc_id", "f.*"),
        "quality",
    )
    model = fit_votes(rows, "votes")
    failed = _base_failed(F.col("n_words"), F.col("n_repeat_words"))
    rows = rows.withColumn("base_failed", failed).withColumn(
        "quality", model.column(F.col("votes"))
    )
    kept = ~F.col("base_failed") & (F.col("quality") >= 0.5)
    return rows.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "quality")


def keep_good(docs, text="text"):
    """``docs`` without the rows that are judged bad, with all its columns.

    NULL and empty texts have no word and go; NULL ids and repeated rows stay or go by
    their text; an empty table stays empty; texts of any length are read whole. The
    figures ride along under a name that ``docs`` does not use, so none can clash.
    """
    name = free_name(docs, "quality_figures")
    rows = written(docs.withColumn(name, _measure(whole_text(text))), "quality")
    model = fit_votes(rows, f"{name}.votes")
    f = F.col(name)
    good = ~_base_failed(f["n_words"], f["n_repeat_words"]) & (model.column(f["votes"]) >= 0.5)
    return rows.where(good).select(*[F.col(f"`{c}`") for c in docs.columns])
