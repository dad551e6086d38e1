"""Quality classifier: a generalised additive model with pairwise interactions.

A text is seen as sixteen figures (shares of kinds of characters, of words, of repeats).
Each figure has a lookup table over its bins, learned by boosting: in turn, feature
after feature and round after round, a tree of three leaves at most is fitted to what
the model so far gets wrong, and its leaves are added to the feature's table. The pairs
of features with most left to explain then get tables over two figures in the same
way. A score is the sum of table entries, made into a probability.

The texts are read once, and their figures written. The model is fitted on the driver, on
the figures of at most ``sample`` labelled rows, chosen by a hash of the id; every row
is scored from its written figures by adding up table entries, batch by batch.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, numbered_words, written

SAMPLE = 20_000  # labelled rows that the model is fitted on
THRESHOLD = 0.7

FIGURES = [
    "words",  # log of their number
    "word_bytes",  # mean
    "capitals",  # of the ASCII letters
    "digits",  # this and the next five: of the bytes in words
    "stops",
    "commas",
    "exclamations",
    "bars",
    "symbols",
    "high",  # bytes beyond ASCII
    "distinct",  # of the first 200 words' worth
    "stutters",  # words equal to the one before
    "commonest",  # the share of the most common word
    "short_words",  # of three bytes or fewer
    "long_words",  # of twelve bytes or more
    "lines",  # per word
]


def _classes():
    """For each byte the counted kinds it belongs to, one row per kind."""
    kinds = [
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"abcdefghijklmnopqrstuvwxyz",
        b"0123456789",
        b".?",
        b",;:",
        b"!",
        b"|",
        b"#$%&*+/<=>@\\^_`{}~[]",
        bytes(range(128, 256)),
        b"\n",
    ]
    kind = np.full(256, len(kinds), dtype=np.uint8)
    for row, members in enumerate(kinds):
        kind[list(members)] = row
    return kind, len(kinds)


KIND, KINDS = _classes()


def _per_text(owner, n_texts, weights=None):
    return np.bincount(owner, weights=weights, minlength=n_texts)


def figures(texts):
    """The figures of an Arrow text column, one row per text."""
    n = len(texts)
    raw = texts.cast(pa.binary()).to_pylist()
    counts = np.zeros((n, KINDS))
    for row, text in enumerate(raw):
        found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        counts[row] = np.bincount(KIND, weights=found, minlength=KINDS + 1)[:KINDS]
    upper, lower, digits, stops, commas, shouts, bars, symbols, high, lines = counts.T

    vocabulary, numbers, n_words = numbered_words(texts)
    owner = np.repeat(np.arange(n), n_words)
    sizes = np.array([len(w) for w in vocabulary], dtype=np.int64)[numbers]
    inside = np.maximum(_per_text(owner, n, sizes), 1)
    some = np.maximum(n_words, 1)
    again = (numbers[1:] == numbers[:-1]) & (owner[1:] == owner[:-1])
    kinds = max(len(vocabulary), 1)
    pairs, often = np.unique(owner * kinds + numbers, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, pairs // kinds, often)
    return np.stack(
        [
            np.log1p(n_words),
            _per_text(owner, n, sizes) / some,
            upper / np.maximum(upper + lower, 1),
            digits / inside,
            stops / inside,
            commas / inside,
            shouts / inside,
            bars / inside,
            symbols / inside,
            high / inside,
            _per_text(pairs // kinds, n) / np.clip(n_words, 1, 200),
            _per_text(owner[1:][again], n) / some,
            most / some,
            _per_text(owner, n, sizes <= 3) / some,
            _per_text(owner, n, sizes >= 12) / some,
            lines / some,
        ],
        axis=1,
    )


def _measured(batches):
    for batch in batches:
        table = figures(batch["text"])
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch["doc_id"]}
            | {name: pa.array(table[:, i]) for i, name in enumerate(FIGURES)}
        )


def measured(docs, doc_id="doc_id", text="text"):
    """``doc_id`` and the figures of every row."""
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{name} double" for name in FIGURES)])
    return rows.mapInArrow(_measured, schema)


def _chance(odds):
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


class AdditiveModel:
    """An intercept, a table per feature, and a table per chosen pair of features."""

    BINS, PAIR_BINS = 32, 8
    ROUNDS, PAIR_ROUNDS, PAIRS = 60, 30, 8
    RATE, RIDGE, LEAST = 0.15, 1.0, 2.0  # LEAST: hessian in a leaf, a few rows' worth

    def __init__(self, intercept, cuts, tables, pair_cuts, pairs):
        self.intercept = intercept
        self.cuts, self.tables = cuts, tables
        self.pair_cuts, self.pairs = pair_cuts, pairs  # pairs: {(i, j): table}

    def odds(self, x):
        """Log odds of each row of figures: additions of table entries."""
        total = np.full(len(x), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[i], x[:, i], side="right")]
        bins = [
            np.searchsorted(cut, x[:, i], side="right") for i, cut in enumerate(self.pair_cuts)
        ]
        for (i, j), table in self.pairs.items():
            total += table[bins[i], bins[j]]
        return total

    def score(self, x):
        return _chance(self.odds(x))

    @staticmethod
    def cut_points(values, bins):
        """Bounds between at most ``bins`` bins of about equally many rows; equal
        values share a bin."""
        kinds = np.unique(values)
        if len(kinds) <= bins:
            return (kinds[1:] + kinds[:-1]) / 2
        return np.unique(np.quantile(values, np.arange(1, bins) / bins))

    @classmethod
    def _worth(cls, g, h):
        return g * g / (h + cls.RIDGE)

    @classmethod
    def _best_cut(cls, g, h):
        """The gain and the place of the best cut of a row of bins; no cut: gain 0."""
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        right_g, right_h = g.sum() - left_g, h.sum() - left_h
        gain = cls._worth(left_g, left_h) + cls._worth(right_g, right_h)
        gain = gain - cls._worth(g.sum(), h.sum())
        gain[(left_h < cls.LEAST) | (right_h < cls.LEAST)] = 0
        if not len(gain) or gain.max() <= 0:
            return 0.0, 0
        at = int(gain.argmax())
        return float(gain[at]), at + 1

    @classmethod
    def _tree(cls, g, h):
        """The leaves of a tree of at most three leaves, spread over its bins."""
        ends = [0, len(g)]
        for _ in range(2):
            options = [
                (*cls._best_cut(g[a:b], h[a:b]), a)
                for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            gain, at, a = max(options, key=lambda o: o[0])
            if gain <= 0:
                break
            ends = sorted([*ends, a + at])
        step = np.zeros(len(g))
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            step[a:b] = g[a:b].sum() / (h[a:b].sum() + cls.RIDGE)
        return step

    @classmethod
    def _pair_tree(cls, g, h):
        """Gain and leaves of the best tree of depth two over a grid: a cut along one
        axis, then one along the other on each side."""
        best = (0.0, np.zeros_like(g))
        for turned in (False, True):
            a, b = (g.T, h.T) if turned else (g, h)
            for cut in range(1, len(a)):
                step, worth = np.zeros_like(a), -cls._worth(g.sum(), h.sum())
                for side in (slice(0, cut), slice(cut, None)):
                    row_g, row_h = a[side].sum(axis=0), b[side].sum(axis=0)
                    _, at = cls._best_cut(row_g, row_h)
                    for part in (slice(0, at), slice(at, None)):
                        sum_g, sum_h = row_g[part].sum(), row_h[part].sum()
                        worth += cls._worth(sum_g, sum_h)
                        step[side, part] = sum_g / (sum_h + cls.RIDGE)
                if worth > best[0] + 1e-12:
                    best = (worth, step.T if turned else step)
        return best

    @classmethod
    def fit(cls, x, y):
        """``x``: rows of figures; ``y``: 0 or 1 each. Without rows of both kinds every
        score is the smoothed share of ones."""
        x, y = np.asarray(x, float).reshape(-1, len(FIGURES)), np.asarray(y, float)
        share = (y.sum() + 1) / (len(y) + 2)
        intercept = float(np.log(share) - np.log1p(-share))
        features = range(x.shape[1])
        cuts = [cls.cut_points(x[:, i], cls.BINS) if len(x) else np.zeros(0) for i in features]
        coarse = [
            cls.cut_points(x[:, i], cls.PAIR_BINS) if len(x) else np.zeros(0) for i in features
        ]
        tables = [np.zeros(len(c) + 1) for c in cuts]
        model = cls(intercept, cuts, tables, coarse, {})
        if not 0 < y.sum() < len(y):
            return model
        bins = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(cuts)]
        odds = np.full(len(x), intercept)
        for _ in range(cls.ROUNDS):
            for i in features:
                p = _chance(odds)
                size = len(tables[i])
                g = np.bincount(bins[i], weights=y - p, minlength=size)
                h = np.bincount(bins[i], weights=p * (1 - p), minlength=size)
                step = cls.RATE * cls._tree(g, h)
                tables[i] += step
                odds += step[bins[i]]

        bins = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(coarse)]

        def grid(i, j):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            cell, p = bins[i] * shape[1] + bins[j], _chance(odds)
            g = np.bincount(cell, weights=y - p, minlength=shape[0] * shape[1])
            h = np.bincount(cell, weights=p * (1 - p), minlength=shape[0] * shape[1])
            return g.reshape(shape), h.reshape(shape)

        gains = {
            (i, j): cls._pair_tree(*grid(i, j))[0] for i in features for j in features if i < j
        }
        chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[: cls.PAIRS]
        for pair in chosen:
            model.pairs[pair] = np.zeros([len(coarse[i]) + 1 for i in pair])
        for _ in range(cls.PAIR_ROUNDS):
            for i, j in chosen:
                step = cls.RATE * cls._pair_tree(*grid(i, j))[1]
                model.pairs[i, j] += step
                odds += step[bins[i], bins[j]]
        return model


def fit_on(rows, labels, sample=SAMPLE):
    """The model of measured ``rows`` and ``labels`` (doc_id, label 0 or 1).

    Labels are taken in the order of a hash of their id, up to ``sample``; as many rows
    with them, by a hash of all they hold, reach the driver at most. Neither the order
    nor the layout of the tables matters. Labels of ids that no row has, NULL ids and
    NULL labels count for nothing; an id with several labels or rows gives a row for each.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    # At most ``sample`` rows of an id and a number.
    found = rows.join(F.broadcast(some), "doc_id")
    order = [F.xxhash64("doc_id", "label", *FIGURES), "doc_id", "label", *FIGURES]
    taken = found.orderBy(*order).limit(sample).select("label", *FIGURES).toArrow()
    x = np.stack([taken[name].to_numpy() for name in FIGURES], axis=1)
    return AdditiveModel.fit(x, taken["label"].to_numpy())


def _scored(model):
    def scored(batches):
        for batch in batches:
            x = np.stack([batch[name].to_numpy() for name in FIGURES], axis=1)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "score": pa.array(model.score(x))}
            )

    return scored


def score_quality(
    docs, labels, doc_id="doc_id", text="text", label="quality", sample=SAMPLE
):
    """Per row: ``doc_id``, ``held_out`` and ``score``, the chance of label 1.

    Only labels of ids that are not held out (CRC-32 of the id's text mod 4 is 2) are
    learned from, and of the documents only texts are looked at. NULL and empty texts
    have figures of zero and a score like any other. Rows with a NULL id are scored and
    not held out; rows that repeat an id or a text are scored alike; very long texts
    are taken whole; other columns of either table may have any name. Without labels of
    both kinds every score is the smoothed share of ones, and an empty table gives no row.
    """
    rows = written(measured(docs, doc_id, text), "figures")

    def held_out(column):
        return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))

    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    model = fit_on(rows, known.where(~held_out(F.col("doc_id"))), sample)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_scored(model), f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
