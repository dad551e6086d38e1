"""Sharding by a k-d tree over document metadata.

The tree starts with all documents and the number of shards. A node that stands for
several shards is split along its widest dimension, at the weighted quantile that
gives each side the bytes of its shards (the median, for an even number), until
every node is one shard. Quantiles are found over the whole table by histograms
that close in on the crossing bin; all nodes of a depth are served by one pass, each depth
is written, and what reaches the driver is a few bins per node.

Documents are ordered by the split's dimension, then by a hash of the text, then by
their place in the table. Copies of a text stand at one point. Where they stand
across a split, they go whole to the side that they fit better, if that changes the
shards below by ``GROUP_TOLERANCE`` of their size or less; only copies that fit on
neither side are divided, by place. High splits have many shards below and can take
large groups whole.
"""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.llm.common import whole_text, written

SHARDS = 40
OVERHEAD = 16  # bytes that a document takes besides its text
BINS = 512
TOLERANCE = 0.001  # of a shard's bytes: how far off a split may be
GROUP_TOLERANCE = 0.02  # of a shard's bytes, for each shard on the lesser side of a split
SLOTS_AT_ONCE = 20_000  # rows that are numbered together


def text_dimensions(text):
    """What is told of a document by its text alone: size, script, and word lengths."""
    size = F.octet_length(text).cast("double")
    chars = F.length(text).cast("double")
    spaces = size - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return {
        "size": size,
        "bytes_per_character": F.when(chars > 0, size / chars).otherwise(F.lit(1.0)),
        "space_share": F.when(size > 0, spaces / size).otherwise(F.lit(0.0)),
    }


@dataclass
class Search:
    """Where the split of one node lies, as far as it is known."""

    node: int
    shards: int
    dim: int
    goal: float  # bytes that go to the left
    low: float
    high: float
    step: int = 0  # what is searched: the dimension, the text's hash, the place
    before: float = 0.0  # bytes below the range
    value: float = math.nan
    tie: float = math.nan
    bound: tuple = None  # (value, tie, place): rows up to here go left

    def set_bound(self, x):
        self.bound = [(x, math.inf, math.inf), (self.value, x, math.inf), (self.value, self.tie, x)][
            self.step
        ]

    def set_bound_below(self, x):
        """Rows below x go left; x itself goes right."""
        self.bound = [(x, -math.inf, 0.0), (self.value, x, -math.inf), (self.value, self.tie, x - 0.5)][
            self.step
        ]

    def close_in(self, bins, near, group):
        """Take in the bins of the present range: (bytes, least x, greatest x), ascending."""
        total = self.before
        for i, (size, low, high) in enumerate(bins):
            if total + size < self.goal and i < len(bins) - 1:
                total += size
                continue
            under, over = self.goal - total, total + size - self.goal
            alone = low == high
            last = alone and self.step == 2
            allowed = group * (self.shards // 2) if alone and self.step == 1 else near
            if min(abs(under), abs(over)) <= allowed or last:
                if abs(under) <= abs(over):
                    self.set_bound_below(low)
                else:
                    self.set_bound(high)
            elif alone:
                if self.step == 0:
                    self.value = low
                else:
                    self.tie = low
                self.step, self.low, self.high, self.before = self.step + 1, -math.inf, math.inf, total
            else:
                self.low, self.high, self.before = low, high, total
            return


def _position(dims):
    """The searched coordinate of a row, by its node's search."""
    value = F.element_at("dims", F.col("s_dim") + 1)
    return (
        F.when(F.col("s_step") == 0, value)
        .when((F.col("s_step") == 1) & (value == F.col("s_value")), F.col("tie"))
        .when(
            (F.col("s_step") == 2) & (value == F.col("s_value")) & (F.col("tie") == F.col("s_tie")),
            F.col("place").cast("double"),
        )
    )


def _find_splits(rows, searches, near, group):
    """Close in on all searches, one pass over the rows per round."""
    spark = rows.sparkSession
    schema = "node int, s_dim int, s_step int, s_value double, s_tie double, s_low double, s_high double"
    pending = list(searches)
    while pending:
        table = spark.createDataFrame(
            [(s.node, s.dim, s.step, s.value, s.tie, s.low, s.high) for s in pending], schema
        )
        # One row per node: at most the number of shards.
        at = rows.join(F.broadcast(table), "node").withColumn("x", _position(rows))
        at = at.where(F.col("x").between(F.col("s_low"), F.col("s_high")))
        whole = F.col("s_high") - F.col("s_low")
        # The hash and the place have known ranges until the first bins are in.
        low = F.when(F.col("s_low") == -math.inf, F.lit(0.0)).otherwise(F.col("s_low"))
        width = F.when(F.col("s_high") < math.inf, whole).when(
            F.col("s_step") == 1, F.lit(2.0**53)
        ).otherwise(F.lit(2.0**62))
        share = F.when(width > 0, (F.col("x") - low) / width).otherwise(F.lit(0.0))
        bins = (
            at.withColumn("bin", F.floor(share * BINS))
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("size"), F.min("x").alias("low"), F.max("x").alias("high"))
            .collect()  # at most BINS + 1 rows per node
        )
        found = {}
        for r in bins:
            found.setdefault(r["node"], []).append((float(r["size"]), r["low"], r["high"]))
        for s in pending:
            s.close_in(sorted(found[s.node], key=lambda b: b[1]), near, group)
        pending = [s for s in pending if s.bound is None]


def _go_down(rows, searches):
    """Give every row of a split node the number of the side it goes to."""
    table = rows.sparkSession.createDataFrame(
        [(s.node, s.dim, *map(float, s.bound)) for s in searches],
        "node int, s_dim int, b_value double, b_tie double, b_place double",
    )
    value = F.element_at("dims", F.col("s_dim") + 1)
    left = (value < F.col("b_value")) | (
        (value == F.col("b_value"))
        & (
            (F.col("tie") < F.col("b_tie"))
            | ((F.col("tie") == F.col("b_tie")) & (F.col("place") <= F.col("b_place")))
        )
    )
    # Row-less nodes and shards that are done have no split and stay.
    joined = rows.join(F.broadcast(table), "node", "left")
    side = F.when(F.col("s_dim").isNull(), F.lit(None)).when(left, 0).otherwise(1)
    child = F.coalesce(F.col("node") * 2 + 1 + side, F.col("node")).cast("int")
    return joined.withColumn("node", child).drop("s_dim", "b_value", "b_tie", "b_place")


def grow(rows, shards, dims):
    """``rows`` with ``shard``; they have ``dims``, ``tie``, ``place``, ``size``.

    Node n has the children 2n + 1 and 2n + 2; shards are numbered from left to right.
    """
    rows = rows.withColumn("node", F.lit(0))
    counts, total, spans = {0: shards}, None, None
    while max(counts.values()) > 1:
        stats = [F.sum("size").alias("size")]
        for i in range(dims):
            x = F.element_at("dims", i + 1)
            stats += [F.min(x).alias(f"low{i}"), F.max(x).alias(f"high{i}")]
        nodes = {r["node"]: r for r in rows.groupBy("node").agg(*stats).collect()}
        if total is None:
            total = float(nodes[0]["size"]) if nodes else 0.0
            spans = [
                max(nodes[0][f"high{i}"] - nodes[0][f"low{i}"], 1e-300) if nodes else 1.0
                for i in range(dims)
            ]
        searches = []
        for node, n in counts.items():
            if n > 1 and node in nodes:
                own = nodes[node]
                widths = [(own[f"high{i}"] - own[f"low{i}"]) / spans[i] for i in range(dims)]
                dim = int(np.argmax(widths))
                goal = float(own["size"]) * (n - n // 2) / n
                searches.append(Search(node, n, dim, goal, own[f"low{dim}"], own[f"high{dim}"]))
        shard = total / shards
        _find_splits(rows, searches, TOLERANCE * shard, GROUP_TOLERANCE * shard)
        if searches:
            # Written, so that the passes of the next depth do not go down all depths again.
            rows = written(_go_down(rows, searches), "kd-depth")
        below = {}
        for node, n in counts.items():
            if n > 1:
                below |= {2 * node + 1: n - n // 2, 2 * node + 2: n // 2}
            else:
                below[node] = 1
        counts = below
    path = {node: bin(node + 1)[3:] for node in counts}
    order = sorted(counts, key=lambda node: path[node])
    table = rows.sparkSession.createDataFrame(list(zip(order, range(shards))), "node int, shard int")
    return rows.join(F.broadcast(table), "node").drop("node")


def _slots(rows):
    """``slot``: numbers without gaps within each shard, in tasks of bounded size."""
    sizes = rows.groupBy("shard").agg(
        F.ceil(F.count(F.lit(1)) / SLOTS_AT_ONCE).cast("int").alias("parts")
    )
    # One row per shard.
    dealt = rows.join(F.broadcast(sizes), "shard").withColumn(
        "part", F.pmod(F.xxhash64("place"), F.col("parts")).cast("int")
    )
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "shard",
        "part",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"),
    )
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("place")) - 1
    return (
        dealt.withColumn("own", own)
        .join(before, ["shard", "part"])
        .withColumn("slot", F.col("before") + F.col("own"))
    )


def shard(docs, doc_id="doc_id", text="text", shards=SHARDS, dimensions=None):
    """Per row: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``dimensions`` maps names to numeric columns; by default see
    :func:`text_dimensions`. A NULL in a dimension counts as 0, a NULL text takes the
    overhead alone, NULL ids and repeated rows are documents like any other. A
    document above a shard's size makes its shard that much larger; with fewer
    documents than shards some shards stay empty; an empty table gives no row. Of a
    very long text only its length, checksum and hash travel. Other columns of
    ``docs`` are not read, so their names cannot clash. Ties are told apart by the
    text's hash and then by place.
    """
    column = whole_text(text)
    dims = dimensions or text_dimensions(column)
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(column) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(column.cast("binary")).alias("text_crc32"),
            # 53 bits: a double holds them exactly.
            F.shiftrightunsigned(F.xxhash64(column), 11).cast("double").alias("tie"),
            F.monotonically_increasing_id().alias("place"),
            F.array(*[F.coalesce(d.cast("double"), F.lit(0.0)) for d in dims.values()]).alias(
                "dims"
            ),
        ),
        "kd-rows",
    )
    dealt = written(grow(rows, shards, len(dims)).drop("dims", "tie"), "kd-shards")
    return _slots(dealt).select("doc_id", "size", "text_crc32", "shard", "slot")
