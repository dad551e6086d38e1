"""Connected components of a link table, by joins and sums alone."""

from pyspark.sql import functions as F

from tillroll.llm.common import written

MAX_ROUNDS = 60


def _stars(links):
    """One round: links beyond a node go to its least neighbour, then links before it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).where("a > b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return (
        small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.withColumnRenamed("m", "b"))
        .where("a > b")
        .distinct()
    )


def _state(links):
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def component_roots(links):
    """``a``, ``root`` (the least node of its component) for every linked node but the roots.

    ``links`` has two columns ``a`` and ``b`` of one comparable type. Nodes meet
    their least neighbour in alternating rounds (large star, small star) until
    nothing changes; the number of rounds grows with the logarithm of the
    longest path. Every round is written, so none is computed twice; only a
    count and a checksum reach the driver. No links give no rows.
    """
    links = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct(),
        "links",
    )
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        links = written(_stars(links), "links")
        state, before = _state(links), state
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return links.select("a", F.col("b").alias("root"))
