"""Key checks across tables, and top-by."""

from functools import reduce

from pyspark.sql import functions as F


def orphan_rows(child, parents):
    """``foreign_key`` and ``orphans``: child rows with a key that its parent lacks.

    ``parents`` names the parent of each key column, all of whole numbers. The child is
    read once: its keys are laid out as (column, key), and rows are counted for each
    before the shuffle, so a key held by a third of the rows travels as one row
    per map task. The parents' keys join that as rows of no weight. NULL is no
    parent's key.
    """
    keys = child.select([F.col(key).cast("long").alias(key) for key in parents])
    rows = keys.unpivot([], list(parents), "foreign_key", "key").select(
        "foreign_key", "key", F.lit(1).alias("rows"), F.lit(0).alias("known")
    )
    sides = [
        parent.where(F.col(key).isNotNull()).select(
            F.lit(key).alias("foreign_key"),
            F.col(key).cast("long").alias("key"),
            F.lit(0).alias("rows"),
            F.lit(1).alias("known"),
        )
        for key, parent in parents.items()
    ]
    # So that every column is in the result, also without a row.
    names = child.sparkSession.createDataFrame(
        [(key, None, 0, 0) for key in parents],
        "foreign_key string, key long, rows int, known int",
    )
    per_key = (
        reduce(lambda a, b: a.unionByName(b), [rows, *sides, names])
        .groupBy("foreign_key", "key")
        .agg(F.sum("rows").alias("rows"), F.max("known").alias("known"))
    )
    return per_key.groupBy("foreign_key").agg(
        F.sum(F.when(F.col("known") == 0, F.col("rows")).otherwise(0)).alias("orphans")
    )


def top_by(value, key):
    """Aggregate: the ``key`` with the highest ``value``, ties to the lowest key.

    Rows without a key do not compete.
    """
    return F.max_by(key, F.when(F.col(key).isNotNull(), F.struct(value, -F.col(key))))
