"""Dense surrogate keys without a single-task sort."""

from pyspark.sql import Window
from pyspark.sql import functions as F

# monotonically_increasing_id() is the partition's number, and below it the row's place there.
PLACES = 33
_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
# What one task sorts in memory.
ROWS_SORTED = 500_000


def ranges(rows):
    """How many ranges of about ``ROWS_SORTED`` rows the rows of a stored table make."""
    return -(-rows.count() // ROWS_SORTED) or 1


def number_rows(stored, name, order, start=0, piece=()):
    """Number the rows of a written Parquet table ``start + 1, ...`` by ``order``.

    ``order`` is a stored column of whole numbers that rises through each file, and
    no two files' ranges of it overlap: what a sorted write leaves behind. A row's
    number is its place in its file plus the rows of the files that lie before, so
    that rows may be left out by a filter on the table's folders. With columns
    ``piece``, never NULL, whose equal rows stand together in a file, whole pieces may be
    left out as well; a place then counts from its piece's first row. Only one short row
    per file or piece is ever brought together and broadcast, and no data row moves.
    """
    of = {"_from": F.col("_metadata.file_path")}
    of |= {f"_from_{number}": column for number, column in enumerate(piece)}
    placed = stored.withColumns({**of, "_place": F.col("_metadata.row_index")})
    pieces = placed.groupBy(*of).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(order).alias("_least"),
        (F.min("_place") if piece else F.lit(0)).alias("_first"),
    )
    before = F.sum("_rows").over(Window.orderBy("_least").rowsBetween(*_TO_HERE))
    pieces = pieces.select(*of, (before - F.col("_rows") - F.col("_first")).alias("_before"))
    return (
        placed.join(F.broadcast(pieces), [*of])
        .withColumn(name, F.col("_before") + F.col("_place") + 1 + F.lit(start))
        .drop(*of, "_before", "_place")
    )


def assign_dense_keys(rows, order_by, key, folder, last_key=0):
    """Give rows the keys ``last_key + 1, ...`` in the order of ``order_by``.

    Rows are range-partitioned, sorted, and written at ``folder`` (a path in the
    shared folder) with the number of their partition and their place in it. A key is
    the place plus the sizes of the partitions before, one short row for each. The
    written table fixes the layout, so a recomputed task cannot shift keys.
    ``order_by`` must be unique, so that no range is a hot one.
    """
    row = F.monotonically_increasing_id()
    (
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_row", row)
        .withColumns(
            {
                "_part": F.shiftright("_row", PLACES).cast("int"),
                "_place": F.col("_row").bitwiseAND(F.lit((1 << PLACES) - 1)),
            }
        )
        .drop("_row")
        .write.parquet(folder)
    )
    stored = rows.sparkSession.read.parquet(folder)
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(*_TO_HERE))
    sizes = sizes.select("_part", (before - F.col("_rows")).alias("_before"))
    keyed = F.col("_before") + F.col("_place") + 1 + F.lit(last_key)
    return stored.join(F.broadcast(sizes), "_part").select(*rows.columns, keyed.alias(key))
