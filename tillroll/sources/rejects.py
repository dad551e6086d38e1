"""Rejected rows, kept as CSV files with the ten cells as they came, and the whole line
where it had another number of cells."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import RAW_SCHEMA, SOURCE_COLUMNS
from tillroll.sources.transactions import CSV_OPTIONS, CSV_WRITE_OPTIONS, LINE

# The last column is empty for lines of ten cells.
WHOLE_LINE = "line"
_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField(WHOLE_LINE, T.StringType())])


def save_rejects(rejected, path, load_id):
    """Write rejected rows as they came, one folder per load; none when empty.

    Returns the folder written, or None.
    """
    if rejected.isEmpty():
        return None
    target = f"{path}/load_id={load_id}"
    line = F.col(LINE) if LINE in rejected.columns else F.lit(None).cast("string")
    (
        rejected.select(*SOURCE_COLUMNS, line.alias(WHOLE_LINE))
        .write.mode("overwrite")
        .options(**CSV_WRITE_OPTIONS)
        .csv(target)
    )
    return target


def read_rejects(spark, path):
    """Rejected rows of one load folder, as text: ten cells and, for others, the line."""
    # A line may have held breaks within quotes.
    reader = spark.read.schema(_SCHEMA).options(**CSV_OPTIONS)
    return reader.option("header", True).option("multiLine", True).csv(path)
