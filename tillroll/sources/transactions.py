"""Transaction CSV files: reading, header check, file profile, head sample."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import RAW_SCHEMA, SOURCE_COLUMNS

# Columns are not pruned while parsing: only whole lines show how many cells they have.
CSV_OPTIONS = {"escape": '"', "enforceSchema": False, "columnPruning": False}

# True for a line that has more or fewer than ten cells.
RAGGED = "_ragged"
# Such a line as it came, NULL for the others.
LINE = "_line"
# True for a line that holds the ten names.
HEADER = "_header"
# The file that a line came from.
FILE = T.StructField(
    "_file",
    T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("modified", T.TimestampType()),
            # Where the line's block begins; a task reads a block's lines one after the other.
            T.StructField("block", T.LongType()),
        ]
    ),
)
_CSV_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField(LINE, T.StringType())])

# Spark's CSV writer trims cells unless told not to.
CSV_WRITE_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def check_location(source, path):
    """Refuse an unknown kind of source or a missing path.

    Local and object-store files differ only by the URI; Spark reads both.
    """
    if source not in ("local", "s3"):
        raise ValueError('source must be "s3" or "local"')
    if not path:
        raise ValueError(f"a path is required when source={source}")


def _csv(reader, header, multi_line):
    return (
        reader.schema(_CSV_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("header", header)
        .option("columnNameOfCorruptRecord", LINE)
        .option("multiLine", multi_line)
    )


def read_transactions(spark, path, source="local", multi_line=False):
    """The files' ten columns as text, whether a line had another number of cells, and
    the line if so.

    Nothing is converted here: the row rules need the text as it was written. A
    file whose header differs from the ten names stops the read. With
    ``multi_line`` a quoted cell may hold line breaks; such files cannot be split,
    so one task reads each of them.
    """
    check_location(source, path)
    rows = _csv(spark.read, True, multi_line).csv(path)
    return rows.select(*SOURCE_COLUMNS, F.col(LINE).isNotNull().alias(RAGGED), LINE)


def read_lines(reader, path, source="local", multi_line=False):
    """All lines of files, headers as well, each with the file it came from.

    For a batch or a streaming reader. The staged table of these rows tells the files'
    headers apart (:func:`file_heads`), so that no file is read for its header alone.
    """
    check_location(source, path)
    rows = _csv(reader, False, multi_line).csv(path)
    names = F.lit(True)
    for place, name in enumerate(SOURCE_COLUMNS):
        cell = F.btrim(name, F.lit("\ufeff")) if place == 0 else F.col(name)
        names = names & (cell == name)
    # A scan writes a path as a URI, a listing as it is.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    file = [
        path.alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]
    block = F.col("_metadata.file_block_start").alias("block")
    ragged = F.col(LINE).isNotNull()
    return rows.select(
        *SOURCE_COLUMNS,
        ragged.alias(RAGGED),
        LINE,
        F.struct(*file, block).alias(FILE.name),
        F.coalesce(names & ~ragged, F.lit(False)).alias(HEADER),
    )


def file_heads(rows):
    """One row per file of read lines with ``_row_id``: ``path``, ``file_id``, ``columns`` of
    its first line, ``errors`` of that as a header (empty when in order), ``first_row``,
    ``lines``, ``size``.

    ``rows`` hold a ragged line as ``_line`` or, once staged, as ``_raw._line``. The number
    of cells and the verdict travel as one number, so the aggregate keeps no text.
    """
    outside_quotes = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    line = F.col(LINE) if LINE in rows.columns else F.col(f"_raw.{LINE}")
    cells = F.coalesce(F.size(F.split(line, outside_quotes)), F.lit(-1))
    cells = F.when(line.isNull(), F.lit(len(SOURCE_COLUMNS))).otherwise(cells)
    head = (cells * 2 + F.col(HEADER).cast("int")).cast("long")
    file = F.col(FILE.name)
    in_front = F.when(file["block"] == 0, F.col("_row_id"))
    found = rows.groupBy(
        file["path"].alias("path"), file["size"].alias("size"), file["modified"].alias("modified")
    ).agg(
        F.min(in_front).alias("first_row"),
        F.min_by(head, in_front).alias("head"),
        F.count(F.lit(1)).alias("lines"),
    )
    columns, named = F.expr("head div 2").cast("int"), F.expr("head % 2 = 1")
    wrong_number = F.concat(F.lit(f"expected_{len(SOURCE_COLUMNS)}_columns_got_"), columns)
    return found.select(
        "path",
        _file_id("path", "size", "modified").alias("file_id"),
        columns.alias("columns"),
        F.concat_ws(
            ",",
            F.when(columns != len(SOURCE_COLUMNS), wrong_number),
            F.when(~named, "column_names_mismatch"),
        ).alias("errors"),
        "first_row",
        "lines",
        "size",
    )


def header_of(spark, path):
    """Column names of a CSV file, read from its first line."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def _heads_of(spark, path, multi_line):
    lines = read_lines(spark.read, path, multi_line=multi_line)
    return file_heads(lines.withColumn("_row_id", F.monotonically_increasing_id()))


def header_report(spark, path, multi_line=False):
    """One row per file: ``path``, ``columns`` found, ``errors`` (empty when in order).

    One pass over the files, for a check without a load; a load finds the same in the
    pass that stages its rows.
    """
    return _heads_of(spark, path, multi_line).select("path", "columns", "errors")


def header_errors(columns):
    """What is wrong with a header: its length, its names or order, or nothing."""
    errors = []
    if len(columns) != len(SOURCE_COLUMNS):
        errors.append(f"expected_{len(SOURCE_COLUMNS)}_columns_got_{len(columns)}")
    if list(columns) != SOURCE_COLUMNS:
        errors.append("column_names_mismatch")
    return errors


def _file_id(path, size, modified):
    """A file's name, size and time as one id: a changed file has another.

    Listings and scans write a path in two ways, so its scheme is left out.
    """
    plain = F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
    return F.md5(F.concat_ws("|", plain, size, F.col(modified).cast("double")))


def file_listing(spark, path):
    """``path`` and ``file_id`` of the files at a path; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", _file_id("path", "length", "modificationTime").alias("file_id"))


def source_id(files):
    """A short id of listed files; the same files give the same id."""
    marks = F.xxhash64("file_id").cast("decimal(38,0)")
    return files.agg(
        F.substr(F.md5(F.concat_ws("/", F.count("path"), F.sum(marks))), F.lit(1), F.lit(12))
    ).first()[0]


def file_profile(spark, path, multi_line=False):
    """One row on a CSV path: valid, rows, columns, file_size_mb.

    Every file's header must be in order. One pass over the files counts their lines and
    looks at the first; sizes come with it from the listing.
    """
    found = _heads_of(spark, path, multi_line).agg(
        F.coalesce(F.sum("lines") - F.count("path"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("columns"), F.lit(0)).alias("columns"),
        F.count_if(F.col("errors") != "").alias("wrong"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
    )
    return found.select(
        ((F.col("wrong") == 0) & (F.col("rows") > 0)).alias("valid"),
        "rows",
        "columns",
        F.round(F.col("size") / (1024 * 1024), 4).alias("file_size_mb"),
    )


def head_sample(spark, path, n=100, source="local", multi_line=False):
    """The first ``n`` rows: files in the order of their paths, lines as they stand.

    Files are opened one after the other until there are enough rows, and of a file
    its first block is read first, so what is read follows from ``n`` and not from
    the files. The sample goes through the driver; ``n`` is its bound.
    """
    check_location(source, path)
    listed = spark.read.format("binaryFile").load(path).select("path")
    rows, last = [], ""
    while len(rows) < n:
        # The next few files by path.
        files = listed.where(F.col("path") > last).orderBy("path").limit(16).collect()
        if not files:
            break
        for file in files:
            if len(rows) < n:
                lines = read_transactions(spark, file.path, source, multi_line)
                rows += lines.select(SOURCE_COLUMNS).take(n - len(rows))
        last = files[-1].path
    return spark.createDataFrame(rows, RAW_SCHEMA)


def write_csv(rows, path, mode="errorifexists"):
    """Write the ten columns as CSV with a header."""
    (
        rows.select(SOURCE_COLUMNS)
        .write.mode(mode)
        .options(**CSV_WRITE_OPTIONS)
        .csv(path)
    )
