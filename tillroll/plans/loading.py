"""Staging checked rows and loading them into the warehouse."""

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.keys import assign_dense_keys, number_rows, ranges
from tillroll.operators.rules import check_rows, clean_columns, report_of
from tillroll.operators.upsert import upsert
from tillroll.plans.dimensions import customer_batch, dim_time
from tillroll.plans.facts import (
    PAIR,
    keyed_sales,
    require_keys,
    summary_cells,
    summary_of,
    summary_shoppers,
)
from tillroll.plans.warehouse import CELLS, LOADED_FILES, SHOPPERS
from tillroll.schema import CLEAN_SCHEMA, DATE_FORMAT, RAW_SCHEMA, SEEDS, TABLES
from tillroll.session import open_writers
from tillroll.sources.transactions import FILE, HEADER, LINE, file_heads

# A rejected row as it came: its ten cells, and the line if that had another number.
REJECTED = T.StructType([*RAW_SCHEMA.fields, T.StructField(LINE, T.StringType())])


def _staged_schema(with_files):
    fields = [
        *CLEAN_SCHEMA.fields,
        T.StructField("_row_id", T.LongType()),
        T.StructField("_errors", T.StringType()),
        T.StructField("_raw", REJECTED),
    ]
    if with_files:
        fields += [T.StructField(FILE.name, FILE.dataType), T.StructField(HEADER, T.BooleanType())]
    return T.StructType([*fields, T.StructField("rejected", T.BooleanType())])


class Staged:
    """Checked rows of one load, written once: typed valid rows, raw rejected ones.

    The source is read, converted and checked in a single pass. All later steps
    read this table, so a lost executor never sends them back to the source. For rows
    from files, the table also tells which file each row came from and where its first
    line lies, which is its header and no row of the load. Rows of the files in the
    table ``out`` (``path``) are left out as they are read.
    """

    def __init__(self, spark, path, with_files=False, out=None):
        self.path, self.with_files, self._out = path, with_files, out
        self.rows = spark.read.schema(_staged_schema(with_files)).parquet(path)
        # Rows of one block of a file stand together, whatever blocks a task took.
        self._piece = []
        if out is not None:
            self.rows = _without_files(self.rows, out)
            self._piece = [F.col(FILE.name)[name] for name in ("path", "block")]
        self._valid_files = self.rows.where("not rejected")
        self.valid = self._valid_files.select(*CLEAN_SCHEMA.names, "_row_id")
        data = self.rows
        if with_files:
            # One short row per file.
            self.heads = file_heads(self.rows)
            first = F.broadcast(self.heads.select(F.col("first_row").alias("_row_id")))
            marked = self.rows.where(HEADER)
            headers = marked.join(first, "_row_id", "left_semi").select("_row_id")
            data = self.rows.join(F.broadcast(headers), "_row_id", "left_anti")
        self.checked = data.select("_errors")
        self.rejected = data.where("rejected").select("_raw.*", F.col("_errors").alias("errors"))

    def report(self):
        return report_of(self.checked)

    def files(self):
        """``path`` and ``file_id`` of the files that the rows came from."""
        return self.heads.select("path", "file_id")

    def wrong_files(self):
        """``path`` and ``errors`` of files whose first line is not the header."""
        return self.heads.where("errors <> ''").select("path", "errors")

    def leaving_out(self, files, path):
        """The same without the rows of some files (``path``): of this only the files' names
        are written, at ``path``, and the staged rows stay where they are."""
        spark, names = self.rows.sparkSession, files.select("path")
        if self._out is not None:
            names = names.unionByName(self._out)
        names.coalesce(1).write.parquet(path)
        return Staged(spark, self.path, True, spark.read.schema("path string").parquet(path))

    def without(self, files, path):
        """The same without the rows of some files (``path``), written anew at ``path``, for
        a caller that keeps the other rows alone. It shuffles and writes them all;
        :meth:`leaving_out` does neither."""
        kept = _without_files(self.rows, files)
        # A task reads pieces of several files; ranges bring them back to reading order.
        ordered = kept.repartitionByRange(ranges(self.rows), "_row_id")
        _write_staged(ordered.sortWithinPartitions("_row_id"), path)
        return Staged(self.rows.sparkSession, path, True)

    def numbered(self, last_sale):
        """Valid rows with ``sale_id`` counted on in the order they were read."""
        return number_rows(
            self._valid_files, "sale_id", "_row_id", last_sale, self._piece
        ).select("sale_id", *CLEAN_SCHEMA.names)


def _without_files(rows, files):
    # One short row per file.
    gone = F.broadcast(files.select(F.col("path").alias("_gone")))
    return rows.join(gone, F.col(f"{FILE.name}.path") == F.col("_gone"), "left_anti")


def _write_staged(rows, path):
    # Rows come in reading order, and each of the two files takes its own as they come.
    with open_writers(rows.sparkSession, 2):
        rows.write.partitionBy("rejected").parquet(path)


def stage(rows, path, date_format=DATE_FORMAT):
    """Check rows and write them at ``path``, split by the ``rejected`` flag."""
    with_files = FILE.name in rows.columns
    rejected = F.col("_errors") != ""
    line = F.col(LINE) if LINE in rows.columns else F.lit(None).cast("string")
    raw = F.struct(*[F.col(c) for c in RAW_SCHEMA.names], line.alias(LINE))
    checked = check_rows(rows, date_format).select(
        *clean_columns(),
        "_row_id",
        "_errors",
        F.when(rejected, raw).alias("_raw"),
        *([FILE.name, HEADER] if with_files else []),
        rejected.alias("rejected"),
    )
    _write_staged(checked, path)
    return Staged(rows.sparkSession, path, with_files)


def load(warehouse, staged, holidays, load_id, legacy_holiday_parse=False, files=None):
    """Load staged rows under ``load_id`` and publish all tables at once.

    Loading an id again replaces what it had loaded; its new rows get new ids, so
    the ids of the replaced ones stay unused. ``files`` (``path``, ``file_id``) are
    remembered as loaded. Returns rows and seconds per table with ``status`` and
    ``error``; a failed load changes nothing.
    """
    result = {
        table: {"rows": 0}
        for table in ["dim_time", "dim_customer", "fact_sales", "fact_daily_summary"]
    }
    result.update(status="failed", error=None)
    work = _Load(warehouse, staged, holidays, legacy_holiday_parse)

    def run(table):
        start = time.perf_counter()
        rows = getattr(work, table)()
        result[table] = {"rows": rows, "seconds": round(time.perf_counter() - start, 3)}

    try:
        warehouse.clear()
        replaced = warehouse.number_of(load_id)
        # The two dimensions do not need each other.
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(run, ["dim_time", "dim_customer"]))
        run("fact_sales")
        run("fact_daily_summary")
        if files is not None:
            warehouse.write(files.coalesce(1), LOADED_FILES)
        warehouse.publish(
            load_id, replaced, snapshots=["dim_time"], last_keys=work.last_keys, loads=1
        )
        result["status"] = "success"
    except Exception as problem:
        result["error"] = f"{type(problem).__name__}: {problem}"
        warehouse.clear()
    finally:
        for path in work.scratch:
            warehouse.remove(path)
    return result


class _Load:
    """One load under way: its own partition of every table."""

    def __init__(self, warehouse, staged, holidays, legacy_holiday_parse):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.staged = staged
        self.holidays = holidays
        self.legacy_holiday_parse = legacy_holiday_parse
        self.number = warehouse.version + 1
        self.last_keys = {}
        self.scratch = []

    def own(self, table):
        """What this load has written of a table."""
        return self.warehouse.partitions(table, number=self.number)

    def kept(self, rows, label):
        """Write rows that several steps read; the folder goes when the load is done."""
        folder = self.folder(label)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def folder(self, label):
        folder = self.warehouse.fresh(label)
        self.scratch.append(folder)
        return folder

    def keyed(self, rows, known, keys, key, table):
        """Rows under the key that known ones have, or the next free one in the order of
        their natural keys; returns them and how many are new."""
        last = self.warehouse.last_key(table)
        folder = self.folder(f"new-{key}")
        if not last:
            keyed = assign_dense_keys(rows, keys, key, folder)
        else:
            matched = self.kept(rows.join(known, keys, "left"), f"matched-{key}")
            new = matched.where(F.col(key).isNull()).drop(key)
            keyed = assign_dense_keys(new, keys, key, folder, last)
            keyed = matched.where(F.col(key).isNotNull()).unionByName(keyed)
        self.last_keys[table] = last + self.spark.read.parquet(folder).count()
        return keyed

    def dim_time(self):
        """Days of this batch replace the same days; returns the days handled."""
        days = self.kept(
            dim_time(self.staged.valid, self.holidays, self.legacy_holiday_parse), "days"
        )
        known = self.warehouse.read("dim_time")
        self.warehouse.write(upsert(known, days, ["date_key"], check=False), "dim_time")
        return days.count()

    def dim_customer(self):
        """What this batch knows of its customers. New ones get keys in id order, known
        ones keep theirs: of the earlier loads, two columns are read for the batch's
        customers."""
        batch = self.kept(customer_batch(self.staged.valid), "customers")
        known = (
            self.warehouse.partitions("dim_customer", hidden=True)
            .select("customer_id", "customer_key")
            .join(batch.select("customer_id"), "customer_id", "left_semi")
            .distinct()
        )
        keyed = self.keyed(batch, known, ["customer_id"], "customer_key", "dim_customer")
        self.warehouse.write(keyed, "dim_customer")
        return batch.count()

    def fact_sales(self):
        """Rows of this load, split by month and sorted by day, so that a filter on
        days opens few files."""
        last = self.warehouse.last_key("fact_sales")
        dims = {table: self.warehouse.read(table) for table in SEEDS}
        dims["dim_time"] = self.spark.read.schema(TABLES["dim_time"]).parquet(
            self.warehouse.folder("dim_time", self.number)
        )
        # All customers of the batch and no others.
        dims["dim_customer"] = self.own("dim_customer")
        self.warehouse.write(keyed_sales(self.staged.numbered(last), dims), "fact_sales")
        rows = require_keys(self.own("fact_sales"))
        self.last_keys["fact_sales"] = last + rows
        return rows

    def fact_daily_summary(self):
        """The sums and sets of this load's own sales, and the summary they give by
        themselves. No sale of another load is read; what several loads sold on a day at
        a store is added up when the summary is read."""
        sales = self.own("fact_sales")
        with ThreadPoolExecutor(2) as pool:
            cells = pool.submit(self.warehouse.write, summary_cells(sales), CELLS)
            shoppers = pool.submit(self.warehouse.write, summary_shoppers(sales), SHOPPERS)
            cells.result(), shoppers.result()
        seeded = {table: self.warehouse.read(table) for table in SEEDS}
        rows = summary_of(self.own(CELLS), self.own(SHOPPERS), seeded)
        known = (
            self.warehouse.partitions("fact_daily_summary", hidden=True)
            .select(*PAIR, "summary_id")
            .distinct()
        )
        keyed = self.keyed(rows, known, PAIR, "summary_id", "fact_daily_summary")
        self.warehouse.write(keyed, "fact_daily_summary")
        return self.own("fact_daily_summary").count()
