"""One run: read, check, set rejects aside, load, verify."""

import time

from pyspark.sql import functions as F

from tillroll.plans.dimensions import dimensions
from tillroll.plans.loading import load, stage
from tillroll.plans.quality import table_counts
from tillroll.plans.warehouse import Warehouse
from tillroll.schema import DATE_FORMAT, RAW_SCHEMA
from tillroll.sources.holidays import read_holidays
from tillroll.sources.rejects import save_rejects
from tillroll.sources.transactions import check_location, file_listing, read_lines, source_id


def file_name(path):
    """A path without its scheme."""
    scheme, colon, rest = path.partition(":")
    return "/" + (rest if colon else scheme).lstrip("/")


def run(
    spark,
    csv,
    holidays,
    warehouse_root,
    source="local",
    load_id=None,
    rejects_root=None,
    dry_run=False,
    date_format=DATE_FORMAT,
    legacy_holiday_parse=False,
    multi_line=False,
):
    """Run everything on one CSV path; returns a summary and never raises.

    The summary holds ``status``, rejected rows, counts and seconds per step,
    and the failed step with its error when something went wrong. A dry run
    checks the rows, saves the rejects and builds the dimensions only.

    A file is known by its path, size and time. Files that a load has taken are
    not taken again, so a path or glob that gains a file loads that file only. With
    a ``load_id`` all files are taken, and what that id had loaded is replaced.
    Files with a wrong header are set aside, named in ``rejected_files``; without
    any other file the run fails.
    """
    started = time.perf_counter()
    seconds, rejected, step, work = {}, 0, "read", []
    summary = {"source": source, "dry_run": dry_run}

    def finish(name, since):
        seconds[name] = round(time.perf_counter() - since, 3)

    try:
        since = time.perf_counter()
        warehouse = Warehouse(spark, warehouse_root)
        check_location(source, csv)
        calendar = read_holidays(spark, holidays, source)
        files = file_listing(spark, csv)
        if load_id is None:
            files = files.join(warehouse.loaded_files().select("file_id"), "file_id", "left_anti")
        # One short row per file that is new.
        paths = [row.path for row in files.select("path").collect()]
        finish(step, since)

        step, since = "validate", time.perf_counter()
        rows = (
            read_lines(spark.read, paths, source, multi_line)
            if paths
            else spark.createDataFrame([], RAW_SCHEMA)
        )
        work.append(warehouse.fresh("staged"))
        staged = stage(rows, work[-1], date_format)
        # One short row per file that cannot be taken.
        wrong = dict(staged.wrong_files().collect()) if paths else {}
        summary["rejected_files"] = wrong
        summary["files"] = len(paths) - len(wrong)
        if wrong:
            if not summary["files"]:
                raise RuntimeError(f"wrong header, nothing was loaded: schema_errors {wrong}")
            work.append(warehouse.fresh("left-out"))
            gone = spark.createDataFrame(sorted(wrong.items()), "path string, errors string")
            staged = staged.leaving_out(gone, work[-1])
            # A listing writes a path in another way than a scan.
            bad = {file_name(path) for path in wrong}
            bad_paths = [path for path in paths if file_name(path) in bad]
            files = files.where(~F.col("path").isin(bad_paths))
        load_id = load_id or (source_id(files) if summary["files"] else None)
        summary["load_id"] = load_id
        report = staged.report()
        rejected = report["invalid_rows"]
        if rejected:
            save_rejects(staged.rejected, rejects_root or f"{warehouse.root}/rejected", load_id)
        finish(step, since)

        step, since = "transform_dimensions", time.perf_counter()
        if dry_run:
            built = dimensions(staged.valid, calendar, legacy_holiday_parse)
            counts = {table: built[table].count() for table in built}
            finish(step, since)
        else:
            step, since = "load", time.perf_counter()
            if not warehouse.exists("fact_sales"):
                warehouse.reset()
            if paths:
                loaded = load(warehouse, staged, calendar, load_id, legacy_holiday_parse, files)
                if loaded["status"] != "success":
                    raise RuntimeError(f"load failed: {loaded['error']}")
            finish(step, since)

            step, since = "verify", time.perf_counter()
            counts = {
                row.table_name: row.row_count
                for row in table_counts(warehouse.tables()).collect()
            }
            finish(step, since)
        summary.update(status="success", counts=counts, report=report)
    except Exception as problem:
        summary.update(
            status="failed", failed_step=step, error=f"{type(problem).__name__}: {problem}"
        )
    # What was staged is in the tables and the rejects now, or of no use.
    for path in work:
        warehouse.remove(path)
    seconds["total"] = round(time.perf_counter() - started, 3)
    summary.update(rejected_rows=rejected, timing_seconds=seconds)
    return summary
