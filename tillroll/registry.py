"""Every query by name, each a callable of (spark, sf_dir) over the order tables.

Row-rule queries run straight on the transaction feed. The star-schema queries
share one warehouse per application and table folder: the feed is staged and
loaded once below the shared folder, as it would be in use, and the builders
and reports then read those written tables. What is shared is not built again if
the tables of a folder change while the application runs.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import rules
from tillroll.operators.keys import assign_dense_keys, ranges
from tillroll.operators.upsert import insert_absent, upsert
from tillroll.plans import dimensions, facts, quality, reports
from tillroll.plans.loading import load, stage
from tillroll.plans.run import run
from tillroll.plans.warehouse import Warehouse
from tillroll.schema import SEEDS, SOURCE_COLUMNS, TABLES
from tillroll.session import fresh_folder, open_writers, short_shuffles
from tillroll.sources import holidays as calendars
from tillroll.sources.order_feed import order_feed, order_holidays
from tillroll.sources.rejects import read_rejects, save_rejects
from tillroll.sources.transactions import (
    CSV_WRITE_OPTIONS,
    LINE,
    RAGGED,
    file_profile,
    head_sample,
    header_report,
    read_lines,
    read_transactions,
)
from tillroll.streaming.ingest import ingest_new_files

REPORT_MALL = "Kanyon"
REPORT_CUSTOMER = "C7"
SAMPLE_SEED = 7

_shared = {}


def _once(what, spark, sf_dir, build):
    """Build something once per application and table folder."""
    key = (what, spark.sparkContext.applicationId, sf_dir)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def _kept_holidays(spark, sf_dir):
    """The calendar as a small saved file, so that using it never reads the orders."""
    folder = fresh_folder(spark, "holidays")
    calendars.save_holidays(order_holidays(spark, sf_dir), folder)
    return calendars.read_holidays(spark, folder)


class Star:
    """The loaded warehouse of one table folder, with the staged rows it came from."""

    def __init__(self, spark, sf_dir):
        self.holidays = _kept_holidays(spark, sf_dir)
        self.warehouse = Warehouse(spark, fresh_folder(spark, "warehouse")).reset()
        self.staged = stage(order_feed(spark, sf_dir), self.warehouse.fresh("staged"))
        self.result = load(self.warehouse, self.staged, self.holidays, "orders")
        if self.result["status"] != "success":
            raise RuntimeError(self.result["error"])
        self.tables = self.warehouse.tables()


def star(spark, sf_dir):
    return _once("star", spark, sf_dir, lambda: Star(spark, sf_dir))


def landed(spark, sf_dir):
    """The feed as CSV files in two deliveries, the older orders first."""

    def land():
        folder = fresh_folder(spark, "landing")
        newer = F.substring_index("invoice_date", "/", -1) >= "1998"
        rows = order_feed(spark, sf_dir).select(
            *SOURCE_COLUMNS, F.when(newer, "newer").otherwise("older").alias("delivery")
        )
        with open_writers(spark, 2):
            rows.write.partitionBy("delivery").options(**CSV_WRITE_OPTIONS).csv(folder)
        return folder

    return _once("landed", spark, sf_dir, land)


def streamed(spark, sf_dir):
    """A warehouse filled by two file streams of one name, one per delivery."""

    def fill():
        landing = landed(spark, sf_dir)
        warehouse = Warehouse(spark, fresh_folder(spark, "streamed")).reset()
        calendar = _kept_holidays(spark, sf_dir)
        for delivery in ["older", "newer"]:
            ingest_new_files(
                warehouse,
                f"{landing}/delivery={delivery}",
                calendar,
                f"{warehouse.root}/checkpoint-{delivery}",
                multi_line=True,
            )
        return warehouse

    return _once("streamed", spark, sf_dir, fill)


def grown(spark, sf_dir):
    """The summary of a run over a glob that has gained files since the run before."""

    def fill():
        landing, root = landed(spark, sf_dir), fresh_folder(spark, "grown")
        calendar = fresh_folder(spark, "holidays")
        calendars.save_holidays(order_holidays(spark, sf_dir), calendar)
        for files in ("delivery=older", "delivery=*"):
            summary = run(spark, f"{landing}/{files}/*.csv", calendar, root, multi_line=True)
            if summary["status"] != "success":
                raise RuntimeError(summary["error"])
        return Warehouse(spark, root), summary

    return _once("grown", spark, sf_dir, fill)


def plain(rows):
    """Decimals as doubles and dates as text: values any engine prints alike."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return rows.select(columns)


# --- sources and rules ------------------------------------------------------


def _clean_transactions(spark, sf_dir):
    """The valid half of a fresh staging pass over the feed."""
    staged = stage(order_feed(spark, sf_dir), fresh_folder(spark, "staged"))
    return staged.valid.drop("_row_id")


def _csv_transactions(spark, sf_dir):
    """The landed feed beside lines of twelve cells, which are told apart and left out."""
    paths = [f"{landed(spark, sf_dir)}/*", _ragged(spark, sf_dir)]
    rows = read_transactions(spark, paths, multi_line=True)
    return rows.where(~F.col(RAGGED)).select(SOURCE_COLUMNS)


def _file_profile(spark, sf_dir):
    profile = file_profile(spark, f"{landed(spark, sf_dir)}/*", multi_line=True)
    return profile.select(
        "valid", "rows", "columns", (F.col("file_size_mb") > 0).alias("has_bytes")
    )


def _head_sample(spark, sf_dir):
    """The first lines of files whose lines follow the order numbers."""

    def land():
        folder = fresh_folder(spark, "in-order")
        place = ["l_orderkey", "l_linenumber"]
        # A file holds what a task can sort, and there are four at least.
        files = max(4, ranges(spark.read.parquet(f"{sf_dir}/lineitem.parquet")))
        (
            order_feed(spark, sf_dir, extra=place)
            .repartitionByRange(files, *place)
            .sortWithinPartitions(*place)
            .drop(*place)
            .write.options(**CSV_WRITE_OPTIONS)
            .csv(folder)
        )
        return folder

    folder = _once("in-order", spark, sf_dir, land)
    return head_sample(spark, f"{folder}/*.csv", 100, multi_line=True)


def _ragged(spark, sf_dir):
    """A file of lines with twelve cells, one line per nation."""

    def land():
        folder = fresh_folder(spark, "ragged")
        names = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name")
        lines = names.select(F.concat_ws(",", *["n_name"] * 12).alias("value"))
        header = spark.createDataFrame([(",".join(SOURCE_COLUMNS),)], "value string")
        header.unionByName(lines).coalesce(1).write.text(folder)
        return folder

    return _once("ragged", spark, sf_dir, land)


def _rejected_csv(spark, sf_dir):
    """Rejects of the landed feed and of lines of twelve cells, saved and read again."""

    def save():
        paths = [f"{landed(spark, sf_dir)}/*", _ragged(spark, sf_dir)]
        lines = read_lines(spark.read, paths, multi_line=True)
        staged = stage(lines, fresh_folder(spark, "staged"))
        return save_rejects(staged.rejected, fresh_folder(spark, "rejects"), "orders")

    return read_rejects(spark, _once("rejects", spark, sf_dir, save))


def _saved_holidays(spark, sf_dir):
    return calendars.holiday_dates(_kept_holidays(spark, sf_dir))


# --- keys and upserts -------------------------------------------------------


def _assign_dense_keys(spark, sf_dir):
    """Customers of one market segment are keyed first, all others after them."""
    people = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("C"), "c_custkey").alias("customer_id"), "c_mktsegment"
    )
    first = people.where("c_mktsegment = 'BUILDING'").select("customer_id")
    known = assign_dense_keys(
        first, ["customer_id"], "customer_key", fresh_folder(spark, "keys")
    )
    new = insert_absent(known, people.select("customer_id"), ["customer_id"])
    keyed = assign_dense_keys(
        new, ["customer_id"], "customer_key", fresh_folder(spark, "keys"), known.count()
    )
    return known.unionByName(keyed)


def _upsert_dim_customer(spark, sf_dir):
    """Customers of sales before 1998, replaced by their row from the later sales."""
    clean = star(spark, sf_dir).staged.valid
    older = dimensions.customer_batch(clean.where("invoice_date < date '1998-01-01'"))
    newer = dimensions.customer_batch(clean.where("invoice_date >= date '1998-01-01'"))
    return upsert(older, newer, ["customer_id"])


def _seed_dims(spark, sf_dir):
    """The seeded entries with the number of sales under each."""
    tables = star(spark, sf_dir).tables
    return reduce(
        lambda a, b: a.unionByName(b),
        [
            tables[table]
            .join(
                tables["fact_sales"].groupBy(key).agg(F.count(F.lit(1)).alias("sales")),
                key,
                "left",
            )
            .select(
                F.lit(table).alias("table_name"),
                F.col(key).alias("entry_key"),
                F.col(natural).alias("entry"),
                F.coalesce("sales", F.lit(0)).alias("sales"),
            )
            for table, (key, natural, _) in SEEDS.items()
        ],
    )


def _sale_ids(spark, sf_dir):
    """Sale ids are dense: as many different ones as rows, from 1 to the row count."""
    return star(spark, sf_dir).tables["fact_sales"].agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("sale_id").alias("different_ids"),
        F.min("sale_id").alias("lowest"),
        F.max("sale_id").alias("highest"),
    )


# --- loads ------------------------------------------------------------------


def _stream_two_sources(spark, sf_dir):
    return quality.table_counts(streamed(spark, sf_dir).tables())


def _run_growing_folder(spark, sf_dir):
    house, _ = grown(spark, sf_dir)
    return quality.table_counts(house.tables())


def _run_counts(spark, sf_dir):
    """The counts that a run reports, which it took from the tables."""
    _, summary = grown(spark, sf_dir)
    return spark.createDataFrame(
        sorted(summary["counts"].items()), "table_name string, row_count long"
    )


def _wrong_file(spark, sf_dir):
    """A CSV file under a header of another kind, one line per nation."""
    folder = fresh_folder(spark, "wrong")
    names = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name", "n_regionkey")
    names.coalesce(1).write.option("header", True).csv(folder)
    return folder


def _stream_with_bad_file(spark, sf_dir):
    """The feed, landed beside a file that cannot be taken."""

    def fill():
        landing = fresh_folder(spark, "mixed")
        with short_shuffles(spark):
            order_feed(spark, sf_dir).write.options(**CSV_WRITE_OPTIONS).csv(f"{landing}/good")
        names = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name", "n_regionkey")
        names.coalesce(1).write.option("header", True).csv(f"{landing}/wrong")
        warehouse = Warehouse(spark, fresh_folder(spark, "streamed")).reset()
        calendar = _kept_holidays(spark, sf_dir)
        checkpoint = f"{warehouse.root}/checkpoint"
        return ingest_new_files(warehouse, landing, calendar, checkpoint, multi_line=True)

    warehouse = _once("mixed", spark, sf_dir, fill)
    return warehouse.read("fact_sales").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("total_amount").alias("revenue")
    )


def delivered(spark, sf_dir):
    """A warehouse of three deliveries that share days, stores and customers: a third of
    the feed each, dealt by the order's number; the second was loaded twice, at first
    with the rows of the third year left out."""

    def fill():
        house = Warehouse(spark, fresh_folder(spark, "delivered")).reset()
        calendar = _kept_holidays(spark, sf_dir)
        feed = order_feed(spark, sf_dir, extra=["l_orderkey"])

        def deliver(part, load_id, where="true"):
            rows = feed.where(f"l_orderkey % 3 = {part}").where(where).drop("l_orderkey")
            result = load(house, stage(rows, house.fresh("staged")), calendar, load_id)
            if result["status"] != "success":
                raise RuntimeError(result["error"])

        deliver(0, "a")
        deliver(1, "b", "coalesce(invoice_date, '') NOT LIKE '%/1994'")
        deliver(2, "c")
        deliver(1, "b")
        return house

    return _once("delivered", spark, sf_dir, fill)


def _delivered_daily(spark, sf_dir):
    return delivered(spark, sf_dir).read("fact_daily_summary").drop("summary_id")


def _reload_customers(spark, sf_dir):
    return delivered(spark, sf_dir).read("dim_customer").drop("customer_key")


def _customer_history(spark, sf_dir):
    return star(spark, sf_dir).warehouse.sales_of_customer(REPORT_CUSTOMER).drop("sale_id")


def _sql_after_load(spark, sf_dir):
    """Answers of one held object before and after another one loads more."""

    def fill():
        built = star(spark, sf_dir)
        held = Warehouse(spark, fresh_folder(spark, "held")).reset()
        question = "SELECT count(*) AS sales, sum(total_amount) AS revenue FROM fact_sales"
        before = held.query(question, keep=True).withColumn("loads", F.lit(0))
        other = Warehouse(spark, held.root)
        result = load(other, built.staged, built.holidays, "orders")
        if result["status"] != "success":
            raise RuntimeError(result["error"])
        return before.unionByName(held.query(question, keep=True).withColumn("loads", F.lit(1)))

    return _once("held", spark, sf_dir, fill)


def _reload_replaces(spark, sf_dir):
    """A load of some years, then all of them under the same id."""

    def fill():
        built = star(spark, sf_dir)
        house = Warehouse(spark, fresh_folder(spark, "reloaded")).reset()
        some = order_feed(spark, sf_dir).where("invoice_date NOT LIKE '%/1997'")
        for staged in (stage(some, house.fresh("staged")), built.staged):
            result = load(house, staged, built.holidays, "orders")
            if result["status"] != "success":
                raise RuntimeError(result["error"])
        return house

    return quality.table_counts(_once("reloaded", spark, sf_dir, fill).tables())


def _header_report(spark, sf_dir):
    """Rows in files whose header is in order, and in the others."""
    paths = [f"{landed(spark, sf_dir)}/*", _wrong_file(spark, sf_dir)]
    rows = (
        spark.read.options(header=True, escape='"', multiLine=True)
        .csv(paths)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        header_report(spark, paths, multi_line=True)
        .join(rows, "path")
        .groupBy((F.col("errors") == "").alias("in_order"))
        .agg(F.sum("rows").alias("rows"))
    )


def _holiday_files(spark, sf_dir):
    """Calendars saved one file per year and read together."""

    def save():
        listed = order_holidays(spark, sf_dir)
        root = fresh_folder(spark, "calendars")
        years = [r[0] for r in listed.select(F.substring("date", 1, 4)).distinct().collect()]
        for year in years:
            own = listed.where(F.col("date").startswith(year))
            calendars.save_holidays(own, f"{root}/{year}")
        return [f"{root}/{year}" for year in years]

    return calendars.read_holidays(spark, _once("calendars", spark, sf_dir, save)).select("date")


def _sql_over_tables(spark, sf_dir):
    return star(spark, sf_dir).warehouse.query(
        "SELECT year, shopping_mall, sum(total_amount) AS revenue FROM fact_sales "
        "JOIN dim_time USING (date_key) JOIN dim_store USING (store_key) "
        "WHERE dim_time.is_holiday = :holiday GROUP BY ALL",
        holiday=True,
    )


def _table_shapes(spark, sf_dir):
    house = star(spark, sf_dir).warehouse
    shapes = [
        (table, columns, fine, house.exists(table))
        for table, columns, fine in house.verify_columns()
    ]
    found = spark.createDataFrame(
        shapes, "table_name string, columns int, in_order boolean, is_there boolean"
    )
    counts = quality.table_counts(house.tables())
    return found.join(counts, "table_name")


# --- checks on tables that are not in order -----------------------------------


def _spoiled(spark, sf_dir):
    """Tables with faults by quantity: unknown customers, missing products, repeats."""
    tables = dict(star(spark, sf_dir).tables)
    fault = F.col("quantity") % 10
    fact = tables["fact_sales"].withColumns(
        {
            "customer_key": F.when(fault == 1, -F.col("customer_key")).otherwise(
                F.col("customer_key")
            ),
            "product_key": F.when(fault != 2, F.col("product_key")),
        }
    )
    return tables | {"fact_sales": fact}


def _spoiled_duplicates(spark, sf_dir):
    tables = dict(star(spark, sf_dir).tables)
    fact, people = tables["fact_sales"], tables["dim_customer"]
    tables["fact_sales"] = fact.unionByName(fact.where("quantity % 10 = 3"))
    tables["dim_customer"] = people.unionByName(people.where("age = 30"))
    return quality.duplicate_keys(tables)


def _sampled_amounts(spark, sf_dir):
    """A random hundred of the fact's rows. The lots are drawn by what a row says and not
    by its number, so that SQL can draw the same."""
    tables = star(spark, sf_dir).tables
    keys = [c for c in tables["fact_sales"].columns if c not in ("sale_id", "is_holiday", "is_weekend")]
    return quality.amount_mismatch_in_sample(tables, 100, SAMPLE_SEED, keys)


# --- faulty deliveries and dropped tables -----------------------------------------


def _empty_delivery(spark, sf_dir):
    """Reports on the feed without its rows: no row, and no rule that any row broke."""
    nothing = order_feed(spark, sf_dir).where("invoice_no = 'none'")
    report = rules.validate(nothing)
    return rules.validation_report(nothing).withColumns(
        {
            "rules_listed": F.lit(rules.error_summary(nothing).count()).cast("long"),
            "summary_is_empty": F.lit(report["error_summary"] == {}),
        }
    )


def _validated(spark, sf_dir):
    """The whole check of the feed, in order and under a header that lacks a column."""
    feed = order_feed(spark, sf_dir)
    found = [
        (name, report["schema_valid"], report["total_rows"], report["valid_rows"],
         report["invalid_rows"], sum(report["error_summary"].values()))
        for name, report in [
            ("in order", rules.validate(feed)),
            ("price missing", rules.validate(feed.drop("price"))),
        ]
    ]
    return spark.createDataFrame(
        found,
        "delivery string, schema_valid boolean, total_rows long, valid_rows long,"
        " invalid_rows long, faults long",
    )


def _dropped_tables(spark, sf_dir):
    """Which tables are there, with how many rows, once dropped and once made anew."""

    def fill():
        house = Warehouse(spark, fresh_folder(spark, "dropped")).reset()
        built = star(spark, sf_dir)
        load(house, built.staged, built.holidays, "orders")
        states = []
        for state, change in [("loaded", house.refresh), ("dropped", house.drop), ("new", house.reset)]:
            change()
            states += [
                (state, table, house.exists(table), house.read(table).count() if house.exists(table) else 0)
                for table in TABLES
            ]
        return states

    return spark.createDataFrame(
        _once("dropped", spark, sf_dir, fill),
        "state string, table_name string, is_there boolean, row_count long",
    )


def _dimension_sizes(spark, sf_dir):
    """Rows of each dimension as built from the clean rows, before keys are given out."""
    built = star(spark, sf_dir)
    made = dimensions.dimensions(built.staged.valid, built.holidays)
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")
        for table, rows in made.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _unmatched_sales(spark, sf_dir):
    """Sales whose customer the dimension lacks."""
    built = star(spark, sf_dir)
    older = built.tables["dim_customer"].where("age >= 30")
    sales = facts.keyed_sales(built.staged.valid, built.tables | {"dim_customer": older})
    return facts.missing_keys(sales).agg(F.count(F.lit(1)).alias("unmatched"))


# --- star schema ------------------------------------------------------------


def _dim_customer(spark, sf_dir):
    batch = dimensions.customer_batch(star(spark, sf_dir).staged.valid)
    return assign_dense_keys(
        batch, ["customer_id"], "customer_key", fresh_folder(spark, "customers")
    )


def _seeded_dimension(table, builder):
    def run(spark, sf_dir):
        built = star(spark, sf_dir)
        key, natural, _ = SEEDS[table]
        return builder(built.staged.valid).join(built.tables[table], natural).select(key, natural)

    return run


def _dim_time(spark, sf_dir):
    built = star(spark, sf_dir)
    return dimensions.dim_time(built.staged.valid, built.holidays)


def _fact_sales(spark, sf_dir):
    built = star(spark, sf_dir)
    return facts.fact_sales(built.staged.valid, built.tables)


def _fact_daily_summary(spark, sf_dir):
    tables = star(spark, sf_dir).tables
    return facts.daily_summary(tables["fact_sales"], tables)


def _sales_base(spark, sf_dir):
    # Ids follow reading order, which SQL over the order tables cannot know;
    # the query sale_ids checks them.
    return reports.sales_base(star(spark, sf_dir).tables).drop("sale_id")


def _on_feed(function):
    return lambda spark, sf_dir: function(order_feed(spark, sf_dir))


def _on_tables(function, *arguments):
    return lambda spark, sf_dir: function(star(spark, sf_dir).tables, *arguments)


def _stream_ingest_daily(spark, sf_dir):
    return streamed(spark, sf_dir).read("fact_daily_summary").drop("summary_id")


def _stream_ingest_customers(spark, sf_dir):
    return streamed(spark, sf_dir).read("dim_customer").drop("customer_key")


QUERIES = {
    "clean_transactions": _clean_transactions,
    "rejected_rows": lambda spark, sf_dir: star(spark, sf_dir).staged.rejected.drop(LINE),
    "error_summary": _on_feed(rules.error_summary),
    "validation_report": _on_feed(rules.validation_report),
    "csv_transactions": _csv_transactions,
    "file_profile": _file_profile,
    "head_sample": _head_sample,
    "rejected_csv": _rejected_csv,
    "saved_holidays": _saved_holidays,
    "holiday_range": lambda spark, d: calendars.holiday_range(order_holidays(spark, d)),
    "dim_time": _dim_time,
    "dim_customer": _dim_customer,
    "dim_product": _seeded_dimension("dim_product", dimensions.dim_product),
    "dim_store": _seeded_dimension("dim_store", dimensions.dim_store),
    "dim_payment": _seeded_dimension("dim_payment", dimensions.dim_payment),
    "fact_sales": _fact_sales,
    "fact_daily_summary": _fact_daily_summary,
    "sale_ids": _sale_ids,
    "assign_dense_keys": _assign_dense_keys,
    "upsert_dim_customer": _upsert_dim_customer,
    "seed_dims": _seed_dims,
    "q01_revenue_by_mall": _on_tables(reports.revenue_by_mall),
    "q02_top_categories": _on_tables(reports.top_categories),
    "q03_monthly_trend": _on_tables(reports.monthly_trend),
    "q04_holiday_average": _on_tables(reports.holiday_average),
    "q05_customers_by_age_gender": _on_tables(reports.customers_by_age_and_gender),
    "q06_payments_by_mall": _on_tables(reports.payments_by_mall),
    "q07_weekend_revenue": _on_tables(reports.weekend_revenue),
    "q08_seasonal_revenue": _on_tables(reports.seasonal_revenue),
    "q09_top_customers": _on_tables(reports.top_customers),
    "q10_daily_summary_for_mall": _on_tables(reports.daily_summary_for_mall, REPORT_MALL),
    "sales_base": _sales_base,
    "kpi_overview": _on_tables(reports.kpi_overview),
    "monthly_revenue": _on_tables(reports.monthly_revenue),
    "mall_metrics": _on_tables(reports.mall_metrics),
    "mall_detail": _on_tables(reports.mall_detail, REPORT_MALL),
    "mall_list": _on_tables(reports.mall_list),
    "category_mix": _on_tables(reports.category_mix),
    "quarterly_revenue": _on_tables(reports.quarterly_revenue),
    "holiday_split": _on_tables(reports.holiday_split),
    "weekend_split": _on_tables(reports.weekend_split),
    "month_name_revenue": _on_tables(reports.month_name_revenue),
    "customers_by_age_group": _on_tables(reports.customers_by_age_group),
    "customers_by_gender": _on_tables(reports.customers_by_gender),
    "spend_age_gender": _on_tables(reports.spend_by_age_and_gender),
    "payment_mix": _on_tables(reports.payment_mix),
    "mall_payment_revenue": _on_tables(reports.mall_payment_revenue),
    "mall_month_matrix": _on_tables(reports.mall_month_matrix),
    "fk_orphans": _on_tables(quality.fk_orphans),
    "null_keys": _on_tables(quality.null_keys),
    "amount_mismatch": _on_tables(quality.amount_mismatch),
    "duplicate_keys": _on_tables(quality.duplicate_keys),
    "table_counts": _on_tables(quality.table_counts),
    "dim_counts": _on_tables(quality.dim_counts),
    "holiday_days": _on_tables(quality.holiday_days),
    "fact_count_within": _on_tables(quality.fact_count_within),
    "stream_ingest_daily": _stream_ingest_daily,
    "stream_ingest_customers": _stream_ingest_customers,
    "stream_two_sources": _stream_two_sources,
    "stream_with_bad_file": _stream_with_bad_file,
    "run_growing_folder": _run_growing_folder,
    "run_counts": _run_counts,
    "reload_replaces": _reload_replaces,
    "delivered_daily": _delivered_daily,
    "reload_customers": _reload_customers,
    "customer_history": _customer_history,
    "sql_after_load": _sql_after_load,
    "empty_delivery": _empty_delivery,
    "validated": _validated,
    "dropped_tables": _dropped_tables,
    "dimension_sizes": _dimension_sizes,
    "header_report": _header_report,
    "holiday_files": _holiday_files,
    "sql_over_tables": _sql_over_tables,
    "table_shapes": _table_shapes,
    "sampled_amounts": _sampled_amounts,
    "unmatched_sales": _unmatched_sales,
    "spoiled_orphans": lambda s, d: quality.fk_orphans(_spoiled(s, d)),
    "spoiled_null_keys": lambda s, d: quality.null_keys(_spoiled(s, d)),
    "spoiled_duplicates": _spoiled_duplicates,
}


def comparable_queries():
    """The queries with :func:`plain` results, for checking against SQL."""

    def wrap(query):
        return lambda spark, sf_dir: plain(query(spark, sf_dir))

    return {name: wrap(query) for name, query in QUERIES.items()}
