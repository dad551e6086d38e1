import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll.plans import quality, reports
from tillroll.plans.loading import load, stage
from tillroll.plans.warehouse import Warehouse
from tillroll.schema import CATEGORIES, MALLS, PAYMENT_METHODS, SEEDS, TABLES


def put(warehouse, rows, holidays, load_id):
    return load(warehouse, stage(rows, warehouse.fresh("staged")), holidays, load_id)


@pytest.fixture
def lopsided_customers(spark):
    """Four thousand sales of as many customers, dealt over two days."""
    n = F.col("id")
    return spark.range(0, 4000, 1, 1).select(
        F.concat(F.lit("I"), n).alias("invoice_no"),
        F.concat(F.lit("C"), n).alias("customer_id"),
        F.lit("Male").alias("gender"),
        F.lit("30").alias("age"),
        F.lit("Toys").alias("category"),
        F.lit("1").alias("quantity"),
        F.lit("2.00").alias("price"),
        F.lit("Cash").alias("payment_method"),
        F.concat((n * 7919 % 4000 % 5 + 1).cast("string"), F.lit("/3/2022")).alias("invoice_date"),
        F.lit("Kanyon").alias("shopping_mall"),
    )


def contents(warehouse, table, *without):
    return sorted(map(tuple, warehouse.read(table).drop(*without).collect()), key=repr)


def test_reset_seeds_in_key_order(warehouse):
    assert all(ok for _, _, ok in warehouse.verify_columns())
    assert [n for _, n, _ in warehouse.verify_columns()] == [12, 8, 2, 2, 2, 12, 9]
    for table, values in zip(SEEDS, (CATEGORIES, MALLS, PAYMENT_METHODS)):
        assert contents(warehouse, table) == sorted(enumerate(values, start=1), key=repr)


def test_seeding_twice_changes_nothing(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w")).reset(seed=False)
    assert house.read("dim_store").count() == 0
    before = house.seed().version
    assert house.seed().version == before
    assert house.read("dim_store").count() == 10
    assert Warehouse(spark, house.root).read("dim_product").count() == 8


def test_drop(warehouse):
    warehouse.drop()
    assert not any(warehouse.exists(t) for t in TABLES)
    assert not any(ok for _, _, ok in warehouse.verify_columns())
    with pytest.raises(LookupError):
        warehouse.read("dim_time")
    assert warehouse.reset().read("dim_payment").count() == 3


FIRST = [
    {"invoice_no": "I1", "customer_id": "C2", "invoice_date": "1/3/2022"},
    {"invoice_no": "I2", "customer_id": "C1", "invoice_date": "2/3/2022", "category": "Shoes"},
    {"invoice_no": "I2", "customer_id": "C1", "invoice_date": "2/3/2022"},
]
SECOND = [
    {"invoice_no": "I3", "customer_id": "C1", "invoice_date": "28/2/2022", "age": "61"},
    {"invoice_no": "I4", "customer_id": "C0", "invoice_date": "2/3/2022", "quantity": "9"},
]


def test_second_load_keeps_keys_and_adds_up(warehouse, feed, holidays):
    assert put(warehouse, feed(*FIRST), holidays, "a")["status"] == "success"
    result = put(warehouse, feed(*SECOND), holidays, "b")
    assert result["dim_customer"]["rows"] == 2 and result["fact_sales"]["rows"] == 2
    people = {r.customer_id: r for r in warehouse.read("dim_customer").collect()}
    assert {i: p.customer_key for i, p in people.items()} == {"C1": 1, "C2": 2, "C0": 3}
    one = people["C1"]
    assert (one.age, one.age_group, one.total_transactions) == (61, "56-69", 3)
    assert (one.first_purchase_date, one.last_purchase_date) == (
        dt.date(2022, 2, 28),
        dt.date(2022, 3, 2),
    )
    assert [r.sale_id for r in warehouse.read("fact_sales").orderBy("sale_id").collect()] == [
        1, 2, 3, 4, 5,
    ]
    days = {r.date_key: r for r in warehouse.read("fact_daily_summary").collect()}
    assert set(days) == {20220228, 20220301, 20220302}
    assert (days[20220302].total_transactions, days[20220302].unique_customers) == (3, 2)
    assert sorted(r.summary_id for r in days.values()) == [1, 2, 3]
    assert days[20220228].summary_id == 3
    assert {r.violations for r in quality.check_warehouse(warehouse.tables()).where(
        "check not in ('has holidays')").collect()} == {0}


def test_loads_in_two_parts_equal_one(spark, tmp_path, warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    put(warehouse, feed(*SECOND), holidays, "b")
    whole = Warehouse(spark, str(tmp_path / "whole")).reset()
    put(whole, feed(*SECOND, *FIRST), holidays, "all")
    assert contents(warehouse, "fact_daily_summary", "summary_id") == contents(
        whole, "fact_daily_summary", "summary_id"
    )
    assert contents(warehouse, "dim_time") == contents(whole, "dim_time")
    assert contents(warehouse, "dim_customer", "customer_key") == contents(
        whole, "dim_customer", "customer_key"
    )


def test_repeating_a_load_replaces_it(warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    put(warehouse, feed(*SECOND), holidays, "b")
    before = {t: contents(warehouse, t) for t in TABLES if t != "fact_sales"}
    sales = contents(warehouse, "fact_sales", "sale_id")
    put(warehouse, feed(*SECOND), holidays, "b")
    assert {t: contents(warehouse, t) for t in before} == before
    assert contents(warehouse, "fact_sales", "sale_id") == sales

    # A corrected delivery without C1's older sale takes that sale out again.
    put(warehouse, feed(SECOND[1]), holidays, "b")
    people = {r.customer_id: r for r in warehouse.read("dim_customer").collect()}
    assert people["C1"].total_transactions == 2
    assert people["C1"].first_purchase_date == dt.date(2022, 3, 2)
    days = {r.date_key for r in warehouse.read("fact_daily_summary").collect()}
    assert days == {20220301, 20220302}
    assert warehouse.read("fact_sales").count() == 4


def files(warehouse):
    """All files of the tables with their contents' places on disk."""
    found = Path(warehouse.root, "data").rglob("*.parquet")
    return {str(p): (p.stat().st_ino, p.stat().st_mtime) for p in found}


def test_a_small_load_rewrites_nothing(spark, warehouse, feed, holidays):
    many = [{"customer_id": f"C{i}", "invoice_date": f"1/{i % 12 + 1}/2022"} for i in range(200)]
    put(warehouse, feed(*many), holidays, "a")
    before = files(warehouse)
    put(warehouse, feed({"customer_id": "C5", "invoice_date": "1/6/2022"}), holidays, "b")
    after = files(warehouse)
    assert {path: after.get(path) for path in before} == before
    new = [path for path in after if path not in before and "/staged-" not in path]
    assert all("/load_no=3/" in path for path in new)
    assert warehouse.read("dim_customer").count() == 200
    days = {r.date_key: r for r in warehouse.read("fact_daily_summary").collect()}
    assert len(days) == 12 and days[20220601].total_transactions == 18
    assert days[20220601].unique_customers == 17


def test_a_late_row_costs_its_own_load(spark, warehouse, feed, holidays):
    """The third delivery reads no sale of the others, though it shares a day with both."""
    put(warehouse, feed(*FIRST), holidays, "a")
    put(warehouse, feed(*SECOND), holidays, "b")
    hidden = Path(warehouse.folder("fact_sales"))
    for load in hidden.iterdir():
        load.rename(load.with_name("away-" + load.name))
    assert put(warehouse, feed({"customer_id": "C1", "invoice_date": "2/3/2022"}), holidays, "c")[
        "status"
    ] == "success"
    for load in hidden.glob("away-*"):
        load.rename(load.with_name(load.name[5:]))
    day = warehouse.read("fact_daily_summary").where("date_key = 20220302").first()
    assert (day.total_transactions, day.unique_customers) == (4, 2)
    scans = warehouse.read("fact_daily_summary")._jdf.queryExecution().optimizedPlan().toString()
    assert "sale_id" not in scans


def test_customers_of_a_replaced_load(spark, warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    put(warehouse, feed(*SECOND), holidays, "b")
    put(warehouse, feed({"customer_id": "C2", "invoice_date": "9/9/2022"}), holidays, "b")
    people = {r.customer_id: r for r in warehouse.read("dim_customer").collect()}
    assert {i: p.total_transactions for i, p in people.items()} == {"C1": 2, "C2": 2, "C0": 0}
    assert people["C0"].first_purchase_date is None and people["C0"].gender == "Female"
    # C1 is as old again as its other load says.
    assert (people["C1"].age, people["C1"].age_group) == (33, "26-35")
    assert people["C2"].last_purchase_date == dt.date(2022, 9, 9)
    assert sorted(p.customer_key for p in people.values()) == [1, 2, 3]
    plan = warehouse.read("dim_customer")._jdf.queryExecution().optimizedPlan().toString()
    assert "sale_id" not in plan


def rows_scanned(rows):
    """What the scan of a plan gives out, once the row groups it can do without are left out."""
    rows.collect()
    plan, found = rows._jdf.queryExecution().executedPlan(), []

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().get("numOutputRows").get().value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    return sum(found)


def test_one_customer_reads_few_row_groups(spark, warehouse, lopsided_customers, holidays):
    """Customers are anywhere in a month; their row groups are told by Bloom filters."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    small = {"parquet.block.size": "4096", "parquet.block.size.row.check.min": "100",
             "parquet.page.size.row.check.min": "50"}
    for name, value in small.items():
        settings.set(name, value)
    try:
        put(warehouse, lopsided_customers, holidays, "a")
    finally:
        for name in small:
            settings.unset(name)
    total = warehouse.read("fact_sales").count()
    mine = warehouse.sales_of_customer("C77")
    assert rows_scanned(mine) < total / 5
    assert [r.invoice_no for r in mine.collect()] == ["I77"]
    assert warehouse.sales_of_customer("C999999").count() == 0
    day = warehouse.read("fact_sales").where("date_key = 20220301")
    assert rows_scanned(day) < total / 2


def test_a_table_whose_folder_is_gone_does_not_exist(warehouse):
    assert warehouse.exists("dim_store")
    for path in warehouse.paths("dim_store"):
        warehouse.remove(path)
    assert not warehouse.exists("dim_store")


def test_a_failed_load_changes_nothing(spark, warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    version = warehouse.version
    broken = holidays.select(F.raise_error(F.lit("no calendar")).cast("string").alias("date"))
    result = put(warehouse, feed({"quantity": "2"}), broken, "b")
    assert result["status"] == "failed" and "no calendar" in result["error"]
    assert Warehouse(spark, warehouse.root).version == version
    assert warehouse.read("fact_sales").count() == 3
    assert not warehouse.has_load("b")


def test_very_large_amounts_load(warehouse, feed, holidays):
    large = {"quantity": "2147483647", "price": "99999999.99"}
    result = put(warehouse, feed(large, large, large), holidays, "a")
    assert result["status"] == "success", result["error"]
    day = warehouse.read("fact_daily_summary").first()
    assert day.total_revenue == 3 * 2147483647 * Decimal("99999999.99")


def test_a_load_without_valid_rows(warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    result = put(warehouse, feed({"price": "0"}), holidays, "b")
    assert result["status"] == "success", result["error"]
    assert warehouse.read("fact_sales").count() == 3
    assert warehouse.read("fact_daily_summary").count() == 2


def test_sql_over_the_tables(warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    answer = warehouse.query(
        "SELECT full_date, total_transactions FROM fact_daily_summary "
        "JOIN dim_time USING (date_key) JOIN dim_store USING (store_key) "
        "WHERE shopping_mall = :mall ORDER BY full_date",
        mall="Metrocity",
    )
    assert [r.total_transactions for r in answer.collect()] == [1, 2]
    assert warehouse.query("SELECT * FROM sales_base").columns[:3] == [
        "sale_id", "invoice_no", "full_date",
    ]


def test_a_held_warehouse_sees_later_loads(spark, warehouse, feed, holidays):
    question = "SELECT count(*) AS n FROM fact_sales"
    held = Warehouse(spark, warehouse.root)
    assert held.query(question, keep=True).first().n == 0
    put(warehouse, feed(*FIRST), holidays, "a")
    first = held.query(question, keep=True)
    assert first.first().n == 3 and first.is_cached
    assert held.query(question, keep=True) is first
    put(warehouse, feed(*SECOND), holidays, "b")
    assert held.query(question).first().n == 5
    assert not first.is_cached
    # Another warehouse's views do not get in the way.
    other = Warehouse(spark, warehouse.root + "-other").reset()
    assert other.query(question).first().n == 0
    assert held.query(question).first().n == 5


def test_a_failed_load_leaves_no_folder(spark, warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    before = set(files(warehouse))
    broken = holidays.select(F.raise_error(F.lit("no calendar")).cast("string").alias("date"))
    put(warehouse, feed({"quantity": "2"}), broken, "b")
    assert {p for p in files(warehouse) if "/staged-" not in p} == {
        p for p in before if "/staged-" not in p
    }


def test_kept_base_follows_the_version(warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    kept = warehouse.sales_base(keep=True)
    assert kept.count() == 3 and warehouse.sales_base() is kept
    put(warehouse, feed(*SECOND), holidays, "b")
    assert warehouse.sales_base().count() == 5
    assert not kept.is_cached


def test_reports_on_an_empty_warehouse(warehouse):
    tables = warehouse.tables()
    kpi = reports.kpi_overview(tables).first()
    assert (kpi.total_revenue, kpi.transactions, kpi.avg_order_value) == (0, 0, 0.0)
    assert reports.revenue_by_mall(tables).count() == 0
    assert quality.fact_count_within(tables).first().within is False


def test_invoices_and_rows_are_counted_apart(warehouse, feed, holidays):
    put(warehouse, feed(*FIRST), holidays, "a")
    mall = reports.mall_metrics(warehouse.tables()).first()
    assert (mall.transactions, mall.customers) == (2, 2)
    assert mall.avg_basket == 25.0
    kpi = reports.kpi_overview(warehouse.tables()).first()
    assert (kpi.transactions, kpi.avg_order_value) == (2, 37.5)
