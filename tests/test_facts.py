import re
from decimal import Decimal

import pytest

from tillroll.operators.joins import orphan_rows
from tillroll.operators.rules import check_rows, clean_columns
from tillroll.operators.sampling import random_rows
from tillroll.plans import facts, quality
from tillroll.plans.loading import load, stage
from tillroll.plans.warehouse import CELLS, SHOPPERS

SALES = (
    "invoice_no string, date_key int, store_key int, product_key int, payment_key int, "
    "customer_key long, total_amount decimal(12,2)"
)


@pytest.fixture
def summary(spark):
    names = {
        "dim_product": spark.createDataFrame(
            [(1, "Books"), (2, "Clothing"), (3, "Shoes")], "product_key int, category string"
        ),
        "dim_payment": spark.createDataFrame(
            [(1, "Cash"), (2, "Credit Card")], "payment_key int, payment_method string"
        ),
    }

    def build(*rows):
        sales = spark.createDataFrame([(*r[:-1], Decimal(r[-1])) for r in rows], SALES)
        return {
            (r.date_key, r.store_key): r for r in facts.daily_summary(sales, names).collect()
        }

    return build


def test_ties_go_to_the_lowest_key(summary):
    row = summary(
        ("I1", 20220101, 1, 3, 2, 1, "10.00"),
        ("I2", 20220101, 1, 2, 1, 1, "4.00"),
        ("I3", 20220101, 1, 2, 1, 2, "6.00"),
        ("I3", 20220101, 1, 1, 2, 2, "9.99"),
    )[20220101, 1]
    assert row.top_category == "Clothing"
    assert row.top_payment_method == "Cash"
    assert (row.total_transactions, row.unique_customers) == (4, 2)


def test_top_category_sums_rows(summary):
    rows = summary(
        ("I1", 20220101, 1, 3, 2, 1, "5.00"),
        ("I1", 20220101, 1, 3, 2, 1, "6.00"),
        ("I2", 20220101, 1, 1, 1, 1, "10.00"),
        ("I2", 20220101, 2, 1, 1, 1, "1.00"),
    )
    assert rows[20220101, 1].top_category == "Shoes"
    assert rows[20220101, 2].top_category == "Books"


def test_average_rounds_half_up(summary):
    row = summary(
        ("I1", 20220101, 1, 1, 1, 1, "0.12"), ("I2", 20220101, 1, 1, 1, 1, "0.13")
    )[20220101, 1]
    assert row.avg_transaction_value == Decimal("0.13")
    assert row.total_revenue == Decimal("0.25")


def load_rows(warehouse, rows, holidays, load_id="a"):
    staged = stage(rows, warehouse.fresh("staged"))
    result = load(warehouse, staged, holidays, load_id)
    assert result["status"] == "success", result["error"]
    return result


def test_amounts(warehouse, feed, holidays):
    load_rows(
        warehouse,
        feed(
            {"quantity": "3", "price": "600.17"},
            {"quantity": "2.5", "price": "901.01"},
            {"quantity": "1", "price": "0.10", "invoice_date": "23/4/2022"},
        ),
        holidays,
    )
    rows = warehouse.read("fact_sales").orderBy("sale_id").collect()
    assert [r.total_amount for r in rows] == [
        Decimal("1800.51"),
        Decimal("2252.53"),
        Decimal("0.10"),
    ]
    assert [r.quantity for r in rows] == [3, 2, 1]
    assert [r.is_holiday for r in rows] == [False, False, True]
    assert [r.is_weekend for r in rows] == [False, False, True]
    # The fraction counts in the amount only, and the check says so.
    assert quality.amount_mismatch(warehouse.tables()).first()[0] == 1
    assert tuple(quality.amount_mismatch_in_sample(warehouse.tables()).first()) == (3, 1)


def test_a_missing_dimension_entry_is_an_error(warehouse, feed, holidays):
    load_rows(warehouse, feed({}), holidays)
    clean = check_rows(feed({"customer_id": "C999"})).select(clean_columns())
    sales = facts.keyed_sales(clean, warehouse.tables())
    assert facts.missing_keys(sales).count() == 1
    with pytest.raises(KeyError, match="I900"):
        facts.require_keys(sales)


def test_orphans_are_counted_as_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert orphan_rows(child, {"k": parent}).first().orphans == 3
    nothing = orphan_rows(child.limit(0), {"k": parent.limit(0)}).collect()
    assert [tuple(r) for r in nothing] == [("k", 0)]


def test_a_tiny_quantity_is_one(warehouse, feed, holidays):
    """Above zero as written, so the rule holds, and worth less than a cent."""
    load_rows(warehouse, feed({"quantity": "1e-12"}), holidays)
    row = warehouse.read("fact_sales").first()
    assert (row.quantity, row.total_amount) == (0, Decimal("0.00"))


def test_random_rows(spark):
    rows = spark.range(20_000)
    drawn = random_rows(rows, 100, ["id"], seed=1)
    ids = [r.id for r in drawn.collect()]
    assert len(set(ids)) == 100
    assert ids == [r.id for r in random_rows(rows.repartition(5), 100, ["id"], seed=1).collect()]
    assert ids != [r.id for r in random_rows(rows, 100, ["id"], seed=2).collect()]
    # Every tenth of the table is drawn from alike.
    many = random_rows(rows, 4_000, ["id"]).selectExpr("id div 2000 AS tenth")
    counts = [r["count"] for r in many.groupBy("tenth").count().collect()]
    assert len(counts) == 10 and sum((c - 400) ** 2 / 400 for c in counts) < 30
    assert random_rows(rows.limit(30), 100, ["id"]).count() == 30
    assert random_rows(rows.limit(0), 100, ["id"]).count() == 0
    # What is left to sort is about as much as is drawn.
    plan = random_rows(rows, 100, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    bound = int(re.search(r"< (\d{6,})", plan).group(1))
    assert bound < 0.01 * 16**15


@pytest.mark.parametrize("check", [quality.fk_orphans, quality.duplicate_keys])
def test_checks_read_each_table_once(warehouse, feed, holidays, check):
    load_rows(warehouse, feed({}), holidays)
    plan = check(warehouse.tables())._jdf.queryExecution().optimizedPlan().toString()
    relations = [line for line in plan.split("\n") if "Relation [" in line]
    assert len(relations) <= 7
    assert sum("sale_id" in line for line in relations) == 1


def test_shoppers_are_counted_before_a_shuffle(warehouse, feed, holidays, tmp_path):
    """A load's shoppers are distinct already; only their counts travel."""
    rows = feed({}, {"customer_id": "C71"}, {"customer_id": "C71", "price": "3"})
    load(warehouse, stage(rows, str(tmp_path / "staged")), holidays, "a")
    shoppers = warehouse.partitions(SHOPPERS)
    built = facts.summary_of(warehouse.partitions(CELLS), shoppers, warehouse.tables())
    assert [r.unique_customers for r in built.collect()] == [2]
    plan = built._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*customer_key[^)]*)\)", plan)
    assert keys == []
