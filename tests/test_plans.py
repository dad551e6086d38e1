"""Shapes of the physical plans, and data with one very common key."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tillroll import registry
from tillroll.operators.rules import check_rows
from tillroll.plans import reports
from tillroll.plans.facts import keyed_sales
from tillroll.plans.loading import load, stage
from tillroll.schema import RAW_SCHEMA

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def columns_read(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@needs_tables
def test_reports_read_few_fact_columns(spark):
    tables = registry.star(spark, SF_DIR).tables
    reads = columns_read(plan(reports.revenue_by_mall(tables)))
    assert any(r == "store_key:int,quantity:int,total_amount:decimal(20,2)" or
               r == "store_key:int,total_amount:decimal(20,2)" for r in reads)
    assert all("invoice_no" not in r for r in reads)


@needs_tables
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(registry.QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert operator not in text


def test_checks_take_one_codegen_stage(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([], RAW_SCHEMA).write.parquet(path)
    rows = check_rows(spark.read.schema(RAW_SCHEMA).parquet(path))
    assert plan(rows.select("_errors")).count("Scan") == 1
    assert "*(1) Project" in plan(rows.select("_errors", "_price"))


@pytest.fixture
def lopsided(spark):
    """One customer, day, mall and invoice hold a third of all rows, as exact copies."""

    def build(n):
        number = F.col("id")
        hot = number % 3 == 0

        def cell(common, other):
            return F.when(hot, common).otherwise(other)

        return spark.range(0, n, 1, 6).select(
            cell("I1", F.concat(F.lit("I"), number)).alias("invoice_no"),
            cell("C1", F.concat(F.lit("C"), number + 100_000)).alias("customer_id"),
            F.lit("Male").alias("gender"),
            F.lit("30").alias("age"),
            F.lit("Toys").alias("category"),
            F.lit("1").alias("quantity"),
            F.lit("2.00").alias("price"),
            F.lit("Cash").alias("payment_method"),
            cell("1/1/2022", F.concat((number % 28 + 1).cast("string"), F.lit("/2/2022"))).alias(
                "invoice_date"
            ),
            cell("Kanyon", "Metrocity").alias("shopping_mall"),
        )

    return build


def test_a_third_of_the_rows_in_one_place(warehouse, lopsided, holidays):
    n = 9000
    result = load(warehouse, stage(lopsided(n), warehouse.fresh("staged")), holidays, "hot")
    assert result["status"] == "success", result["error"]
    tables = warehouse.tables()
    ids = tables["fact_sales"].agg(F.countDistinct("sale_id"), F.max("sale_id")).first()
    assert tuple(ids) == (n, n)
    best = reports.top_customers(tables).first()
    assert (best.customer_id, best.total_spent) == ("C1", 6000)
    day = tables["fact_daily_summary"].where("date_key = 20220101").first()
    assert (day.total_transactions, day.unique_customers) == (3000, 1)
    assert reports.kpi_overview(tables).first().unique_customers == 6001


def test_the_customer_join_splits_a_hot_customer(spark, warehouse, lopsided, holidays):
    """The same join as in a load, with thresholds scaled down to the test's size."""
    staged = stage(lopsided(60_000), warehouse.fresh("staged"))
    assert load(warehouse, staged, holidays, "hot")["status"] == "success"
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings if name in spark.conf.getAll}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tables = warehouse.tables()
        narrow = {name: F.broadcast(tables[name]) for name in tables if name != "dim_customer"}
        rows = keyed_sales(staged.valid, {**narrow, "dim_customer": tables["dim_customer"]})
        assert len(rows.collect()) == 60_000
        assert "skew=true" in plan(rows)
    finally:
        for name in settings:
            spark.conf.set(name, before[name]) if name in before else spark.conf.unset(name)
