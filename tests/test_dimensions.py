import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.functions.calendar import date_key, date_of_key, season
from tillroll.functions.people import age_group
from tillroll.operators.rules import check_rows, clean_columns
from tillroll.plans import dimensions


def clean(rows):
    return check_rows(rows).select(*clean_columns(), "_row_id")


def test_age_groups(spark):
    ages = {17: "Unknown", 18: "18-25", 25: "18-25", 26: "26-35", 35: "26-35", 36: "36-45",
            45: "36-45", 46: "46-55", 55: "46-55", 56: "56-69", 69: "56-69", 70: "Unknown"}
    rows = spark.createDataFrame([(a,) for a in ages], "age int")
    got = rows.select("age", age_group(F.col("age")).alias("g")).collect()
    assert {r.age: r.g for r in got} == ages
    missing = spark.createDataFrame([(None,)], "age int")
    assert missing.select(age_group(F.col("age")).alias("g")).first().g == "Unknown"


def test_calendar_agrees_with_python(spark):
    start = dt.date(2020, 12, 25)
    days = spark.range(800).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("invoice_date"))
    rows = dimensions.dim_time(days, spark.createDataFrame([], "date string")).collect()
    assert len(rows) == 800
    for r in rows:
        d = r.full_date
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert (r.week_number, r.day_of_week) == d.isocalendar()[1:]
        assert (r.day_name, r.month_name) == (d.strftime("%A"), d.strftime("%B"))
        assert (r.month_number, r.year, r.quarter) == (d.month, d.year, (d.month + 2) // 3)
        assert r.is_weekend == (d.weekday() >= 5)
        assert not r.is_holiday


def test_seasons_and_keys(spark):
    months = spark.range(1, 13).select(season(F.col("id")).alias("s")).collect()
    assert [r.s for r in months] == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    )
    back = spark.createDataFrame([(dt.date(2021, 9, 30),)], "d date").select(
        date_of_key(date_key(F.col("d"))).alias("d")
    )
    assert back.first().d == dt.date(2021, 9, 30)


HOLIDAYS = ["01-01", "04-23", "05-01", "05-19", "07-15", "08-30", "10-29"]


@pytest.mark.parametrize("legacy, expected", [(False, 15), (True, 16)])
def test_holidays_are_iso_dates(spark, legacy, expected):
    """The 797 days of the published calendar hold 15 holidays; 16 come out
    when the ISO text is read day-first."""
    days = spark.range(797).select(
        F.date_add(F.lit(dt.date(2021, 1, 1)), F.col("id").cast("int")).alias("invoice_date")
    )
    listed = spark.createDataFrame(
        [(f"{y}-{md}",) for y in (2021, 2022, 2023) for md in HOLIDAYS]
        + [(None,), ("",), ("someday",)],
        "date string",
    )
    time = dimensions.dim_time(days, listed, legacy)
    assert time.where("is_holiday").count() == expected


def test_customers_take_the_first_profile_seen(feed):
    rows = feed(
        {"customer_id": "C1", "gender": "Male", "age": "40", "invoice_date": "5/5/2022"},
        {"customer_id": "C2", "gender": "Female", "age": "17"},
        {"customer_id": "C1", "gender": "Female", "age": "20", "invoice_date": "1/5/2022"},
        {"customer_id": "C1", "gender": "Female", "age": "21", "invoice_date": "9/5/2022"},
    )
    got = {r.customer_id: r for r in dimensions.customer_batch(clean(rows)).collect()}
    one = got["C1"]
    assert (one.gender, one.age, one.age_group, one.total_transactions) == ("Male", 40, "36-45", 3)
    assert (one.first_purchase_date, one.last_purchase_date) == (
        dt.date(2022, 5, 1),
        dt.date(2022, 5, 9),
    )
    assert got["C2"].age_group == "Unknown"


def test_distinct_dimensions(feed):
    rows = clean(feed({"category": "Toys"}, {"category": "Books"}, {"category": "Books"}))
    assert [r.category for r in dimensions.dim_product(rows).collect()] == ["Books", "Toys"]
    assert [r.shopping_mall for r in dimensions.dim_store(rows).collect()] == ["Metrocity"]
    assert [r.payment_method for r in dimensions.dim_payment(rows).collect()] == ["Cash"]
