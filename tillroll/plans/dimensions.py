"""Dimension builders over clean rows."""

from pyspark.sql import functions as F

from tillroll.functions.calendar import date_key, iso_weekday, season
from tillroll.functions.people import age_group
from tillroll.schema import GENDERS, SEEDS, TABLES, conform
from tillroll.sources.holidays import holiday_dates


def dim_time(clean, holidays, legacy_holiday_parse=False):
    """One row per distinct sale date, with calendar attributes."""
    day = F.col("full_date")
    dates = clean.select(F.col("invoice_date").alias("full_date")).where(day.isNotNull()).distinct()
    marked = holiday_dates(holidays, legacy_holiday_parse).withColumn("_holiday", F.lit(True))
    attributes = {
        "date_key": date_key(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_week": iso_weekday(day),
        "week_number": F.weekofyear(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": iso_weekday(day) >= 6,
        "is_holiday": F.col("_holiday").isNotNull(),
        "season": season(F.month(day)),
    }
    return conform(dates.join(marked, "full_date", "left").withColumns(attributes), "dim_time")


def profile_of(gender, age):
    """Gender and age as one number, NULL unless both are known.

    A gender is its place in the list, from 1; the rules have passed no other.
    """
    listed = F.array(*[F.lit(g) for g in GENDERS])
    return age.cast("long") * (len(GENDERS) + 1) + F.array_position(listed, gender)


def profile_parts(profile):
    """Gender and age out of :func:`profile_of`."""
    base = len(GENDERS) + 1
    listed = F.array(*[F.lit(g) for g in GENDERS])
    gender = F.get(listed, (profile % base - 1).cast("int"))
    return gender, F.floor(profile / base).cast("int")


def customer_batch(clean):
    """One row per customer, without key: first-seen profile and purchase metrics.

    ``_row_id`` gives the input order. Gender and age travel as one number, so
    the aggregation buffer is all numbers and stays in the hash aggregate; the
    map-side half of it shrinks a customer with very many rows to one row per
    task.
    """
    profile = profile_of(F.col("gender"), F.col("age"))
    grouped = clean.groupBy("customer_id").agg(
        F.min_by(profile, F.when(profile.isNotNull(), F.col("_row_id"))).alias("_profile"),
        F.min("invoice_date").alias("first_purchase_date"),
        F.max("invoice_date").alias("last_purchase_date"),
        F.count("invoice_no").alias("total_transactions"),
    )
    gender, age = profile_parts(F.col("_profile"))
    return grouped.select(
        "customer_id",
        gender.alias("gender"),
        age.alias("age"),
        age_group(age).alias("age_group"),
        "first_purchase_date",
        "last_purchase_date",
        "total_transactions",
    )


def distinct_values(clean, column):
    """Sorted distinct non-null values of a column."""
    return clean.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def dim_product(clean):
    return distinct_values(clean, "category")


def dim_store(clean):
    return distinct_values(clean, "shopping_mall")


def dim_payment(clean):
    return distinct_values(clean, "payment_method")


def seed_rows(spark, table):
    """A seeded dimension's fixed values, keyed by their place in the list."""
    key, natural, values = SEEDS[table]
    return spark.createDataFrame(
        [(place, value) for place, value in enumerate(values, start=1)], TABLES[table]
    ).select(key, natural)


def dimensions(clean, holidays, legacy_holiday_parse=False):
    """All five dimensions of clean rows, before keys are given out."""
    return {
        "dim_time": dim_time(clean, holidays, legacy_holiday_parse),
        "dim_customer": customer_batch(clean),
        "dim_product": dim_product(clean),
        "dim_store": dim_store(clean),
        "dim_payment": dim_payment(clean),
    }
