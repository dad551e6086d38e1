"""Public-holiday calendars kept as JSON arrays, one object per holiday."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.transactions import check_location

HOLIDAY_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("localName", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("countryCode", T.StringType()),
        T.StructField("fixed", T.BooleanType()),
        T.StructField("global", T.BooleanType()),
        T.StructField("counties", T.ArrayType(T.StringType())),
        T.StructField("launchYear", T.IntegerType()),
        T.StructField("types", T.ArrayType(T.StringType())),
    ]
)


def read_holidays(spark, paths, source="local"):
    """Holidays of one or more JSON files (say, one per year) in one table.

    Each file must be an array of objects; anything else raises ValueError.
    """
    check_location(source, paths)
    # A JSON value that is no array, or holds something other than objects,
    # does not match this type and comes back NULL.
    listing = T.ArrayType(HOLIDAY_SCHEMA)
    files = spark.read.option("wholetext", True).text(paths).select(
        F.from_json("value", listing).alias("holidays"),
        F.btrim("value").startswith("[").alias("is_array"),
    )
    broken = files.where(
        F.col("holidays").isNull() | ~F.col("is_array") | F.exists("holidays", lambda h: h.isNull())
    )
    if broken.limit(1).count():
        raise ValueError("holiday files must hold a JSON array of objects")
    return files.select(F.explode("holidays").alias("h")).select("h.*")


def holiday_dates(holidays, legacy_holiday_parse=False):
    """Distinct dates of a holiday table; entries without a readable date drop out.

    ``legacy_holiday_parse`` reads the ISO text day-first, so month and day
    swap whenever the swapped date exists.
    """
    day = F.try_to_date("date", "yyyy-M-d")
    if legacy_holiday_parse:
        day = F.coalesce(F.try_to_date("date", "yyyy-d-M"), day)
    return holidays.select(day.alias("full_date")).where("full_date is not null").distinct()


def holiday_range(holidays):
    """One row: ``<first> to <last>`` holiday date, or ``unknown``."""
    named = holidays.where("date is not null and date <> ''")
    return named.agg(
        F.when(
            F.count("date") > 0, F.concat(F.min("date"), F.lit(" to "), F.max("date"))
        ).otherwise("unknown").alias("date_range")
    )


def save_holidays(holidays, path):
    """Write holidays below ``path`` as one JSON array, as :func:`read_holidays` reads it.

    A calendar has a few rows per year, so one row can hold it.
    """
    listing = F.array_agg(F.struct(*holidays.columns))
    holidays.agg(F.to_json(F.array_sort(listing)).alias("value")).coalesce(1).write.text(path)
