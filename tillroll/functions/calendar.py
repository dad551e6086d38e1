"""Calendar attributes of a date column."""

from pyspark.sql import functions as F


def date_key(day):
    """A date as the integer YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_of_key(key):
    """The date behind an integer YYYYMMDD."""
    return F.make_date(
        F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100
    )


def season(month):
    """Meteorological season of a month number."""
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .otherwise("Autumn")
    )


def iso_weekday(day):
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def month_period(day):
    """A date as YYYY-MM."""
    return F.date_format(day, "yyyy-MM")


def quarter_period(day):
    """A date as YYYYQn."""
    return F.concat(F.year(day), F.lit("Q"), F.quarter(day))


def flag_label(flag, when_true, when_false):
    """Readable label of a boolean column; NULL stays NULL."""
    return F.when(flag, when_true).when(~flag, when_false)
