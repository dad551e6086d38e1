"""Integrity checks on the star schema.

Each check is a table; :func:`check_warehouse` gathers them into one report of
``(check, violations)`` rows where zero means passed.
"""

from functools import reduce

from pyspark.sql import functions as F

from tillroll.operators.joins import orphan_rows
from tillroll.operators.sampling import random_rows
from tillroll.schema import FOREIGN_KEYS, SEEDS, TABLES, UNIQUE_KEYS


def _stack(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def fk_orphans(tables):
    """Fact rows per foreign key whose dimension entry is missing; one pass over the fact."""
    parents = {key: tables[dim].select(key) for key, dim in FOREIGN_KEYS.items()}
    return orphan_rows(tables["fact_sales"], parents)


def null_keys(tables):
    """Fact rows with any foreign key missing."""
    missing = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in FOREIGN_KEYS])
    return tables["fact_sales"].agg(F.count_if(missing).alias("null_key_rows"))


def _amount_off():
    return F.abs(F.col("total_amount") - F.col("quantity") * F.col("price")) > 0.01


def amount_mismatch(tables):
    """Fact rows whose amount is not quantity times price, over the whole fact."""
    return tables["fact_sales"].agg(F.count_if(_amount_off()).alias("mismatched_rows"))


def amount_mismatch_in_sample(tables, n=100, seed=0, keys=("sale_id",)):
    """The same check on a random sample of ``n`` fact rows, with how many were drawn."""
    return random_rows(tables["fact_sales"], n, keys, seed).agg(
        F.count(F.lit(1)).alias("drawn"), F.count_if(_amount_off()).alias("mismatched_rows")
    )


def _key_values(rows, keys):
    """The values of one unique key as up to two numbers and a text."""
    kinds = dict(rows.dtypes)
    texts = [F.col(k) for k in keys if kinds[k] == "string"]
    numbers = [F.col(k).cast("long") for k in keys if kinds[k] != "string"]
    none = F.lit(None)
    numbers += [none.cast("long")] * (2 - len(numbers))
    texts += [none.cast("string")] * (1 - len(texts))
    return F.struct(
        F.lit(",".join(keys)).alias("unique_key"),
        *[c.alias(name) for c, name in zip([*numbers, *texts], ["a", "b", "c"], strict=True)],
    )


def duplicate_keys(tables):
    """Per declared unique key, the number of values held by several rows.

    Each table is read once: a row gives one entry per key it must be unique in. Tables
    without a row, and keys without a repeat, come with 0.
    """
    entries, names = [], []
    for table, choices in UNIQUE_KEYS.items():
        rows = tables[table]
        values = F.array(*[_key_values(rows, keys) for keys in choices])
        entries.append(
            rows.select(F.explode(values).alias("value")).select(
                F.lit(table).alias("table_name"), "value.*"
            )
        )
        names += [(table, ",".join(keys)) for keys in choices]
    per_value = (
        _stack(entries)
        .groupBy("table_name", "unique_key", "a", "b", "c")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    found = per_value.groupBy("table_name", "unique_key").agg(
        F.count_if(F.col("rows") > 1).alias("repeated_keys")
    )
    spark = entries[0].sparkSession
    # As many rows as there are declared keys.
    declared = spark.createDataFrame(names, "table_name string, unique_key string")
    return declared.join(found, ["table_name", "unique_key"], "left").na.fill(0)


def table_counts(tables):
    """Row count of every table; Parquet answers from its footers."""
    return _stack(
        [
            tables[table].agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table).alias("table_name"), "row_count")
            for table in TABLES
        ]
    )


def dim_counts(tables):
    """Row counts of the seeded dimensions against their fixed sizes."""
    return _stack(
        [
            tables[table].agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(table).alias("table_name"),
                "row_count",
                F.lit(len(values)).cast("long").alias("expected_count"),
            )
            for table, (_, _, values) in SEEDS.items()
        ]
    )


def holiday_days(tables):
    """Calendar days flagged as holidays; a warehouse should have some."""
    return tables["dim_time"].agg(F.count_if("is_holiday").alias("holiday_days"))


def fact_count_within(tables, low=94_000, high=100_000):
    """The fact's row count and whether it lies in the expected range."""
    count = F.count(F.lit(1))
    return tables["fact_sales"].agg(
        count.alias("row_count"), count.between(low, high).alias("within")
    )


def check_warehouse(tables):
    """All row checks as ``(check, violations)``."""
    rows = [
        fk_orphans(tables).select(
            F.concat(F.lit("orphans "), "foreign_key").alias("check"),
            F.col("orphans").alias("violations"),
        ),
        null_keys(tables).select(
            F.lit("null keys").alias("check"), F.col("null_key_rows").alias("violations")
        ),
        amount_mismatch(tables).select(
            F.lit("amounts").alias("check"), F.col("mismatched_rows").alias("violations")
        ),
        duplicate_keys(tables).select(
            F.concat_ws(" ", F.lit("unique"), "table_name", "unique_key").alias("check"),
            F.col("repeated_keys").alias("violations"),
        ),
        dim_counts(tables).select(
            F.concat(F.lit("size of "), "table_name").alias("check"),
            F.abs(F.col("row_count") - F.col("expected_count")).alias("violations"),
        ),
        holiday_days(tables).select(
            F.lit("has holidays").alias("check"),
            F.when(F.col("holiday_days") > 0, 0).otherwise(1).cast("long").alias("violations"),
        ),
    ]
    return _stack(rows)
