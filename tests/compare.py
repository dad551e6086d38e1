"""Run a query in Spark and its SQL in DuckDB and compare the rows exactly."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark_rows, con, sql):
    """What differs between a DataFrame and a query's result, or None."""
    got_names = spark_rows.columns
    got = _rows(got_names, [tuple(r) for r in spark_rows.collect()])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = _rows(names, answer.fetchall())
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} instead of {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{mine} instead of {theirs}"
    return None
