"""Insert-or-replace and insert-if-absent on key columns."""

from pyspark.sql import functions as F


def require_unique(rows, keys):
    """Raise ValueError, naming up to five keys, when a key repeats."""
    repeated = repeated_keys(rows, keys).limit(5).collect()
    if repeated:
        shown = [tuple(row[k] for k in keys) for row in repeated]
        raise ValueError(f"repeated {', '.join(keys)}: {shown}")


def repeated_keys(rows, keys):
    """Keys held by more than one row, with their row counts."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def upsert(existing, incoming, keys, check=True):
    """Existing rows with every incoming row inserted or put in place of its key.

    A key repeated within ``incoming`` is an error, unless the caller knows it
    to be unique and passes ``check=False``.
    """
    if check:
        require_unique(incoming, keys)
    return existing.join(incoming.select(keys), keys, "left_anti").unionByName(incoming)


def insert_absent(existing, incoming, keys):
    """Incoming rows whose key the existing table lacks."""
    return incoming.join(existing.select(keys), keys, "left_anti")
