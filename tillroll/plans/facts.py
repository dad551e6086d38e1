"""Fact builders: keyed sales and the daily per-store summary."""

from pyspark.sql import functions as F

from tillroll.functions.calendar import date_key
from tillroll.operators.joins import top_by
from tillroll.schema import SEEDS, TABLES

FOUND = ["customer_key", "product_key", "store_key", "payment_key", "is_holiday", "is_weekend"]


def keyed_sales(clean, dims):
    """Clean rows with their keys, amount and day flags; a failed lookup leaves NULL.

    The seeded dimensions are written tables of a few rows and the calendar
    one row per day, so Spark broadcasts them by their file size. They come
    first: texts have become small keys when the rows are shuffled for the
    customer dimension, which grows with the data. Adaptive execution splits
    the partition of a customer with very many rows.
    """
    rows = clean.withColumns(
        {
            "date_key": date_key(F.col("invoice_date")),
            "total_amount": (F.col("quantity") * F.col("price")).cast("decimal(20,2)"),
            "price": F.col("price").cast("decimal(10,2)"),
            # A fraction counts towards the amount but is cut from the quantity.
            "quantity": F.col("quantity").cast("int"),
        }
    ).join(dims["dim_time"].select("date_key", "is_holiday", "is_weekend"), "date_key", "left")
    for table, (_, natural, _) in SEEDS.items():
        rows = rows.join(dims[table], natural, "left").drop(natural)
    rows = rows.drop("invoice_date", "gender", "age")
    customers = dims["dim_customer"].select("customer_id", "customer_key")
    return rows.join(customers, "customer_id", "left")


def missing_keys(sales):
    """Rows of :func:`keyed_sales` for which a dimension had no entry."""
    found = F.lit(True)
    for name in FOUND:
        found = found & F.col(name).isNotNull()
    return sales.where(~found)


def require_keys(sales):
    """The number of rows; KeyError, showing five of them, when a lookup failed."""
    found = F.lit(True)
    for name in FOUND:
        found = found & F.col(name).isNotNull()
    counted = sales.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~found).alias("missing")).first()
    if counted.missing:
        examples = missing_keys(sales).select("invoice_no", *FOUND).limit(5).collect()
        raise KeyError(f"no dimension entry for some rows, such as {examples}")
    return counted.rows


# All columns but the number, which the load gives out.
FACT_COLUMNS = [c for c in TABLES["fact_sales"].names if c != "sale_id"]

# A row of the summary.
PAIR = ["date_key", "store_key"]


def fact_sales(clean, dims):
    """One fact row per clean row, without ``sale_id``."""
    return keyed_sales(clean, dims).select(FACT_COLUMNS)


def summary_cells(sales):
    """Revenue and rows by day, store, product and payment: sums that add up over loads.

    One pass; the groups are few and combine before the shuffle, so one busy
    store or day is no hot spot. Rows are counted without reading the invoice
    number, which no fact row lacks.
    """
    return sales.groupBy(*PAIR, "product_key", "payment_key").agg(
        F.sum("total_amount").cast("decimal(30,2)").alias("revenue"),
        F.count(F.lit(1)).alias("rows"),
    )


def summary_shoppers(sales):
    """Who bought on a day at a store, once each: sets that unite over loads."""
    return sales.select(*PAIR, "customer_key").distinct()


def summary_of(cells, shoppers, dims):
    """The summary from cells and sets of shoppers, of one load or of several.

    The cells are summed per product and per payment at once; ties go to the lowest
    key. A shopper is named once per day and store, so they are counted before a shuffle.
    """
    levels = cells.groupingSets(
        [[F.col(c) for c in (*PAIR, "product_key")], [F.col(c) for c in (*PAIR, "payment_key")]],
        *PAIR,
        "product_key",
        "payment_key",
    ).agg(F.sum("revenue").alias("revenue"), F.sum("rows").alias("rows"))
    per_product = F.col("product_key").isNotNull()
    totals = levels.groupBy(PAIR).agg(
        F.sum(F.when(per_product, F.col("revenue"))).cast("decimal(30,2)").alias("total_revenue"),
        F.sum(F.when(per_product, F.col("rows"))).alias("total_transactions"),
        top_by("revenue", "product_key").alias("product_key"),
        top_by("rows", "payment_key").alias("payment_key"),
    )
    counted = shoppers.groupBy(PAIR).agg(F.count("customer_key").alias("unique_customers"))
    return (
        totals.join(counted, PAIR)
        .join(dims["dim_product"], "product_key", "left")
        .join(dims["dim_payment"], "payment_key", "left")
        .select(
            *PAIR,
            "total_revenue",
            "total_transactions",
            (F.col("total_revenue") / F.col("total_transactions"))
            .cast("decimal(20,2)")
            .alias("avg_transaction_value"),
            "unique_customers",
            F.col("category").alias("top_category"),
            F.col("payment_method").alias("top_payment_method"),
        )
    )


def daily_summary(sales, dims):
    """Per day and store: revenue, rows, average, customers and the two tops."""
    return summary_of(summary_cells(sales), summary_shoppers(sales), dims)
