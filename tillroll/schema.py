"""Fixed values and table shapes."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
SOURCE_COLUMNS = [
    "invoice_no",
    "customer_id",
    "gender",
    "age",
    "category",
    "quantity",
    "price",
    "payment_method",
    "invoice_date",
    "shopping_mall",
]

MALLS = [
    "Kanyon",
    "Forum Istanbul",
    "Metrocity",
    "Metropol AVM",
    "Istinye Park",
    "Mall of Istanbul",
    "Emaar Square Mall",
    "Cevahir AVM",
    "Viaport Outlet",
    "Zorlu Center",
]

CATEGORIES = [
    "Books",
    "Clothing",
    "Cosmetics",
    "Food & Beverage",
    "Shoes",
    "Souvenir",
    "Technology",
    "Toys",
]

PAYMENT_METHODS = ["Cash", "Credit Card", "Debit Card"]

GENDERS = ["Male", "Female"]

MIN_AGE = 1
MAX_AGE = 120

AGE_GROUPS = [(18, 25), (26, 35), (36, 45), (46, 55), (56, 69)]

DATE_FORMAT = "d/M/yyyy"

# Texts that stand for "no value" in a CSV cell (the pandas defaults).
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

RULE_NAMES = [
    "null_invoice_no",
    "invalid_invoice_no_prefix",
    "null_customer_id",
    "invalid_customer_id_prefix",
    "invalid_gender",
    "invalid_age",
    "invalid_category",
    "invalid_quantity",
    "invalid_price",
    "invalid_payment_method",
    "invalid_invoice_date",
    "invalid_shopping_mall",
]

MONTHS = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]


def _table(*columns):
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()
_DATE, _FLAG = T.DateType(), T.BooleanType()

RAW_SCHEMA = _table(*[(c, _TEXT) for c in SOURCE_COLUMNS])

# Quantity and price keep nine decimals until the amount is worked out; their
# whole part holds what the INT and DECIMAL(10,2) columns they end in hold.
CLEAN_SCHEMA = _table(
    ("invoice_no", _TEXT),
    ("customer_id", _TEXT),
    ("gender", _TEXT),
    ("age", _INT),
    ("category", _TEXT),
    ("quantity", T.DecimalType(20, 9)),
    ("price", T.DecimalType(18, 9)),
    ("payment_method", _TEXT),
    ("invoice_date", _DATE),
    ("shopping_mall", _TEXT),
)

# The largest amount of a row is 2**31 times 10**8; sums of them never overflow.
TABLES = {
    "dim_time": _table(
        ("date_key", _INT),
        ("full_date", _DATE),
        ("day_name", _TEXT),
        ("day_of_week", _INT),
        ("week_number", _INT),
        ("month_number", _INT),
        ("month_name", _TEXT),
        ("quarter", _INT),
        ("year", _INT),
        ("is_weekend", _FLAG),
        ("is_holiday", _FLAG),
        ("season", _TEXT),
    ),
    "dim_customer": _table(
        ("customer_key", _LONG),
        ("customer_id", _TEXT),
        ("gender", _TEXT),
        ("age", _INT),
        ("age_group", _TEXT),
        ("first_purchase_date", _DATE),
        ("last_purchase_date", _DATE),
        ("total_transactions", _LONG),
    ),
    "dim_product": _table(("product_key", _INT), ("category", _TEXT)),
    "dim_store": _table(("store_key", _INT), ("shopping_mall", _TEXT)),
    "dim_payment": _table(("payment_key", _INT), ("payment_method", _TEXT)),
    "fact_sales": _table(
        ("sale_id", _LONG),
        ("invoice_no", _TEXT),
        ("date_key", _INT),
        ("customer_key", _LONG),
        ("product_key", _INT),
        ("store_key", _INT),
        ("payment_key", _INT),
        ("quantity", _INT),
        ("price", T.DecimalType(10, 2)),
        ("total_amount", T.DecimalType(20, 2)),
        ("is_holiday", _FLAG),
        ("is_weekend", _FLAG),
    ),
    "fact_daily_summary": _table(
        ("summary_id", _LONG),
        ("date_key", _INT),
        ("store_key", _INT),
        ("total_revenue", T.DecimalType(30, 2)),
        ("total_transactions", _LONG),
        ("avg_transaction_value", T.DecimalType(20, 2)),
        ("unique_customers", _LONG),
        ("top_category", _TEXT),
        ("top_payment_method", _TEXT),
    ),
}

# --- end of fixed values ----------------------------------------------------

# Seeded dimensions: table -> (key column, natural column, values in key order).
SEEDS = {
    "dim_product": ("product_key", "category", CATEGORIES),
    "dim_store": ("store_key", "shopping_mall", MALLS),
    "dim_payment": ("payment_key", "payment_method", PAYMENT_METHODS),
}

# Columns that must be unique in each table.
UNIQUE_KEYS = {
    "dim_time": [["date_key"]],
    "dim_customer": [["customer_key"], ["customer_id"]],
    "dim_product": [["product_key"], ["category"]],
    "dim_store": [["store_key"], ["shopping_mall"]],
    "dim_payment": [["payment_key"], ["payment_method"]],
    "fact_sales": [["sale_id"]],
    "fact_daily_summary": [["summary_id"], ["date_key", "store_key"]],
}

FOREIGN_KEYS = {
    "date_key": "dim_time",
    "customer_key": "dim_customer",
    "product_key": "dim_product",
    "store_key": "dim_store",
    "payment_key": "dim_payment",
}


def conform(df, table):
    """Select a table's columns in order with their declared types."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in TABLES[table].fields])
