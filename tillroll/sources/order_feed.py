"""The order tables seen as a retail transaction feed.

One line item becomes one transaction row of ten text cells, as a CSV file
would hold it. Shopper, mall, category and payment follow from the row's keys,
so the feed grows with the tables. With ``with_faults`` (the default) a fixed
share of rows is spoiled, by a key-derived number, to exercise the row rules.
"""

from pyspark.sql import functions as F

from tillroll.schema import CATEGORIES, MALLS, PAYMENT_METHODS

HOLIDAY_MONTH_DAYS = ["01-01", "04-23", "05-01", "05-19", "07-15", "08-30", "10-29"]


def _pick(values, number):
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def order_feed(spark, sf_dir, with_faults=True, extra=()):
    """Ten text columns, one row per line item; ``extra`` names columns of it to keep."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("l_partkey"), "p_retailprice"
    )
    shopper = F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    age = (
        F.when(shopper % 97 == 0, F.lit(10))
        .when(shopper % 89 == 0, F.lit(80))
        .otherwise(18 + shopper % 52)
    )
    cells = {
        "invoice_no": F.concat(F.lit("I"), "l_orderkey"),
        "customer_id": F.concat(F.lit("C"), shopper),
        "gender": F.when(shopper % 2 == 0, "Female").otherwise("Male"),
        "age": age.cast("string"),
        "category": _pick(CATEGORIES, F.col("l_partkey")),
        "quantity": F.col("l_quantity").cast("int").cast("string"),
        "price": F.col("p_retailprice").cast("decimal(10,2)").cast("string"),
        "payment_method": _pick(PAYMENT_METHODS, F.col("l_orderkey")),
        "invoice_date": F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day)),
        "shopping_mall": _pick(MALLS, F.col("l_suppkey")),
    }
    if with_faults:
        cells = _spoil(cells, day)
    return lines.join(orders, "l_orderkey").join(parts, "l_partkey").select(
        *[cell.alias(name) for name, cell in cells.items()], *extra
    )


def _spoil(cells, day):
    """Replace cells by case number: 0 to 11 break one rule each, 12 breaks two,
    13 to 15 look odd but are valid, 16 hides a value behind a null token, 17 to 19
    put white space of all kinds behind an id, 20 to 24 hold numbers just inside or
    outside what is allowed, 25 has a very large amount."""
    case = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 101
    none = F.lit(None).cast("string")

    def padded(name):
        return F.concat(F.lit("  "), cells[name], F.lit(" "))

    changes = {
        "invoice_no": {0: none, 1: F.concat(F.lit("X"), "l_orderkey")},
        "customer_id": {
            2: none,
            3: F.concat(F.lit("K"), "o_custkey"),
            16: F.lit("N/A"),
            17: F.concat(cells["customer_id"], F.lit("\u0085")),
            18: F.concat(cells["customer_id"], F.lit("\u2028")),
            19: F.concat(cells["customer_id"], F.lit("\n")),
        },
        "gender": {4: F.lit("Unstated"), 12: F.lit(""), 13: padded("gender")},
        "age": {5: F.lit("150"), 20: F.lit("120.00004"), 21: F.lit("0.99996")},
        "category": {6: F.lit("Garden"), 13: padded("category")},
        "quantity": {
            7: F.lit("0"),
            15: F.concat(cells["quantity"], F.lit(".5")),
            22: F.lit("0.0000001"),
            23: F.lit("3000000000"),
            25: F.lit("2000000"),
        },
        "price": {
            8: F.lit("-1.00"),
            12: F.lit("NaN"),
            24: F.lit("99999999.999"),
            25: F.lit("99999999.00"),
        },
        "payment_method": {9: F.lit("Voucher"), 13: padded("payment_method")},
        "invoice_date": {10: F.lit("31/02/1996"), 14: F.date_format(day, "dd/MM/yyyy")},
        "shopping_mall": {11: F.lit("Harbour Arcade"), 13: padded("shopping_mall")},
    }
    spoiled = dict(cells)
    for name, by_case in changes.items():
        branches = None
        for number, value in by_case.items():
            branches = (
                F.when(case == number, value)
                if branches is None
                else branches.when(case == number, value)
            )
        spoiled[name] = branches.otherwise(cells[name])
    return spoiled


def order_holidays(spark, sf_dir):
    """The same seven holidays in every year that has orders."""
    years = (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .select(F.year("o_orderdate").alias("year"))
        .distinct()
    )
    return years.select(
        F.explode(
            F.transform(
                F.array(*map(F.lit, HOLIDAY_MONTH_DAYS)),
                lambda month_day: F.concat(F.col("year").cast("string"), F.lit("-"), month_day),
            )
        ).alias("date")
    )
