"""Reporting queries over the star schema.

Each takes ``tables``, a mapping of table name to DataFrame. Additive measures
are first summed per foreign key on the fact alone: that reads two or three
columns, shrinks the fact to one row per key before the shuffle, and leaves the
dimensions to join with a small result. A key without a dimension entry drops
out, as in an inner join of the fact.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.functions.calendar import flag_label, month_period, quarter_period
from tillroll.schema import MONTHS

def _revenue():
    return F.sum("total_amount")


def _rows():
    return F.count(F.lit(1))


def _ratio(amount, count):
    """Amount per count as a double; 0 when there is nothing to count."""
    return F.when(count > 0, amount.cast("double") / count).otherwise(0.0)


def _sums(tables, *keys):
    """Revenue, rows and quantity of the fact per foreign key."""
    return tables["fact_sales"].groupBy(*keys).agg(
        _revenue().alias("revenue"), _rows().alias("rows"), F.sum("quantity").alias("quantity")
    )


def _revenue_by(tables, key, dim, *columns, name):
    """Total revenue by dimension columns reached through one foreign key."""
    return (
        _sums(tables, key)
        .join(tables[dim], key)
        .groupBy(*columns)
        .agg(F.sum("revenue").alias(name))
    )


# --- standard reports -------------------------------------------------------


def revenue_by_mall(tables):
    return _revenue_by(
        tables, "store_key", "dim_store", "shopping_mall", name="total_revenue"
    ).orderBy(F.desc("total_revenue"), "shopping_mall")


def top_categories(tables, n=5):
    return (
        _revenue_by(tables, "product_key", "dim_product", "category", name="total_revenue")
        .orderBy(F.desc("total_revenue"), "category")
        .limit(n)
    )


def monthly_trend(tables):
    return _revenue_by(
        tables,
        "date_key",
        "dim_time",
        "year",
        F.col("month_number").alias("month"),
        name="total_revenue",
    ).orderBy("year", "month")


def holiday_average(tables):
    return (
        _sums(tables, "date_key")
        .join(tables["dim_time"], "date_key")
        .groupBy("is_holiday")
        .agg(_ratio(F.sum("revenue"), F.sum("rows")).alias("avg_transaction_value"))
        .orderBy(F.desc("is_holiday"))
    )


def _buyers(tables):
    """Customers with at least one sale; the fact's keys are made distinct first,
    so the join sees each customer once."""
    bought = tables["fact_sales"].select("customer_key").distinct()
    return tables["dim_customer"].join(bought, "customer_key", "left_semi")


def customers_by_age_and_gender(tables):
    return (
        _buyers(tables)
        .groupBy("age_group", "gender")
        .agg(_rows().alias("customer_count"))
        .orderBy("age_group", "gender")
    )


def payments_by_mall(tables):
    return (
        _sums(tables, "store_key", "payment_key")
        .join(tables["dim_store"], "store_key")
        .join(tables["dim_payment"], "payment_key")
        .groupBy("shopping_mall", "payment_method")
        .agg(F.sum("rows").alias("transaction_count"), F.sum("revenue").alias("total_revenue"))
        .orderBy("shopping_mall", F.desc("transaction_count"), "payment_method")
    )


def weekend_revenue(tables):
    return _revenue_by(
        tables, "date_key", "dim_time", "is_weekend", name="total_revenue"
    ).orderBy(F.desc("is_weekend"))


def seasonal_revenue(tables):
    return _revenue_by(
        tables, "date_key", "dim_time", "season", name="total_revenue"
    ).orderBy(F.desc("total_revenue"), "season")


def top_customers(tables, n=10):
    """Biggest spenders, equal spenders by key. Only the winners meet the dimension."""
    winners = (
        tables["fact_sales"]
        .groupBy("customer_key")
        .agg(_revenue().alias("total_spent"))
        .join(tables["dim_customer"].select("customer_key"), "customer_key", "left_semi")
        .orderBy(F.desc("total_spent"), "customer_key")
        .limit(n)
    )
    # ``n`` rows by construction, so the broadcast is bounded.
    return (
        tables["dim_customer"]
        .join(F.broadcast(winners), "customer_key")
        .orderBy(F.desc("total_spent"), "customer_key")
        .select("customer_id", "age_group", "gender", "total_spent")
    )


def daily_summary_for_mall(tables, mall_name):
    store = tables["dim_store"].where(F.col("shopping_mall") == mall_name)
    return (
        tables["fact_daily_summary"]
        .join(store, "store_key")
        .join(tables["dim_time"], "date_key")
        .select(
            "full_date",
            "shopping_mall",
            "total_revenue",
            "total_transactions",
            "avg_transaction_value",
            "unique_customers",
            "top_category",
            "top_payment_method",
        )
        .orderBy("full_date")
    )


# --- dashboard aggregates ---------------------------------------------------


def sales_base(tables):
    """One wide row per sale: the fact with the columns of all five dimensions."""
    return (
        tables["fact_sales"]
        .drop("is_holiday", "is_weekend")
        .join(tables["dim_time"], "date_key")
        .join(tables["dim_product"], "product_key")
        .join(tables["dim_store"], "store_key")
        .join(tables["dim_payment"], "payment_key")
        .join(tables["dim_customer"], "customer_key")
        .select(
            "sale_id",
            "invoice_no",
            "full_date",
            "year",
            "month_name",
            "day_name",
            "is_weekend",
            "is_holiday",
            "customer_id",
            "gender",
            "age",
            "age_group",
            "category",
            "shopping_mall",
            "payment_method",
            "quantity",
            "price",
            "total_amount",
        )
    )


def kpi_overview(tables):
    invoices = F.countDistinct("invoice_no")
    return tables["fact_sales"].agg(
        F.coalesce(_revenue(), F.lit(0)).alias("total_revenue"),
        invoices.alias("transactions"),
        F.countDistinct("customer_key").alias("unique_customers"),
        F.coalesce(_ratio(_revenue(), invoices), F.lit(0.0)).alias("avg_order_value"),
    )


def monthly_revenue(tables):
    return _revenue_by(
        tables,
        "date_key",
        "dim_time",
        month_period(F.col("full_date")).alias("month"),
        name="revenue",
    ).orderBy("month")


def quarterly_revenue(tables):
    return _revenue_by(
        tables,
        "date_key",
        "dim_time",
        quarter_period(F.col("full_date")).alias("quarter"),
        name="revenue",
    ).orderBy("quarter")


def _mall_measures(sales):
    return sales.groupBy("store_key").agg(
        _revenue().alias("revenue"),
        F.countDistinct("invoice_no").alias("transactions"),
        F.countDistinct("customer_key").alias("unique_customers"),
        F.sum("quantity").alias("total_quantity"),
        _ratio(_revenue(), _rows()).alias("avg_row_value"),
    )


def mall_metrics(tables):
    """Per mall; the average is over rows, the transactions are distinct invoices."""
    return (
        _mall_measures(tables["fact_sales"])
        .join(tables["dim_store"], "store_key")
        .select(
            "shopping_mall",
            "revenue",
            "transactions",
            F.col("unique_customers").alias("customers"),
            F.col("avg_row_value").alias("avg_basket"),
        )
        .orderBy(F.desc("revenue"), "shopping_mall")
    )


def mall_detail(tables, mall_name):
    """The metrics of one mall, with the quantity sold."""
    store = tables["dim_store"].where(F.col("shopping_mall") == mall_name)
    sales = tables["fact_sales"].join(store.select("store_key"), "store_key", "left_semi")
    return (
        _mall_measures(sales)
        .join(store, "store_key")
        .select(
            "shopping_mall",
            "revenue",
            "transactions",
            "unique_customers",
            "total_quantity",
            F.col("avg_row_value").alias("avg_transaction_value"),
        )
    )


def mall_list(tables):
    """Malls that have sales, in name order."""
    return (
        tables["fact_sales"]
        .select("store_key")
        .distinct()
        .join(tables["dim_store"], "store_key")
        .select("shopping_mall")
        .where("shopping_mall is not null")
        .distinct()
        .orderBy("shopping_mall")
    )


def _with_share(totals, measure):
    """Add each row's share of the column total.

    ``totals`` has one row per category, gender or payment method, so the
    window over all of it handles a dozen rows.
    """
    whole = F.sum(measure).over(Window.partitionBy())
    return totals.withColumn("share", _ratio(F.col(measure), whole.cast("double")))


def category_mix(tables):
    by_category = (
        _sums(tables, "product_key")
        .join(tables["dim_product"], "product_key")
        .groupBy("category")
        .agg(F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity"))
    )
    return _with_share(by_category, "revenue").orderBy(F.desc("revenue"), "category")


def holiday_split(tables):
    label = flag_label(F.col("is_holiday"), "Holiday", "Non-Holiday").alias("holiday_flag")
    return _revenue_by(tables, "date_key", "dim_time", label, name="revenue").orderBy(
        "holiday_flag"
    )


def weekend_split(tables):
    label = flag_label(F.col("is_weekend"), "Weekend", "Weekday").alias("weekend_flag")
    return _revenue_by(tables, "date_key", "dim_time", label, name="revenue").orderBy(
        "weekend_flag"
    )


def month_name_revenue(tables):
    """Revenue per month name over all years, in calendar order."""
    return (
        _revenue_by(
            tables, "date_key", "dim_time", "month_number", "month_name", name="revenue"
        )
        .orderBy("month_number")
        .select("month_name", "revenue")
    )


def customers_by_age_group(tables):
    return (
        _buyers(tables)
        .where("age_group is not null")
        .groupBy("age_group")
        .agg(_rows().alias("customers"))
        .orderBy("age_group")
    )


def customers_by_gender(tables):
    by_gender = (
        _buyers(tables)
        .where("gender is not null")
        .groupBy("gender")
        .agg(_rows().alias("customers"))
    )
    return _with_share(by_gender, "customers").orderBy("gender")


def spend_by_age_and_gender(tables):
    """Customers are summed first, so each joins the dimension once."""
    return (
        _revenue_by(
            tables, "customer_key", "dim_customer", "age_group", "gender", name="spend"
        )
        .where("age_group is not null and gender is not null")
        .orderBy("age_group", "gender")
    )


def payment_mix(tables):
    by_method = _revenue_by(
        tables, "payment_key", "dim_payment", "payment_method", name="revenue"
    )
    return _with_share(by_method, "revenue").orderBy(F.desc("revenue"), "payment_method")


def mall_payment_revenue(tables):
    return (
        payments_by_mall(tables)
        .select("shopping_mall", "payment_method", F.col("total_revenue").alias("revenue"))
        .orderBy("shopping_mall", "payment_method")
    )


def mall_month_matrix(tables):
    """Revenue by mall (rows) and month name (columns); 0 where nothing was sold.

    The twelve columns are fixed, so no pass is spent on finding them.
    """
    return (
        _sums(tables, "store_key", "date_key")
        .join(tables["dim_time"].select("date_key", "month_name"), "date_key")
        .join(tables["dim_store"], "store_key")
        .groupBy("shopping_mall")
        .pivot("month_name", MONTHS)
        .agg(F.sum("revenue"))
        .na.fill(0, MONTHS)
        .orderBy("shopping_mall")
    )
