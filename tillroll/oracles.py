"""DuckDB SQL for the registered queries.

Written from the order tables up and apart from the Spark plans: every query
starts with the same feed and applies the row rules and lookups in SQL.
Decimals come out as doubles and dates as text, as in ``registry.plain``.
"""

from tillroll.functions.text import WHITE_SPACE
from tillroll.schema import (
    AGE_GROUPS,
    CATEGORIES,
    GENDERS,
    MALLS,
    MAX_AGE,
    MIN_AGE,
    MONTHS,
    NULL_TOKENS,
    PAYMENT_METHODS,
    RULE_NAMES,
    SEEDS,
    SOURCE_COLUMNS,
    TABLES,
    UNIQUE_KEYS,
)
from tillroll.registry import REPORT_CUSTOMER, REPORT_MALL, SAMPLE_SEED
from tillroll.sources.order_feed import HOLIDAY_MONTH_DAYS


def _listing(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _pick(values, number):
    return f"([{_listing(values)}])[{number} % {len(values)} + 1]"


_RAW_COLUMNS = ", ".join(SOURCE_COLUMNS)
_NULLED = ", ".join(f"nullif({c}, '') AS {c}" for c in SOURCE_COLUMNS)

FEED = f"""
cells AS (
  SELECT 'I' || l_orderkey AS invoice_no,
         'C' || o_custkey AS customer_id,
         CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST(CASE WHEN o_custkey % 97 = 0 THEN 10
                   WHEN o_custkey % 89 = 0 THEN 80
                   ELSE 18 + o_custkey % 52 END AS VARCHAR) AS age,
         {_pick(CATEGORIES, "l_partkey")} AS category,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS price,
         {_pick(PAYMENT_METHODS, "l_orderkey")} AS payment_method,
         strftime(o_orderdate, '%-d/%-m/%Y') AS invoice_date,
         strftime(o_orderdate, '%d/%m/%Y') AS padded_date,
         {_pick(MALLS, "l_suppkey")} AS shopping_mall,
         l_orderkey, l_linenumber, o_custkey,
         (l_orderkey * 7 + l_linenumber) % 101 AS fault
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
),
feed AS (
  SELECT CASE fault WHEN 0 THEN NULL WHEN 1 THEN 'X' || l_orderkey ELSE invoice_no END
           AS invoice_no,
         CASE fault WHEN 2 THEN NULL WHEN 3 THEN 'K' || o_custkey WHEN 16 THEN 'N/A'
              WHEN 17 THEN customer_id || chr(133) WHEN 18 THEN customer_id || chr(8232)
              WHEN 19 THEN customer_id || chr(10)
              ELSE customer_id END AS customer_id,
         CASE fault WHEN 4 THEN 'Unstated' WHEN 12 THEN '' WHEN 13 THEN '  ' || gender || ' '
              ELSE gender END AS gender,
         CASE fault WHEN 5 THEN '150' WHEN 20 THEN '120.00004' WHEN 21 THEN '0.99996'
              ELSE age END AS age,
         CASE fault WHEN 6 THEN 'Garden' WHEN 13 THEN '  ' || category || ' '
              ELSE category END AS category,
         CASE fault WHEN 7 THEN '0' WHEN 15 THEN quantity || '.5' WHEN 22 THEN '0.0000001'
              WHEN 23 THEN '3000000000' WHEN 25 THEN '2000000' ELSE quantity END AS quantity,
         CASE fault WHEN 8 THEN '-1.00' WHEN 12 THEN 'NaN' WHEN 24 THEN '99999999.999'
              WHEN 25 THEN '99999999.00' ELSE price END AS price,
         CASE fault WHEN 9 THEN 'Voucher' WHEN 13 THEN '  ' || payment_method || ' '
              ELSE payment_method END AS payment_method,
         CASE fault WHEN 10 THEN '31/02/1996' WHEN 14 THEN padded_date
              ELSE invoice_date END AS invoice_date,
         CASE fault WHEN 11 THEN 'Harbour Arcade' WHEN 13 THEN '  ' || shopping_mall || ' '
              ELSE shopping_mall END AS shopping_mall, l_orderkey, l_linenumber
  FROM cells
)"""


_WHITE = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def _exact(column):
    """The number as written, NULL unless it is a finite one."""
    return (
        f"CASE WHEN TRY_CAST({_cell(column)} AS DECIMAL(38,18)) IS NOT NULL "
        f"THEN TRY_CAST({_cell(column)} AS DOUBLE) END"
    )


def _cell(column):
    return (
        f"CASE WHEN {column} NOT IN ({_listing(NULL_TOKENS)}) "
        f"THEN trim({column}, {_WHITE}) END"
    )


_CONDITIONS = [
    "t_invoice_no IS NULL",
    "t_invoice_no IS NOT NULL AND left(t_invoice_no, 1) <> 'I'",
    "t_customer_id IS NULL",
    "t_customer_id IS NOT NULL AND left(t_customer_id, 1) <> 'C'",
    f"t_gender IS NULL OR t_gender NOT IN ({_listing(GENDERS)})",
    f"x_age IS NULL OR x_age < {MIN_AGE} OR x_age > {MAX_AGE}",
    f"t_category IS NULL OR t_category NOT IN ({_listing(CATEGORIES)})",
    "x_quantity IS NULL OR x_quantity <= 0 OR x_quantity >= 2147483648",
    "x_price IS NULL OR x_price <= 0 OR t_price IS NULL OR round(t_price, 2) > 99999999.99",
    f"t_payment_method IS NULL OR t_payment_method NOT IN ({_listing(PAYMENT_METHODS)})",
    "t_invoice_date IS NULL",
    f"t_shopping_mall IS NULL OR t_shopping_mall NOT IN ({_listing(MALLS)})",
]

_BROKEN = ", ".join(
    f"({condition}) AS {name}" for name, condition in zip(RULE_NAMES, _CONDITIONS)
)
_ERRORS = ", ".join(f"CASE WHEN {name} THEN '{name}' END" for name in RULE_NAMES)
_ANY = " OR ".join(RULE_NAMES)

RULES = f"""{FEED},
typed AS (
  SELECT *,
         {_cell("invoice_no")} AS t_invoice_no,
         {_cell("customer_id")} AS t_customer_id,
         {_cell("gender")} AS t_gender,
         {_exact("age")} AS x_age, {_exact("quantity")} AS x_quantity,
         {_exact("price")} AS x_price,
         {_cell("category")} AS t_category,
         TRY_CAST({_cell("quantity")} AS DECIMAL(20,9)) AS t_quantity,
         TRY_CAST({_cell("price")} AS DECIMAL(18,9)) AS t_price,
         {_cell("payment_method")} AS t_payment_method,
         CAST(try_strptime({_cell("invoice_date")}, '%d/%m/%Y') AS DATE) AS t_invoice_date,
         {_cell("shopping_mall")} AS t_shopping_mall
  FROM feed
),
checked AS (SELECT *, {_BROKEN} FROM typed),
clean AS (
  SELECT t_invoice_no AS invoice_no, t_customer_id AS customer_id, t_gender AS gender,
         CAST(trunc(x_age) AS INTEGER) AS age, t_category AS category,
         t_quantity AS quantity, t_price AS price, t_payment_method AS payment_method,
         t_invoice_date AS invoice_date, t_shopping_mall AS shopping_mall
  FROM checked WHERE NOT ({_ANY})
)"""

_HOLIDAYS = f"""
holidays AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || '-' || month_day AS date
  FROM orders, (SELECT unnest([{_listing(HOLIDAY_MONTH_DAYS)}]) AS month_day)
)"""

_AGE_GROUP = (
    "CASE "
    + " ".join(f"WHEN age BETWEEN {a} AND {b} THEN '{a}-{b}'" for a, b in AGE_GROUPS)
    + " ELSE 'Unknown' END"
)

STAR = f"""{RULES},{_HOLIDAYS},
days AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         dayname(d) AS day_name, isodow(d) AS day_of_week, weekofyear(d) AS week_number,
         month(d) AS month_number, monthname(d) AS month_name, quarter(d) AS quarter,
         year(d) AS year, isodow(d) >= 6 AS is_weekend,
         strftime(d, '%Y-%m-%d') IN (SELECT date FROM holidays) AS is_holiday,
         CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring'
              WHEN month(d) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season
  FROM (SELECT DISTINCT invoice_date AS d FROM clean)
),
people AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, *, {_AGE_GROUP} AS age_group
  FROM (
    SELECT customer_id, min(gender) AS gender, min(age) AS age,
           min(invoice_date) AS first_day, max(invoice_date) AS last_day, count(*) AS sales
    FROM clean GROUP BY customer_id
  )
),
sales AS (
  SELECT c.invoice_no, c.invoice_date AS full_date, d.date_key, d.year, d.month_number,
         d.month_name, d.quarter, d.day_name, d.season, d.is_weekend, d.is_holiday,
         p.customer_key, p.customer_id, p.gender, p.age, p.age_group,
         c.category, list_position([{_listing(CATEGORIES)}], c.category) AS product_key,
         c.shopping_mall, list_position([{_listing(MALLS)}], c.shopping_mall) AS store_key,
         c.payment_method,
         list_position([{_listing(PAYMENT_METHODS)}], c.payment_method) AS payment_key,
         CAST(trunc(c.quantity) AS INTEGER) AS quantity,
         CAST(c.price AS DECIMAL(10,2)) AS price,
         CAST(c.quantity * c.price AS DECIMAL(20,2)) AS total_amount
  FROM clean c
  JOIN days d ON d.full_date = c.invoice_date
  JOIN people p ON p.customer_id = c.customer_id
)"""

DAILY = f"""{STAR},
favourite_products AS (
  SELECT date_key, store_key, category,
         row_number() OVER (PARTITION BY date_key, store_key
                            ORDER BY sum(total_amount) DESC, product_key) AS place
  FROM sales GROUP BY date_key, store_key, product_key, category
),
favourite_payments AS (
  SELECT date_key, store_key, payment_method,
         row_number() OVER (PARTITION BY date_key, store_key
                            ORDER BY count(*) DESC, payment_key) AS place
  FROM sales GROUP BY date_key, store_key, payment_key, payment_method
),
totals AS (
  SELECT date_key, store_key, shopping_mall, full_date, sum(total_amount) AS revenue,
         CAST(sum(total_amount) * 100 AS HUGEINT) AS cents, count(*) AS n,
         count(DISTINCT customer_id) AS shoppers
  FROM sales GROUP BY date_key, store_key, shopping_mall, full_date
),
daily AS (
  SELECT t.date_key, t.store_key, t.shopping_mall, t.full_date,
         CAST(revenue AS DOUBLE) AS total_revenue, n AS total_transactions,
         CAST(CAST((2 * cents + n) // (2 * n) AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE)
           AS avg_transaction_value,
         shoppers AS unique_customers, p.category AS top_category,
         q.payment_method AS top_payment_method
  FROM totals t
  JOIN favourite_products p
    ON p.date_key = t.date_key AND p.store_key = t.store_key AND p.place = 1
  JOIN favourite_payments q
    ON q.date_key = t.date_key AND q.store_key = t.store_key AND q.place = 1
)"""

_DAILY_COLUMNS = (
    "total_revenue, total_transactions, avg_transaction_value, unique_customers, "
    "top_category, top_payment_method"
)

_SUM = "CAST(sum(total_amount) AS DOUBLE)"


def _with(ctes, select):
    return f"WITH {ctes}\n{select}"


def _seeded(table):
    key, natural, values = SEEDS[table]
    return (
        f"SELECT DISTINCT list_position([{_listing(values)}], {natural}) AS {key}, {natural} "
        "FROM clean"
    )


def _seed_sales(table, sold_key):
    _, _, values = SEEDS[table]
    return f"""
    SELECT '{table}' AS table_name, entry_key, ([{_listing(values)}])[entry_key] AS entry,
           (SELECT count(*) FROM sales WHERE {sold_key} = entry_key) AS sales
    FROM (SELECT unnest(range(1, {len(values) + 1})) AS entry_key)"""


_MATRIX = ", ".join(
    f"CAST(coalesce(sum(total_amount) FILTER (WHERE month_name = '{m}'), 0) AS DOUBLE) AS {m}"
    for m in MONTHS
)

_KEY_NAMES = ["date_key", "customer_key", "product_key", "store_key", "payment_key"]


def _duplicates():
    """Each key's repeats, counted on the relation that defines the table."""
    relations = {
        "dim_time": ("days", ["date_key"]),
        "dim_customer": ("people", ["customer_key", "customer_id"]),
        "dim_product": (f"({_seeded('dim_product')})", ["product_key", "category"]),
        "dim_store": (f"({_seeded('dim_store')})", ["store_key", "shopping_mall"]),
        "dim_payment": (f"({_seeded('dim_payment')})", ["payment_key", "payment_method"]),
        "fact_sales": ("(SELECT row_number() OVER () AS sale_id FROM sales)", ["sale_id"]),
        "fact_daily_summary": (
            "(SELECT row_number() OVER () AS summary_id, date_key, store_key FROM totals)",
            ["summary_id", "date_key,store_key"],
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{key}' AS unique_key, "
        f"(SELECT count(*) FROM (SELECT {key} FROM {rows} GROUP BY {key} HAVING count(*) > 1)) "
        "AS repeated_keys"
        for table, (rows, keys) in relations.items()
        for key in keys
    )


def oracle_sql():
    sql = {
        "clean_transactions": _with(
            RULES,
            """SELECT invoice_no, customer_id, gender, age, category,
            CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price, payment_method,
            CAST(invoice_date AS VARCHAR) AS invoice_date, shopping_mall FROM clean""",
        ),
        "rejected_rows": _with(
            RULES,
            f"SELECT {_RAW_COLUMNS}, concat_ws(',', {_ERRORS}) AS errors FROM checked WHERE {_ANY}",
        ),
        "error_summary": _with(
            RULES,
            " UNION ALL ".join(
                f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {name}) AS broken_rows "
                "FROM checked"
                for name in RULE_NAMES
            ),
        ),
        "validation_report": _with(
            RULES,
            f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT ({_ANY})) AS valid_rows,
            count(*) FILTER (WHERE {_ANY}) AS invalid_rows,
            CAST(count(*) FILTER (WHERE {_ANY}) * 100.0 / count(*) AS DOUBLE) AS invalid_percent
            FROM checked""",
        ),
        # An empty cell and a missing one look alike in a CSV file.
        "csv_transactions": _with(FEED, f"SELECT {_NULLED} FROM feed"),
        "file_profile": _with(
            FEED, "SELECT count(*) > 0 AS valid, count(*) AS rows, 10 AS columns, count(*) > 0 AS has_bytes FROM feed"
        ),
        "head_sample": _with(
            FEED, f"SELECT {_NULLED} FROM feed ORDER BY l_orderkey, l_linenumber LIMIT 100"
        ),
        "rejected_csv": _with(
            RULES,
            f"SELECT {_NULLED}, NULL AS line FROM checked WHERE {_ANY} UNION ALL SELECT "
            + ", ".join(["n_name"] * len(SOURCE_COLUMNS))
            + ", concat_ws(',', "
            + ", ".join(["n_name"] * 12)
            + ") FROM nation",
        ),
        "saved_holidays": _with(_HOLIDAYS, "SELECT date AS full_date FROM holidays"),
        "holiday_range": _with(
            _HOLIDAYS, "SELECT min(date) || ' to ' || max(date) AS date_range FROM holidays"
        ),
        "dim_time": _with(
            STAR,
            """SELECT date_key, CAST(full_date AS VARCHAR) AS full_date, day_name, day_of_week,
            week_number, month_number, month_name, quarter, year, is_weekend, is_holiday, season
            FROM days""",
        ),
        "dim_customer": _with(
            STAR,
            """SELECT customer_key, customer_id, gender, age, age_group,
            CAST(first_day AS VARCHAR) AS first_purchase_date,
            CAST(last_day AS VARCHAR) AS last_purchase_date, sales AS total_transactions
            FROM people""",
        ),
        "dim_product": _with(RULES, _seeded("dim_product")),
        "dim_store": _with(RULES, _seeded("dim_store")),
        "dim_payment": _with(RULES, _seeded("dim_payment")),
        "fact_sales": _with(
            STAR,
            """SELECT invoice_no, date_key, customer_key, product_key, store_key, payment_key,
            quantity, CAST(price AS DOUBLE) AS price, CAST(total_amount AS DOUBLE) AS total_amount,
            is_holiday, is_weekend FROM sales""",
        ),
        "fact_daily_summary": _with(
            DAILY, f"SELECT date_key, store_key, {_DAILY_COLUMNS} FROM daily"
        ),
        "sale_ids": _with(
            STAR,
            """SELECT count(*) AS row_count, count(*) AS different_ids, 1 AS lowest,
            count(*) AS highest FROM sales""",
        ),
        "assign_dense_keys": """
            SELECT 'C' || c_custkey AS customer_id,
                   row_number() OVER (
                     ORDER BY c_mktsegment <> 'BUILDING', 'C' || c_custkey) AS customer_key
            FROM customer""",
        "upsert_dim_customer": _with(
            RULES,
            f"""SELECT customer_id, gender, age, {_AGE_GROUP} AS age_group,
            CAST(first_day AS VARCHAR) AS first_purchase_date,
            CAST(last_day AS VARCHAR) AS last_purchase_date, sales AS total_transactions
            FROM (
              SELECT customer_id, min(gender) AS gender, min(age) AS age,
                     min(invoice_date) AS first_day, max(invoice_date) AS last_day,
                     count(*) AS sales,
                     row_number() OVER (PARTITION BY customer_id
                                        ORDER BY year(min(invoice_date)) >= 1998 DESC) AS place
              FROM clean GROUP BY customer_id, year(invoice_date) >= 1998
            ) WHERE place = 1""",
        ),
        "seed_dims": _with(
            STAR,
            " UNION ALL ".join(
                [
                    _seed_sales("dim_product", "product_key"),
                    _seed_sales("dim_store", "store_key"),
                    _seed_sales("dim_payment", "payment_key"),
                ]
            ),
        ),
        "q01_revenue_by_mall": _with(
            STAR, f"SELECT shopping_mall, {_SUM} AS total_revenue FROM sales GROUP BY 1"
        ),
        "q02_top_categories": _with(
            STAR,
            f"""SELECT category, {_SUM} AS total_revenue FROM sales GROUP BY category
            ORDER BY total_revenue DESC, category LIMIT 5""",
        ),
        "q03_monthly_trend": _with(
            STAR,
            f"""SELECT year, month_number AS month, {_SUM} AS total_revenue
            FROM sales GROUP BY ALL""",
        ),
        "q04_holiday_average": _with(
            STAR,
            f"""SELECT is_holiday, {_SUM} / count(*) AS avg_transaction_value
            FROM sales GROUP BY ALL""",
        ),
        "q05_customers_by_age_gender": _with(
            STAR,
            """SELECT age_group, gender, count(DISTINCT customer_key) AS customer_count
            FROM sales GROUP BY ALL""",
        ),
        "q06_payments_by_mall": _with(
            STAR,
            f"""SELECT shopping_mall, payment_method, count(*) AS transaction_count,
            {_SUM} AS total_revenue FROM sales GROUP BY ALL""",
        ),
        "q07_weekend_revenue": _with(
            STAR, f"SELECT is_weekend, {_SUM} AS total_revenue FROM sales GROUP BY ALL"
        ),
        "q08_seasonal_revenue": _with(
            STAR, f"SELECT season, {_SUM} AS total_revenue FROM sales GROUP BY ALL"
        ),
        "q09_top_customers": _with(
            STAR,
            f"""SELECT customer_id, age_group, gender, {_SUM} AS total_spent
            FROM sales GROUP BY ALL ORDER BY total_spent DESC, customer_id LIMIT 10""",
        ),
        "q10_daily_summary_for_mall": _with(
            DAILY,
            f"""SELECT CAST(full_date AS VARCHAR) AS full_date, shopping_mall, {_DAILY_COLUMNS}
            FROM daily WHERE shopping_mall = '{REPORT_MALL}'""",
        ),
        "sales_base": _with(
            STAR,
            """SELECT invoice_no, CAST(full_date AS VARCHAR) AS full_date, year, month_name,
            day_name, is_weekend, is_holiday, customer_id, gender, age, age_group, category,
            shopping_mall, payment_method, quantity, CAST(price AS DOUBLE) AS price,
            CAST(total_amount AS DOUBLE) AS total_amount FROM sales""",
        ),
        "kpi_overview": _with(
            STAR,
            f"""SELECT {_SUM} AS total_revenue, count(DISTINCT invoice_no) AS transactions,
            count(DISTINCT customer_id) AS unique_customers,
            {_SUM} / count(DISTINCT invoice_no) AS avg_order_value FROM sales""",
        ),
        "monthly_revenue": _with(
            STAR,
            f"SELECT strftime(full_date, '%Y-%m') AS month, {_SUM} AS revenue FROM sales GROUP BY 1",
        ),
        "mall_metrics": _with(
            STAR,
            f"""SELECT shopping_mall, {_SUM} AS revenue,
            count(DISTINCT invoice_no) AS transactions, count(DISTINCT customer_id) AS customers,
            {_SUM} / count(*) AS avg_basket FROM sales GROUP BY 1""",
        ),
        "mall_detail": _with(
            STAR,
            f"""SELECT shopping_mall, {_SUM} AS revenue,
            count(DISTINCT invoice_no) AS transactions,
            count(DISTINCT customer_id) AS unique_customers,
            CAST(sum(quantity) AS BIGINT) AS total_quantity,
            {_SUM} / count(*) AS avg_transaction_value
            FROM sales WHERE shopping_mall = '{REPORT_MALL}' GROUP BY 1""",
        ),
        "mall_list": _with(RULES, "SELECT DISTINCT shopping_mall FROM clean"),
        "category_mix": _with(
            STAR,
            f"""SELECT category, {_SUM} AS revenue, CAST(sum(quantity) AS BIGINT) AS quantity,
            {_SUM} / (SELECT {_SUM} FROM sales) AS share FROM sales GROUP BY 1""",
        ),
        "quarterly_revenue": _with(
            STAR,
            f"SELECT year || 'Q' || quarter AS quarter, {_SUM} AS revenue FROM sales "
            "GROUP BY year, sales.quarter",
        ),
        "holiday_split": _with(
            STAR,
            f"""SELECT CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-Holiday' END AS holiday_flag,
            {_SUM} AS revenue FROM sales GROUP BY 1""",
        ),
        "weekend_split": _with(
            STAR,
            f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS weekend_flag,
            {_SUM} AS revenue FROM sales GROUP BY 1""",
        ),
        "month_name_revenue": _with(
            STAR, f"SELECT month_name, {_SUM} AS revenue FROM sales GROUP BY 1"
        ),
        "customers_by_age_group": _with(
            STAR, "SELECT age_group, count(DISTINCT customer_id) AS customers FROM sales GROUP BY 1"
        ),
        "customers_by_gender": _with(
            STAR,
            """SELECT gender, count(DISTINCT customer_id) AS customers,
            CAST(count(DISTINCT customer_id) AS DOUBLE) / (SELECT count(*) FROM people) AS share
            FROM sales GROUP BY 1""",
        ),
        "spend_age_gender": _with(
            STAR, f"SELECT age_group, gender, {_SUM} AS spend FROM sales GROUP BY ALL"
        ),
        "payment_mix": _with(
            STAR,
            f"""SELECT payment_method, {_SUM} AS revenue,
            {_SUM} / (SELECT {_SUM} FROM sales) AS share FROM sales GROUP BY 1""",
        ),
        "mall_payment_revenue": _with(
            STAR, f"SELECT shopping_mall, payment_method, {_SUM} AS revenue FROM sales GROUP BY ALL"
        ),
        "mall_month_matrix": _with(
            STAR, f"SELECT shopping_mall, {_MATRIX} FROM sales GROUP BY shopping_mall"
        ),
        "fk_orphans": _with(
            STAR,
            " UNION ALL ".join(
                f"SELECT '{key}' AS foreign_key, count(*) FILTER (WHERE {key} IS NULL) AS orphans "
                "FROM sales"
                for key in _KEY_NAMES
            ),
        ),
        "null_keys": _with(
            STAR,
            "SELECT count(*) FILTER (WHERE "
            + " OR ".join(f"{key} IS NULL" for key in _KEY_NAMES)
            + ") AS null_key_rows FROM sales",
        ),
        "amount_mismatch": _with(
            STAR,
            """SELECT count(*) FILTER (WHERE abs(total_amount - quantity * price) > 0.01)
            AS mismatched_rows FROM sales""",
        ),
        "duplicate_keys": _with(DAILY, _duplicates()),
        "table_counts": _with(
            DAILY,
            " UNION ALL ".join(
                f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {rows}"
                for table, rows in [
                    ("dim_time", "days"),
                    ("dim_customer", "people"),
                    ("dim_product", f"({_seeded('dim_product')})"),
                    ("dim_store", f"({_seeded('dim_store')})"),
                    ("dim_payment", f"({_seeded('dim_payment')})"),
                    ("fact_sales", "sales"),
                    ("fact_daily_summary", "totals"),
                ]
            ),
        ),
        "dim_counts": _with(
            RULES,
            " UNION ALL ".join(
                f"SELECT '{table}' AS table_name, count(*) AS row_count, "
                f"{len(values)} AS expected_count FROM ({_seeded(table)})"
                for table, (_, _, values) in SEEDS.items()
            ),
        ),
        "holiday_days": _with(
            STAR, "SELECT count(*) FILTER (WHERE is_holiday) AS holiday_days FROM days"
        ),
        "fact_count_within": _with(
            RULES,
            """SELECT count(*) AS row_count, count(*) BETWEEN 94000 AND 100000 AS within
            FROM clean""",
        ),
    }
    for name in ("stream_two_sources", "run_growing_folder", "run_counts", "reload_replaces"):
        sql[name] = sql["table_counts"]
    sql["stream_with_bad_file"] = _with(
        STAR, f"SELECT count(*) AS sales, {_SUM} AS revenue FROM sales"
    )
    sql["header_report"] = _with(
        FEED,
        "SELECT true AS in_order, count(*) AS rows FROM feed "
        "UNION ALL SELECT false, count(*) FROM nation",
    )
    sql["holiday_files"] = _with(_HOLIDAYS, "SELECT date FROM holidays")
    sql["sql_over_tables"] = _with(
        STAR,
        f"SELECT year, shopping_mall, {_SUM} AS revenue FROM sales WHERE is_holiday GROUP BY ALL",
    )
    widths = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {len(declared)} AS columns"
        for table, declared in TABLES.items()
    )
    sql["table_shapes"] = (
        "SELECT table_name, columns, true AS in_order, true AS is_there, row_count "
        f"FROM ({widths}) JOIN ({sql['table_counts']}) USING (table_name)"
    )
    lot = (
        f"substr(md5(concat_ws('|', '{SAMPLE_SEED}', invoice_no, date_key, customer_key, product_key, "
        "store_key, payment_key, quantity, price, total_amount)), 1, 15)"
    )
    sql["sampled_amounts"] = _with(
        STAR,
        f"""SELECT count(*) AS drawn,
        count(*) FILTER (WHERE abs(total_amount - quantity * price) > 0.01) AS mismatched_rows
        FROM (SELECT * FROM sales ORDER BY {lot} LIMIT 100)""",
    )
    sql["delivered_daily"] = sql["fact_daily_summary"]
    sql["reload_customers"] = sql["dim_customer"].replace("SELECT customer_key, ", "SELECT ")
    sql["customer_history"] = _with(
        STAR,
        f"""SELECT invoice_no, date_key, customer_key, product_key, store_key, payment_key,
        quantity, CAST(price AS DOUBLE) AS price, CAST(total_amount AS DOUBLE) AS total_amount,
        is_holiday, is_weekend FROM sales WHERE customer_id = '{REPORT_CUSTOMER}'""",
    )
    sql["sql_after_load"] = _with(
        STAR,
        f"""SELECT 0 AS loads, 0 AS sales, CAST(NULL AS DOUBLE) AS revenue
        UNION ALL SELECT 1, count(*), {_SUM} FROM sales""",
    )
    sql["empty_delivery"] = (
        "SELECT 0 AS total_rows, 0 AS valid_rows, 0 AS invalid_rows, CAST(0 AS DOUBLE) AS invalid_percent, "
        "0 AS rules_listed, true AS summary_is_empty FROM (SELECT count(*) FROM lineitem)"
    )
    faults_found = " + ".join(f"count(*) FILTER (WHERE {name})" for name in RULE_NAMES)
    sql["validated"] = _with(
        RULES,
        f"""SELECT 'in order' AS delivery, true AS schema_valid, count(*) AS total_rows,
        count(*) FILTER (WHERE NOT ({_ANY})) AS valid_rows,
        count(*) FILTER (WHERE {_ANY}) AS invalid_rows, {faults_found} AS faults FROM checked
        UNION ALL SELECT 'price missing', false, count(*), 0, count(*), 2 FROM feed""",
    )
    sql["dropped_tables"] = f"""
        SELECT 'loaded' AS state, table_name, true AS is_there, row_count FROM ({sql["table_counts"]})
        UNION ALL SELECT 'dropped', table_name, false, 0 FROM ({widths})
        UNION ALL SELECT 'new', table_name, true, CASE table_name {" ".join(
            f"WHEN '{table}' THEN {len(values)}" for table, (_, _, values) in SEEDS.items()
        )} ELSE 0 END FROM ({widths})"""
    sql["dimension_sizes"] = (
        f"SELECT table_name, row_count FROM ({sql['table_counts']}) WHERE table_name LIKE 'dim%'"
    )
    sql["unmatched_sales"] = _with(STAR, "SELECT count(*) AS unmatched FROM sales WHERE age < 30")
    faults = {"customer_key": 1, "product_key": 2}
    sql["spoiled_orphans"] = _with(
        STAR,
        " UNION ALL ".join(
            f"SELECT '{key}' AS foreign_key, "
            f"count(*) FILTER (WHERE quantity % 10 = {faults.get(key, 'NULL')}) AS orphans FROM sales"
            for key in _KEY_NAMES
        ),
    )
    sql["spoiled_null_keys"] = _with(
        STAR, "SELECT count(*) AS null_key_rows FROM sales WHERE quantity % 10 = 2"
    )
    sql["spoiled_duplicates"] = _with(
        DAILY,
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS unique_key, "
            f"(SELECT count(*) FROM {repeated.get(table, 'sales WHERE false')}) AS repeated_keys"
            for table, choices in UNIQUE_KEYS.items()
            for keys in choices
            for repeated in [
                {
                    "fact_sales": "sales WHERE quantity % 10 = 3",
                    "dim_customer": "people WHERE age = 30",
                }
            ]
        ),
    )
    sql["stream_ingest_daily"] = sql["fact_daily_summary"]
    sql["stream_ingest_customers"] = sql["dim_customer"].replace("SELECT customer_key, ", "SELECT ")
    return sql
