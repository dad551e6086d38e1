"""Row rules: typed columns, broken rules, reports and the valid/rejected split."""

from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions.text import cell_choice, cell_date, cell_exact, cell_id
from tillroll.schema import (
    CATEGORIES,
    CLEAN_SCHEMA,
    DATE_FORMAT,
    GENDERS,
    MALLS,
    MAX_AGE,
    MIN_AGE,
    PAYMENT_METHODS,
    RULE_NAMES,
    SOURCE_COLUMNS,
)
from tillroll.sources.transactions import RAGGED, header_errors

# What the columns of the fact hold: INT and DECIMAL(10,2).
TOO_MANY = 2**31
# What rounds to more than 99999999.99, with the nine places it is kept by in between.
PRICE_TOO_HIGH = Decimal("99999999.9949999995")


def _fails(test):
    """True when a test is false or, for a missing value, unknown."""
    return ~F.coalesce(test, F.lit(False))


def _wrong_prefix(column, letter):
    """Only present values can have a wrong prefix."""
    return ~F.coalesce(column.startswith(letter), F.lit(True))


def row_rules():
    """``(rule name, condition that is true when broken)`` over the typed columns."""
    c = {name: F.col(f"_{name}") for name in SOURCE_COLUMNS}
    # Bounds hold for the numbers as they were written, not as they are kept: a quantity
    # of 1e-12 is one, though its amount comes to 0.00.
    broken = [
        c["invoice_no"].isNull(),
        _wrong_prefix(c["invoice_no"], "I"),
        c["customer_id"].isNull(),
        _wrong_prefix(c["customer_id"], "C"),
        _fails(c["gender"].isin(GENDERS)),
        _fails(c["age"].between(MIN_AGE, MAX_AGE)),
        _fails(c["category"].isin(CATEGORIES)),
        _fails((c["quantity"] > 0) & (c["quantity"] < TOO_MANY)),
        _fails((c["price"] > 0) & (c["price"] < F.lit(PRICE_TOO_HIGH))),
        _fails(c["payment_method"].isin(PAYMENT_METHODS)),
        c["invoice_date"].isNull(),
        _fails(c["shopping_mall"].isin(MALLS)),
    ]
    return list(zip(RULE_NAMES, broken))


def typed_columns(rows, date_format=DATE_FORMAT):
    """Add one typed column per source column, named with a leading underscore,
    and ``_row_id``, which rises in reading order.

    Numbers are read once, with 27 places; the rules look at them so, and the
    tables' columns are rounded from them. ``NaN``, infinities and what no column can
    hold break their rule.
    """
    readers = {
        "invoice_no": cell_id,
        "customer_id": cell_id,
        "gender": lambda c: cell_choice(c, GENDERS),
        "category": lambda c: cell_choice(c, CATEGORIES),
        "payment_method": lambda c: cell_choice(c, PAYMENT_METHODS),
        "shopping_mall": lambda c: cell_choice(c, MALLS),
        "age": cell_exact,
        "quantity": cell_exact,
        "price": cell_exact,
        "invoice_date": lambda c: cell_date(c, date_format),
    }
    columns = {f"_{c}": readers[c](c) for c in SOURCE_COLUMNS}
    return rows.withColumns({**columns, "_row_id": F.monotonically_increasing_id()})


def check_rows(rows, date_format=DATE_FORMAT):
    """Raw and typed columns plus ``_errors``, the broken rules joined by commas.

    A row whose line did not have ten cells has the error ``ragged_row`` before
    them; it is no rule of its own in the summary.
    """
    broken = [F.when(test, F.lit(name)) for name, test in row_rules()]
    if RAGGED in rows.columns:
        broken.insert(0, F.when(F.col(RAGGED), F.lit("ragged_row")))
    return typed_columns(rows, date_format).withColumn("_errors", F.concat_ws(",", *broken))


def clean_columns():
    """Typed columns under their source names; fractions of age are cut off."""
    return [
        # What a column cannot hold is NULL in a rejected row.
        F.col(f"_{f.name}").try_cast(f.dataType).alias(f.name)
        for f in CLEAN_SCHEMA.fields
    ]


def valid_rows(checked):
    """Typed rows that break no rule."""
    return checked.where("_errors = ''").select(clean_columns())


def rejected_rows(checked):
    """Rows as they came, with the rules they broke."""
    return checked.where("_errors <> ''").select(
        *SOURCE_COLUMNS, F.col("_errors").alias("errors")
    )


def _rule_counts():
    listed = F.split("_errors", ",")
    return [
        F.count_if(F.array_contains(listed, name)).alias(name) for name in RULE_NAMES
    ]


def error_summary(rows, date_format=DATE_FORMAT):
    """Rows ``(rule, broken_rows)``, one per rule; no rows for an empty input.

    A row that breaks several rules counts under each of them. All rules are
    evaluated in one pass and one partial aggregation.
    """
    counts = typed_columns(rows, date_format).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(broken).alias(name) for name, broken in row_rules()],
    )
    return (
        counts.where("total > 0")
        .unpivot(["total"], RULE_NAMES, "rule", "broken_rows")
        .drop("total")
    )


def validation_report(rows, date_format=DATE_FORMAT):
    """One row: total, valid and invalid rows and the invalid share in percent."""
    invalid = F.count_if(F.col("_errors") != "")
    total = F.count(F.lit(1))
    return check_rows(rows, date_format).agg(
        total.alias("total_rows"),
        (total - invalid).alias("valid_rows"),
        invalid.alias("invalid_rows"),
        F.when(total > 0, invalid * 100.0 / total).otherwise(0.0).alias("invalid_percent"),
    )


def report_of(checked):
    """The report of checked rows as a dict; ``error_summary`` is empty without rows."""
    found = checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_errors") != "").alias("invalid"),
        *_rule_counts(),
    ).first()
    return {
        "schema_valid": True,
        "total_rows": found.total,
        "valid_rows": found.total - found.invalid,
        "invalid_rows": found.invalid,
        "error_summary": {name: found[name] for name in RULE_NAMES} if found.total else {},
    }


def validate(rows, columns=None, date_format=DATE_FORMAT):
    """Header check, then row rules; a wrong header makes every row invalid.

    ``columns`` are the names found in the file, by default those of ``rows``.
    """
    if columns is None:
        columns = [c for c in rows.columns if c != RAGGED]
    errors = header_errors(columns)
    if errors:
        total = rows.count()
        return {
            "schema_valid": False,
            "total_rows": total,
            "valid_rows": 0,
            "invalid_rows": total,
            "error_summary": {"schema_errors": len(errors)},
        }
    return report_of(check_rows(rows, date_format))
