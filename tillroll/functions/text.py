"""Cell text: null tokens, trimming and strict number and date reading."""

from pyspark.sql import functions as F

from tillroll.schema import NULL_TOKENS

# Everything Unicode calls white space, so padded cells trim the same way
# whatever tool exported them.
WHITE_SPACE = "".join(
    chr(code)
    for code in [
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)

# Numbers as they are written: eleven digits before the point, twenty-seven behind.
EXACT_TYPE = "decimal(38,27)"


def cell_text(column):
    """The trimmed text of a CSV cell; NULL when the cell holds a null token.

    Tokens are matched before trimming, so a cell of blanks is an empty text
    and not a missing one.
    """
    cell = F.col(column)
    return F.when(~cell.isin(NULL_TOKENS), F.btrim(cell, F.lit(WHITE_SPACE)))


# The readers below try the cell as it stands first. Nearly every cell is in
# order, and no null token is a number, a date or a listed value, so token
# matching and trimming by all of Unicode's white space, which is slow, are left
# to the few cells that need them.


def cell_id(column):
    """The cell's text, known at once when it is a letter and then digits."""
    cell = F.col(column)
    return F.when(cell.rlike(r"^[A-Z][0-9]+\z"), cell).otherwise(cell_text(column))


def cell_choice(column, values):
    """The cell's text, known at once when it is one of the listed values."""
    cell = F.col(column)
    return F.when(cell.isin(values), cell).otherwise(cell_text(column))


def cell_exact(column):
    """The cell as a decimal of 27 places; NULL when it is no finite number that fits."""
    return F.coalesce(
        F.col(column).try_cast(EXACT_TYPE), cell_text(column).try_cast(EXACT_TYPE)
    )


def cell_date(column, date_format):
    """The cell as a date in one strict format; NULL when it does not match."""
    return F.coalesce(
        F.try_to_date(F.col(column), date_format),
        F.try_to_date(cell_text(column), date_format),
    )
