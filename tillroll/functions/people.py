"""Customer attributes."""

from pyspark.sql import functions as F

from tillroll.schema import AGE_GROUPS


def age_group(age):
    """Label of the bucket holding an age; ``Unknown`` outside all of them."""
    whole = age.cast("int")
    label = F.when(F.lit(False), "")
    for low, high in AGE_GROUPS:
        label = label.when(whole.between(low, high), f"{low}-{high}")
    return label.otherwise("Unknown")
