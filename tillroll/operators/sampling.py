"""Random samples of a fixed number of rows, without sorting the table."""

import math

from pyspark.sql import functions as F

# Hash values lie below this: fifteen hexadecimal digits.
_RANGE = 16**15


def random_rows(rows, n, keys, seed=0):
    """``n`` random rows, all if there are fewer; the same for the same seed and rows.

    A row's lot is a hash of its ``keys``. Only rows with a lot below (n + margin) / N are
    looked at, with a margin of six standard deviations, and the ``n`` least of them
    are drawn; should they be too few, the threshold is doubled. So one pass over
    the keys leaves about ``n`` rows, and no task ever sorts more. Rows with equal keys
    have one lot: name a unique key for independent draws.
    """
    total = rows.count()
    text = [F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *text))
    lots = rows.withColumn("_lot", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    share = (n + 6 * math.sqrt(n) + 20) / max(total, 1)
    while share < 1:
        low = lots.where(F.col("_lot") < int(share * _RANGE))
        # At most n rows are counted.
        if low.limit(n).count() == n:
            lots = low
            break
        share *= 2
    return lots.orderBy("_lot", *keys).limit(n).drop("_lot")
