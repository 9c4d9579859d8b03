"""Rounding and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_binary(col, digits: int) -> Column:
    """Round half to even on the stored binary value of a double.

    Spark's round and bround work on the shortest decimal text of a double, so
    2.675 becomes 2.68 although the stored value lies below the tie. Here the
    double is split into two halves that multiply exactly by a power of ten;
    the sign of the exact distance to the tie decides.
    """
    scale = float(10**digits)
    c = F.abs(col.cast("double"))
    high = c * F.lit(134217729.0) - (c * F.lit(134217729.0) - c)
    low = c - high
    k = F.floor(c * F.lit(scale)).cast("double")
    gap = (high * F.lit(scale) - (k + F.lit(0.5))) + low * F.lit(scale)
    up = (gap > 0) | ((gap == 0) & (F.pmod(k, F.lit(2.0)) == 1.0))
    return F.signum(col.cast("double")) * (k + F.when(up, 1.0).otherwise(0.0)) / F.lit(scale)


def percent_half_even(part, total) -> Column:
    """Whole percent of part in total; exact ties go to the even number."""
    return F.bround(F.lit(100.0) * part / total).cast("bigint")


def share_of(flag) -> Column:
    """Mean of a condition over a group, NULLs skipped."""
    return F.avg(flag.cast("int"))


def percent_text(col) -> Column:
    """Share as whole-percent text, NULL stays NULL."""
    return F.concat(F.bround(col * 100).cast("bigint").cast("string"), F.lit("%"))
