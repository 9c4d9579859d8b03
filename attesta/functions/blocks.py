"""Running totals and lookups that stay balanced when one key is very large.

A window over a whole key puts all rows of that key into one task. The helpers
here cut a key into deterministic blocks, work inside the blocks, and combine
the (few) block totals. Nothing depends on how Spark happened to partition the
input, so a retried task gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_before(
    df: DataFrame, keys: list[str], block: Column, order: str, value: Column, name: str
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the same key.

    ``block`` must be non-decreasing in ``order``; ``order`` must be unique
    within a key.
    """
    b, v = f"__{name}_block", f"__{name}_value"
    base = df.withColumn(b, block).withColumn(v, value)
    totals = base.groupBy(*keys, b).agg(F.sum(v).alias("__total"))
    earlier = W.partitionBy(*keys).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        *keys, b, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__start")
    )
    inside = W.partitionBy(*keys, b).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (
        base.withColumn("__inside", F.coalesce(F.sum(v).over(inside), F.lit(0)))
        .join(starts, [*keys, b])
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop(b, v, "__inside", "__start")
    )


def attach_by_key(
    big: DataFrame, small: DataFrame, keys: list[str], spread: Column, salts: int = 32
) -> DataFrame:
    """Inner join of a skewed table with a table that has one row per key.

    The small side is repeated once per salt, the big side takes the salt from
    a hash of ``spread``, so one heavy key is shared by many tasks. Spark still
    broadcasts the small side when its size allows.
    """
    return _salted(big, small, keys, spread, salts, "inner")


def attach_by_key_left(
    big: DataFrame, small: DataFrame, keys: list[str], spread: Column, salts: int = 32
) -> DataFrame:
    return _salted(big, small, keys, spread, salts, "left")


def _salted(big, small, keys, spread, salts, how):
    salted_big = big.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    salted_small = small.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted_big.join(salted_small, [*keys, "__salt"], how).drop("__salt")


def first_n(
    df: DataFrame, keys: list[str], order: list[Column], n: int | None, rank: str
) -> DataFrame:
    """First n rows per key, or all of them. Spark limits each key to n rows before the
    shuffle."""
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked if n is None else ranked.filter(F.col(rank) <= n)
