"""Measures kept up to date by new runs: sums and sketches per company and year.

A stored table has one row per company and year with sums that can be added and a
quantile sketch that can be merged. New runs are summed by themselves and replace
only the years that they hold; every measure is then made from the stored rows, so
earlier records are not read again. Repeating a run changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("company", "report_year")
STORED = (
    "company string, n bigint, sum_x double, sum_y double, sum_xx double, sum_xy double, sum_yy double,"
    " sketch binary, report_year int"
)


def year_sums(records: DataFrame, x: str = "confidence", y: str = "computed_score", size: int = 1024) -> DataFrame:
    """Sums of x, y and their products, and a sketch of y, per company and year.

    Rows without x or y are left out. ``size`` is the sketch's parameter: the rank of a
    quantile is off by about 2.3 / size of all rows, at 99 % confidence.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = records.filter(a.isNotNull() & b.isNotNull())
    return both.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(a).alias("sum_x"),
        F.sum(b).alias("sum_y"),
        F.sum(a * a).alias("sum_xx"),
        F.sum(a * b).alias("sum_xy"),
        F.sum(b * b).alias("sum_yy"),
        F.kll_sketch_agg_double(b, F.lit(size)).alias("sketch"),
    )


def store_years(sums: DataFrame, path: str) -> None:
    """Write sums by year; only the years in ``sums`` are replaced."""
    (
        sums.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_year")
        .parquet(path)
    )


def stored_years(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; none if nothing has been summed yet."""
    return spark.read.schema(STORED).parquet(path)


def fit_from_sums(sums: DataFrame, keys: Sequence[str] = ("company",)) -> DataFrame:
    """Linear fit of y on x per key, the measures of a fit over all records."""
    total = sums.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n", "sum_x", "sum_y", "sum_xx", "sum_xy", "sum_yy")]
    )
    n, mean_x, mean_y = F.col("n"), F.col("sum_x") / F.col("n"), F.col("sum_y") / F.col("n")
    centred = total.select(
        *keys, "n", mean_x.alias("mean_x"), mean_y.alias("mean_y"),
        (F.col("sum_xx") - F.col("sum_x") * mean_x).alias("sxx"),
        (F.col("sum_xy") - F.col("sum_x") * mean_y).alias("sxy"),
        (F.col("sum_yy") - F.col("sum_y") * mean_y).alias("syy"),
    )
    slope = F.try_divide("sxy", "sxx")
    correlation = F.try_divide("sxy", F.sqrt(F.col("sxx") * F.col("syy")))
    left = F.greatest(F.col("syy") - slope * F.col("sxy"), F.lit(0.0))
    return centred.select(
        *keys, "n", slope.alias("slope"), (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"),
        correlation.alias("correlation"), (correlation * correlation).alias("r2"),
        F.sqrt(F.try_divide(left, n - 2)).alias("residual_se"),
    )


def quantiles_from_sketches(
    sums: DataFrame, probs: Sequence[float], keys: Sequence[str] = ("company",), size: int = 1024
) -> DataFrame:
    """(keys, prob, quantile) from merged sketches, within the sketch's rank error."""
    merged = sums.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))
    each = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile"))
        for p in probs
    ])
    return merged.select(*keys, F.inline(each))


def rank_error(values: DataFrame, quantiles: DataFrame, value: str, keys: Sequence[str] = ("company",)) -> DataFrame:
    """(keys, prob, n, error): how far each quantile's rank is from its probability.
    Equal values are counted before they meet the quantiles."""
    counted = values.groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("m"))
    met = counted.join(quantiles, list(keys))

    def rows_where(condition):
        return F.sum(F.when(condition, F.col("m")).otherwise(0))

    ranks = met.groupBy(*keys, "prob").agg(
        F.sum("m").alias("n"), rows_where(F.col("v") < F.col("quantile")).alias("below"),
        rows_where(F.col("v") <= F.col("quantile")).alias("upto"),
    )
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    error = F.greatest(low - F.col("prob"), F.col("prob") - high, F.lit(0.0))
    return ranks.select(*keys, "prob", "n", error.alias("error"))
