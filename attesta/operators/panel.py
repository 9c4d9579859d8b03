"""Measures on an entity-year panel with score profiles over categories."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta.functions.quantiles import exact_quantiles

QUANTILES = [0.01, 0.10, 0.25, 0.50, 0.75, 0.90, 0.99]


def profile_metrics(
    profiles: DataFrame, keys: list[str], category: str = "category", score: str = "score"
) -> DataFrame:
    """Concentration of each profile: top score, top two, HHI, entropy,
    dominant category, and whether the profile is usable.

    A profile has one row per category, so a group is as small as the category
    list. Scores sum to 100; a category with score 0 adds nothing to entropy.
    """
    order = W.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(category))
    ranked = profiles.withColumn("rn", F.row_number().over(order)).withColumn(
        "s", F.col(score) / 100.0
    )
    return ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.sum(score).alias("total_score"),
        F.max(score).alias("dominant_score"),
        F.sum(F.when(F.col("rn") <= 2, F.col(score))).alias("top2_score"),
        F.sum(F.col("s") * F.col("s")).alias("hhi"),
        (-F.sum(F.when(F.col("s") > 0, F.col("s") * F.ln("s")).otherwise(0.0))).alias("entropy"),
        F.min(F.when(F.col("rn") == 1, F.col(category))).alias("dominant_category"),
    )


def _usable(tolerance: float):
    return (F.col("n_categories") >= 2) & (F.abs(F.col("total_score") / 100 - 1) <= tolerance)


def usable_profiles(metrics: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    return metrics.filter(_usable(tolerance))


def rejected_profiles(metrics: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    reason = F.when(F.col("n_categories") < 2, "fewer than two categories").otherwise(
        "scores do not sum to 100"
    )
    return metrics.filter(~_usable(tolerance)).withColumn("reason", reason)


def standardise_log(entities: DataFrame, value: str, name: str) -> DataFrame:
    """z-score of log(value) over all entities; zero variance is an error."""
    stats = entities.agg(
        F.struct(
            F.avg(F.ln(value)).alias("mean"), F.stddev_samp(F.ln(value)).alias("sd")
        ).alias("s")
    )
    with_stats = entities.withColumn("__s", stats.scalar())
    z = (F.ln(value) - F.col("__s.mean")) / F.col("__s.sd")
    checked = F.when(
        F.col("__s.sd") == 0, F.raise_error(F.lit(f"log({value}) has zero variance"))
    ).otherwise(z)
    return with_stats.withColumn(name, checked).drop("__s")


def panel_grid(entities: DataFrame, years: list[int]) -> DataFrame:
    """Every entity in every year of a given list."""
    return entities.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))


def ensure_observations(
    panel: DataFrame, entities: DataFrame, entity: str, fill_years: list[int], minimum: int = 2
) -> DataFrame:
    """Give entities with too few observations rows for the fill years and keep
    one row per entity-year, an observed one first.

    The panel carries the entity columns and a year.
    """
    sparse = panel.groupBy(entity).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < minimum)
    added = panel_grid(entities.join(sparse.select(entity), entity, "left_semi"), fill_years)
    both = panel.withColumn("__source", F.lit(0)).unionByName(
        added.withColumn("__source", F.lit(1)), allowMissingColumns=True
    )
    rest = [c for c in both.columns if c not in (entity, "year")]
    return (
        both.groupBy(entity, "year")
        .agg(F.min_by(F.struct(*rest), F.col("__source")).alias("r"))
        .select(entity, "year", *[F.col(f"r.{c}").alias(c) for c in rest if c != "__source"])
    )


def panel_summary(panel: DataFrame, entity: str, first: str, second: str) -> DataFrame:
    """Rows, entities, mean years per entity, means and correlation."""
    per_entity = panel.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    counts = per_entity.agg(
        F.struct(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_entities"),
            F.avg("n").alias("mean_years"),
        ).alias("c")
    )
    return (
        panel.agg(
            F.avg(first).alias(f"mean_{first}"),
            F.avg(second).alias(f"mean_{second}"),
            F.corr(first, second).alias("correlation"),
        )
        .withColumn("c", counts.scalar())
        .select("c.*", f"mean_{first}", f"mean_{second}", "correlation")
    )


def quantile_table(
    df: DataFrame, value: str, probs: list[float] = QUANTILES, approximate: bool = False
) -> DataFrame:
    """Quantiles (prob, quantile): exact and interpolated, or approximate."""
    if not approximate:
        return exact_quantiles(df, value, probs)
    found = df.agg(F.percentile_approx(value, probs, 10000).alias("q"))
    return found.select(
        F.inline(
            F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("q").alias("quantile"))
        )
    )


def six_numbers(df: DataFrame, value: str) -> DataFrame:
    """Minimum, quartiles, mean and maximum as rows (statistic, value)."""
    names = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    quantiles = exact_quantiles(df, value, list(names))
    label = F.element_at(
        F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("prob")
    )
    mean = df.agg(F.avg(value).alias("value")).select(F.lit("mean").alias("statistic"), "value")
    return quantiles.select(label.alias("statistic"), F.col("quantile").alias("value")).unionByName(
        mean
    )


def category_mix(panel: DataFrame, group: str, category: str) -> DataFrame:
    counts = panel.groupBy(group, category).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(group)))


def group_means(panel: DataFrame, groups: list[str], measures: list[str]) -> DataFrame:
    return panel.groupBy(*groups).agg(*[F.avg(m).alias(f"mean_{m}") for m in measures])


def sample_entities(panel: DataFrame, entity: str, n: int, seed: int) -> DataFrame:
    """All rows of n entities, drawn by a seeded hash so that reruns agree."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(entity).cast("string")))
    chosen = panel.select(entity).distinct().orderBy(draw, entity).limit(n)
    return panel.join(chosen, entity, "left_semi")


def histogram(df: DataFrame, value: str, bins: int = 35) -> DataFrame:
    """Equal-width bins with the minimum and the maximum at the centres of the
    first and the last bin; a value on an edge belongs to the lower bin."""
    data = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    span = data.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s"))
    spread = (F.col("s.hi") - F.col("s.lo")) / (bins - 1)
    width = F.when(spread == 0, F.lit(0.1)).otherwise(spread)
    bin_no = F.ceil((F.col("v") - F.col("s.lo")) / F.col("w") - 0.5)
    return (
        data.withColumn("s", span.scalar())
        .withColumn("w", width)
        .withColumn("bin", F.greatest(F.lit(0), F.least(F.lit(bins - 1), bin_no)))
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.first(F.col("s.lo")).alias("lo"),
            F.first("w").alias("w"),
        )
        .select(
            F.col("bin").cast("int").alias("bin"),
            (F.col("lo") + F.col("bin") * F.col("w")).alias("centre"),
            "n",
        )
    )


def indicator_columns(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """0/1 columns for all levels but the first."""
    return df.withColumns(
        {
            f"{column}_{i}": (F.col(column) == level).cast("double")
            for i, level in enumerate(levels)
            if i > 0
        }
    )


def variance_inflation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation factor per regressor.

    All correlations come from one aggregation; the factors are the diagonal
    of the inverse of that matrix, whose size is the number of regressors.
    """
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    sums = df.agg(
        F.array(
            *[
                F.lit(1.0) if i == j else F.corr(columns[i], columns[j])
                for i, j in pairs
            ]
        ).alias("c")
    )

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for flat in batch["c"]:
                matrix = np.eye(len(columns))
                for (i, j), value in zip(pairs, flat):
                    matrix[i, j] = matrix[j, i] = np.nan if value is None else value
                ok = np.isfinite(matrix).all() and np.linalg.matrix_rank(matrix) == len(columns)
                vif = np.diag(np.linalg.inv(matrix)) if ok else np.full(len(columns), np.nan)
                yield pd.DataFrame({"term": columns, "vif": vif})

    return sums.mapInPandas(invert, "term string, vif double")


def level_rank(column: str, levels: list[str]):
    """Position of a value in an ordered list of levels, from 1."""
    return F.array_position(F.array(*[F.lit(x) for x in levels]), F.col(column)).cast("int")
