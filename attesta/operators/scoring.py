"""Additive evidence score and strength label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.text import lookup


def stage_points() -> Column:
    return F.coalesce(lookup(F.col("implementation_stage"), k.STAGE_POINTS), F.lit(1))


def tag_points() -> Column:
    """Points of all tags; a tag listed twice counts twice.

    Occurrences are counted as the length lost by removing the tag, which
    needs no lambda.
    """
    tags = F.coalesce("evidence_tags", F.array().cast("array<string>"))
    total = F.lit(0)
    for tag, points in k.TAG_POINTS.items():
        total = total + (F.size(tags) - F.size(F.array_remove(tags, tag))) * points
    return total


def support_points() -> Column:
    return F.coalesce(F.col("quantitative_support").cast("int"), F.lit(0)) + F.coalesce(
        F.col("oversight_support").cast("int"), F.lit(0)
    )


def score_value() -> Column:
    return F.least(stage_points() + tag_points() + support_points(), F.lit(k.SCORE_CAP))


def strength_label(score) -> Column:
    """Label of a score from 1 up to the cap, read from a small table so that
    the score expression is used once."""
    labels = [
        "weak" if n <= k.WEAK_LIMIT else "moderate" if n <= k.MODERATE_LIMIT else "strong"
        for n in range(1, k.SCORE_CAP + 1)
    ]
    return F.get(F.array(*[F.lit(x) for x in labels]), score - 1)


def score(valid: DataFrame) -> DataFrame:
    """Add computed_score and computed_strength to valid records."""
    return valid.withColumn("computed_score", score_value()).withColumn(
        "computed_strength", strength_label(F.col("computed_score"))
    )


def strength_counts(scored: DataFrame, keys: list[str]) -> DataFrame:
    return scored.groupBy(*keys).agg(
        *[F.count_if(F.col("computed_strength") == s).alias(f"n_{s}") for s in k.STRENGTHS]
    )
