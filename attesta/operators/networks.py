"""Edge and node tables: goals with tags, goals with stages, goal pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.text import lookup


def _selected(df: DataFrame, years=None, periods=None) -> DataFrame:
    if years is not None:
        df = df.filter(F.col("report_year").isin(list(years)))
    if periods is not None:
        df = df.filter(F.col("period").isin(list(periods)))
    return df


def _edges(df: DataFrame, source: str, target: str, keys: list[str]) -> DataFrame:
    return df.groupBy(
        *keys, F.col(source).alias("source"), F.col(target).alias("target")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("computed_score").alias("avg_score"))


def goal_tag_edges(long: DataFrame, years=None, periods=None, keys: list[str] = ()) -> DataFrame:
    tagged = _selected(long, years, periods).withColumn("tag", F.explode("evidence_tags"))
    return _edges(tagged, "sdg", "tag", list(keys))


def goal_stage_edges(long: DataFrame, years=None, periods=None, keys: list[str] = ()) -> DataFrame:
    named = _selected(long, years, periods).withColumn(
        "stage_label", lookup(F.col("implementation_stage"), k.STAGE_NODE_LABELS)
    )
    return _edges(named, "sdg", "stage_label", list(keys))


def goal_pairs(
    wide: DataFrame, dedupe: bool = True, years=None, periods=None, keys: list[str] = ()
) -> DataFrame:
    """How often two goals are listed together, pairs in text order.

    Each record yields its distinct goals with their multiplicity; the pairs
    come from that short array, so neither a self-join nor a long list of
    repeats is formed. Without ``dedupe`` a goal listed twice pairs with itself
    and counts twice with the others.
    """
    goals = F.array_sort(F.array_distinct("candidate_sdgs"))

    def times(goal: Column) -> Column:
        if dedupe:
            return F.lit(1)
        return F.size("candidate_sdgs") - F.size(F.array_remove(F.col("candidate_sdgs"), goal))

    with_counts = (
        _selected(wide, years, periods)
        .filter(F.size("candidate_sdgs") > 1)
        .select(
            *keys,
            F.transform(
                goals, lambda g: F.struct(g.alias("goal"), times(g).alias("times"))
            ).alias("g"),
        )
    )
    cross = F.flatten(
        F.transform(
            "g",
            lambda a, i: F.transform(
                F.slice("g", i + 2, F.size("g")),
                lambda b: F.struct(
                    a["goal"].alias("source"),
                    b["goal"].alias("target"),
                    (a["times"] * b["times"]).alias("times"),
                ),
            ),
        )
    )
    loops = F.transform(
        F.filter("g", lambda a: a["times"] > 1),
        lambda a: F.struct(
            a["goal"].alias("source"),
            a["goal"].alias("target"),
            (a["times"] * (a["times"] - 1) / 2).cast("int").alias("times"),
        ),
    )
    pairs = cross if dedupe else F.concat(cross, loops)
    return (
        with_counts.select(*keys, F.inline(pairs))
        .groupBy(*keys, "source", "target")
        .agg(F.sum("times").cast("bigint").alias("n"))
    )


def bipartite_nodes(edges: DataFrame, source_type: str, target_type: str) -> DataFrame:
    sources = edges.select(F.col("source").alias("name"), F.lit(source_type).alias("node_type"))
    targets = edges.select(F.col("target").alias("name"), F.lit(target_type).alias("node_type"))
    return (
        sources.union(targets).distinct().withColumn("second_side", F.col("node_type") == target_type)
    )


def goal_nodes(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("source").alias("name")).union(edges.select("target")).distinct()
    return ends.select(
        "name",
        F.lit("SDG").alias("node_type"),
        F.regexp_substr("name", F.lit(r"\d+")).try_cast("int").alias("sdg_num"),
    )


def goal_tag_matrix(long: DataFrame, weight: str = "count", wide_form: bool = False) -> DataFrame:
    """Goal by tag weights: record count or mean score."""
    edges = goal_tag_edges(long)
    value = F.col("n").cast("double") if weight == "count" else F.col("avg_score")
    flat = edges.select(
        F.col("source").alias("sdg"), F.col("target").alias("tag"), value.alias("weight")
    )
    if not wide_form:
        return flat
    return flat.groupBy("sdg").pivot("tag", k.TAGS).agg(F.first("weight"))


def difference_edges(
    long: DataFrame, before: str, after: str, keys: list[str] = (), threshold: float = 0.5
) -> DataFrame:
    """Change of the mean score per goal and tag between two periods.

    Both means come from one grouping with conditional averages, which equals
    the full outer join of two groupings; a missing side counts as 0.
    """
    tagged = long.withColumn("tag", F.explode("evidence_tags"))
    means = tagged.filter(F.col("period").isin(before, after)).groupBy(*keys, "sdg", "tag").agg(
        *[
            F.coalesce(
                F.avg(F.when(F.col("period") == p, F.col("computed_score"))), F.lit(0.0)
            ).alias(name)
            for p, name in ((before, "score_before"), (after, "score_after"))
        ]
    )
    delta = F.col("score_after") - F.col("score_before")
    return (
        means.withColumn("delta", delta)
        .filter(F.abs("delta") > threshold)
        .withColumn(
            "direction", F.when(F.col("delta") >= 0, "Strengthened").otherwise("Weakened")
        )
    )
