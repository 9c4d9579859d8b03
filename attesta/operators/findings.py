"""Findings per goal and per report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from attesta import constants as k
from attesta.functions.blocks import first_n
from attesta.functions.numbers import percent_half_even, round_binary
from attesta.functions.text import lookup, strip
from attesta.params import FindingsParams
from attesta.staging import staged

REPORT = ["company", "report_year"]
POSITIONS = 1 << 31  # more than the entries that a list can have


def record_order(records: DataFrame, order: list[str] | None = None) -> list[str]:
    """Columns that order ties: as given, else the order of extraction (``seq``),
    else the id for records without one."""
    if order is not None:
        return list(order)
    return ["seq"] if "seq" in records.columns else ["evidence_id"]


def _first_seen(listed: DataFrame, order: list[str]) -> Column:
    """Place of the first appearance of a list entry. With one whole-number order
    column it is one number, so the grouping can hash instead of sort; a decimal holds
    any order number and any position."""
    if len(order) == 1 and isinstance(listed.schema[order[0]].dataType, IntegralType):
        number = F.col(order[0]).cast("decimal(20,0)") * F.lit(POSITIONS).cast("decimal(10,0)")
        return F.min(number + F.col("pos").cast("decimal(10,0)"))
    return F.min(F.struct(*order, "pos"))


def stage_rank(stage="implementation_stage") -> Column:
    """1 to 4 by maturity, NULL for anything else."""
    return lookup(F.col(stage), {s: i for i, s in enumerate(k.STAGES, 1)})


def strength_rank(strength="computed_strength") -> Column:
    return lookup(F.col(strength), {s: i for i, s in enumerate(k.STRENGTHS, 1)})


def goal_number(goal="sdg") -> Column:
    """Number in a goal id for sorting, 99 when there is none."""
    return F.coalesce(
        strip(F.replace(F.col(goal), F.lit("SDG"), F.lit(""))).try_cast("int"), F.lit(99)
    )


def by_goal(scored: DataFrame) -> DataFrame:
    """One row per record and listed goal; a goal listed twice gives two rows."""
    return scored.withColumn("sdg", F.explode("candidate_sdgs"))


def _stage_name(rank) -> Column:
    return lookup(rank, dict(enumerate(k.STAGES, 1)), F.lit(k.MENTION))


def goal_measures(scored: DataFrame, keys: list[str] = REPORT) -> DataFrame:
    """Count, mean score, most advanced stage and its share, in one aggregation."""
    ranked = by_goal(scored).withColumn("rank", stage_rank())
    counts = ranked.groupBy(*keys, "sdg").agg(
        F.count(F.lit(1)).alias("evidence_count"),
        F.sum("computed_score").alias("score_sum"),
        F.avg("computed_score").alias("mean_score"),
        F.max("rank").alias("top_rank"),
        *[F.count_if(F.col("rank") == i).alias(f"n_stage_{i}") for i in range(1, 5)],
    )
    at_top = (
        F.when(F.col("top_rank") == 4, F.col("n_stage_4"))
        .when(F.col("top_rank") == 3, F.col("n_stage_3"))
        .when(F.col("top_rank") == 2, F.col("n_stage_2"))
        .otherwise(F.col("n_stage_1"))
    )
    label = lookup(F.col("dominant_stage"), k.PROFILE_LABELS)
    return (
        counts.withColumn("dominant_stage", _stage_name(F.col("top_rank")))
        .withColumn("percent_at_stage", percent_half_even(at_top, F.col("evidence_count")))
        .withColumn(
            "implementation_profile",
            F.coalesce(
                F.concat(
                    label,
                    F.lit(" ("),
                    F.col("percent_at_stage").cast("string"),
                    F.lit("% of items)"),
                ),
                F.lit("mentions_only"),
            ),
        )
        .withColumn("average_score", round_binary(F.col("mean_score"), 2))
    )


def key_pages(
    scored: DataFrame,
    keys: list[str] = REPORT,
    order: list[str] | None = None,
    params: FindingsParams = FindingsParams(),
) -> DataFrame:
    """Pages of the best records per goal, best first, each once, and in ``n_pages``
    how many different pages the records of the goal have."""
    order = record_order(scored, order)
    group = [*keys, "sdg"]
    listed = by_goal(scored).select(*group, "computed_score", "page_number", *order)
    paged = listed.filter(F.col("page_number") != 0).select(*group, "page_number").distinct()
    totals = paged.groupBy(*group).agg(F.count(F.lit(1)).alias("n_pages"))
    best = first_n(
        listed,
        group,
        [F.col("computed_score").desc(), *[F.col(c) for c in order]],
        params.key_page_items,
        "rn",
    )
    pages = F.transform(
        F.array_sort(F.collect_list(F.struct("rn", "page_number"))), lambda s: s["page_number"]
    )
    first = best.groupBy(*group).agg(
        F.filter(F.array_distinct(pages), lambda p: p.isNotNull() & (p != 0)).alias(
            "strongest_pages"
        )
    )
    return first.join(totals, group, "left").withColumn("n_pages", F.coalesce("n_pages", F.lit(0)))


def top_tags(
    scored: DataFrame,
    keys: list[str] = REPORT,
    order: list[str] | None = None,
    params: FindingsParams = FindingsParams(),
) -> DataFrame:
    """Most frequent tags per goal, ties by first appearance, and in ``n_tags`` how many
    different tags the goal has."""
    order = record_order(scored, order)
    group = [*keys, "sdg"]
    tagged = by_goal(scored).select(
        *group, *order, F.posexplode("evidence_tags").alias("pos", "tag")
    )
    counted = tagged.groupBy(*group, "tag").agg(
        F.count(F.lit(1)).alias("n"), _first_seen(tagged, order).alias("first_seen")
    )
    best = first_n(counted, group, [F.col("n").desc(), F.col("first_seen")], params.top_tags, "rn")
    totals = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("n_tags"))
    return best.groupBy(*group).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rn", "tag"))), lambda s: s["tag"]
        ).alias("top_tags")
    ).join(totals, group)


def _score_text() -> Column:
    """Mean to two decimals; a mean that is a whole number shows no decimals."""
    whole = F.col("score_sum") % F.col("evidence_count") == 0
    return F.when(
        whole, (F.col("score_sum") / F.col("evidence_count")).cast("bigint").cast("string")
    ).otherwise(F.col("average_score").cast("string"))


def goal_summaries(
    scored: DataFrame,
    keys: list[str] = REPORT,
    order: list[str] | None = None,
    params: FindingsParams = FindingsParams(),
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Complete summary per report and goal, with the summary sentence.

    Measures, pages and tags each read the records, so the columns they need are stored
    once; records that are stored already can pass a ``stage`` that does nothing.
    """
    order = record_order(scored, order)
    group = [*keys, "sdg"]
    needed = [
        *keys, *order, "candidate_sdgs", "computed_score", "implementation_stage", "page_number",
        "evidence_tags",
    ]
    scored = stage(scored.select(*dict.fromkeys(needed)))
    joined = (
        goal_measures(scored, keys)
        .join(key_pages(scored, keys, order, params), group, "left")
        .join(top_tags(scored, keys, order, params), group, "left")
    )
    sentence = F.concat_ws(
        " ",
        F.concat(F.col("evidence_count").cast("string"), F.lit(" evidence item(s) found.")),
        F.concat(
            F.lit("Dominant stage: "),
            F.replace(F.col("dominant_stage"), F.lit("_"), F.lit(" ")),
            F.lit("."),
        ),
        F.concat(F.lit("Average score: "), _score_text(), F.lit("/10.")),
        F.when(
            F.size("top_tags") > 0,
            F.concat(
                F.lit("Key evidence types: "), F.array_join("top_tags", ", "), F.lit(".")
            ),
        ),
    )
    return joined.select(
        *group,
        goal_number().alias("sdg_num"),
        "evidence_count",
        "average_score",
        "strongest_pages",
        "implementation_profile",
        sentence.alias("summary"),
    )


def overall_assessment(
    scored: DataFrame, reports: DataFrame, keys: list[str] = REPORT
) -> DataFrame:
    """Highest tier any record of a report reaches; reports without records too."""
    stage = F.col("implementation_stage")
    tags = F.coalesce("evidence_tags", F.array().cast("array<string>"))
    tiers = scored.groupBy(*keys).agg(
        F.bool_or((stage == k.MEASURABLE) & F.col("quantitative_support")).alias("measured"),
        F.bool_or(stage == k.IN_PROGRESS).alias("active"),
        F.bool_or(
            F.array_contains(tags, "policy") | F.array_contains(tags, "governance")
        ).alias("committed"),
        F.count(F.lit(1)).alias("n_valid"),
    )
    tier = (
        F.when(F.col("n_valid").isNull(), F.lit("no_evidence_found"))
        .when(F.col("measured"), F.lit("measurable_implementation_evidence"))
        .when(F.col("active"), F.lit("implementation_in_progress"))
        .when(F.col("committed"), F.lit("strategic_commitment_present"))
        .otherwise(F.lit("symbolic_alignment_only"))
    )
    return reports.select(*keys).distinct().join(tiers, keys, "left").select(
        *keys, tier.alias("overall_assessment")
    )


def assessment_label(col="overall_assessment") -> Column:
    return F.coalesce(lookup(F.col(col), k.ASSESSMENT_LABELS), F.col(col))


def executive_summary(validated_scored: DataFrame, keys: list[str] = REPORT) -> DataFrame:
    """Per report: goals covered, valid, rejected, mean score, strength counts.

    Input holds valid records with scores and rejected ones. One pass counts
    records; goals are made distinct before they are counted per report.
    """
    valid = F.col("validation_status") == "valid"
    base = validated_scored.groupBy(*keys).agg(
        F.count_if(valid).alias("n_valid"),
        F.count_if(~valid).alias("n_rejected"),
        F.avg(F.when(valid, F.col("computed_score"))).alias("mean_score"),
        *[
            F.count_if(valid & (F.col("computed_strength") == s)).alias(f"n_{s}")
            for s in k.STRENGTHS
        ],
    )
    goals = (
        by_goal(validated_scored.filter(valid))
        .select(*keys, "sdg")
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_goals"))
    )
    return base.join(goals, keys, "left").withColumn("n_goals", F.coalesce("n_goals", F.lit(0)))


def strongest_items(
    scored: DataFrame,
    keys: list[str] = REPORT,
    order: list[str] | None = None,
    params: FindingsParams = FindingsParams(),
) -> DataFrame:
    """First strong records per report, with the report's total."""
    order = record_order(scored, order)
    strong = scored.filter(F.col("computed_strength") == "strong")
    totals = strong.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_strong"))
    best = first_n(
        strong,
        list(keys),
        [F.col("computed_score").desc(), *[F.col(c) for c in order]],
        params.strongest,
        "item_rank",
    )
    return best.join(totals, list(keys))


def moderate_items(
    scored: DataFrame,
    keys: list[str] = REPORT,
    order: list[str] | None = None,
    params: FindingsParams = FindingsParams(),
) -> DataFrame:
    """First moderate records per report, with the report's total."""
    order = record_order(scored, order)
    moderate = scored.filter(F.col("computed_strength") == "moderate")
    totals = moderate.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_moderate"))
    best = first_n(
        moderate,
        list(keys),
        [F.col("computed_score").desc(), *[F.col(c) for c in order]],
        params.moderate,
        "item_rank",
    )
    return best.join(totals, list(keys))


def reason_text(message) -> Column:
    """Kind of a message: up to the first colon, then the first bracket."""
    return strip(F.substring_index(F.substring_index(message, ":", 1), "(", 1))


def rejection_reasons(
    rejected: DataFrame,
    keys: list[str] = REPORT,
    order: list[str] | None = None,
    params: FindingsParams = FindingsParams(),
) -> DataFrame:
    """Most frequent reasons per report, ties by first appearance, with the report's
    number of different reasons."""
    order = record_order(rejected, order)
    reasons = rejected.select(
        *keys, *order, F.posexplode("validation_errors").alias("pos", "message")
    ).withColumn("reason", reason_text(F.col("message")))
    counted = reasons.groupBy(*keys, "reason").agg(
        F.count(F.lit(1)).alias("n_items"), _first_seen(reasons, order).alias("first_seen")
    )
    best = first_n(
        counted, list(keys), [F.col("n_items").desc(), F.col("first_seen")], params.reasons, "rank"
    ).drop("first_seen")
    totals = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reasons"))
    return best.join(totals, list(keys))


def page_references(pages="strongest_pages") -> Column:
    return F.array_join(
        F.transform(F.col(pages), lambda p: F.concat(F.lit("p."), p.cast("string"))), ", "
    )


def one_decimal(col) -> Column:
    return F.format_string("%.1f", round_binary(col, 1))
