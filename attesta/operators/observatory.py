"""Tables across companies and years.

The wide table has one row per valid record, the long table one per record and
goal. Every function is one grouping (plus windows over its small result).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.blocks import first_n
from attesta.functions.numbers import percent_text, round_binary, share_of
from attesta.functions.text import lookup
from attesta.operators.findings import goal_number, record_order, stage_rank, strength_rank
from attesta.params import MaturityParams, PeriodParams

COMPANY_YEAR = ["company", "report_year"]


def period_label(params: PeriodParams = PeriodParams()) -> Column:
    return F.when(F.col("report_year") <= params.cut_year, F.lit(params.before)).otherwise(
        F.lit(params.after)
    )


def wide_table(*runs: DataFrame, params: PeriodParams = PeriodParams()) -> DataFrame:
    """Union of record tables with stage and strength ranks and the period."""
    table = runs[0]
    for run in runs[1:]:
        table = table.unionByName(run, allowMissingColumns=True)
    return (
        table.withColumn("stage_rank", stage_rank())
        .withColumn("strength_rank", strength_rank())
        .withColumn("period", period_label(params))
    )


def long_table(wide: DataFrame) -> DataFrame:
    return wide.withColumn("sdg", F.explode("candidate_sdgs")).withColumn(
        "sdg_num", F.regexp_substr("sdg", F.lit(r"\d+")).try_cast("int")
    )


def rejected_table(*runs: DataFrame) -> DataFrame:
    columns = [
        "evidence_id", "company", "report_year", "page_number", "evidence_text",
        "implementation_stage", "validation_errors", "computed_score",
    ]
    table = runs[0]
    for run in runs[1:]:
        table = table.unionByName(run, allowMissingColumns=True)
    if "computed_score" not in table.columns:
        table = table.withColumn("computed_score", F.lit(None).cast("int"))
    return table.select(*columns)


def goal_year_table(summaries: DataFrame, params: PeriodParams = PeriodParams()) -> DataFrame:
    return summaries.withColumn("sdg_num", goal_number()).withColumn(
        "period", period_label(params)
    )


def run_table(
    reports: DataFrame, valid: DataFrame, rejected: DataFrame, keys: list[str] = COMPANY_YEAR
) -> DataFrame:
    """Counts and rejection rate per report; NULL rate for an empty report."""
    n_valid = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_valid"))
    n_rejected = rejected.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rejected"))
    counted = (
        reports.join(n_valid, keys, "left")
        .join(n_rejected, keys, "left")
        .fillna(0, ["n_valid", "n_rejected"])
    )
    return counted.withColumn("rejection_rate", rejection_rate())


def rejection_rate() -> Column:
    return F.try_divide(
        F.col("n_rejected").cast("double"), F.col("n_valid") + F.col("n_rejected")
    )


def company_totals(runs: DataFrame, long: DataFrame) -> DataFrame:
    """Reports, valid, rejected and distinct goals per company plus a total row."""
    counts = runs.rollup("company").agg(
        F.grouping("company").alias("is_total"),
        F.count(F.lit(1)).alias("n_reports"),
        F.sum("n_valid").alias("n_valid"),
        F.sum("n_rejected").alias("n_rejected"),
    )
    goals = (
        long.select("company", "sdg")
        .distinct()
        .rollup("company")
        .agg(F.grouping("company").alias("is_total"), F.count_distinct("sdg").alias("n_goals"))
    )
    named = F.when(F.col("is_total") == 1, F.lit("Total")).otherwise(F.initcap("company"))

    def label(df):
        return df.withColumn("company", named)

    return (
        label(counts)
        .join(label(goals), ["company", "is_total"], "left")
        .withColumn("n_goals", F.coalesce("n_goals", F.lit(0)))
    )


def yearly_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy(F.initcap("company").alias("company"), "report_year").agg(
        F.sum("n_valid").alias("n_valid"), F.sum("n_rejected").alias("n_rejected")
    )


def load_audit(validated: DataFrame) -> DataFrame:
    """Overall counts. Distinct years and companies are counted on the distinct
    company-years, not on the records."""
    valid = F.col("validation_status") == "valid"
    per_run = validated.groupBy(*COMPANY_YEAR).agg(
        F.count_if(valid).alias("v"), F.count_if(~valid).alias("r")
    )
    return per_run.agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("n_valid"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("n_rejected"),
        F.count_distinct(F.when(F.col("v") > 0, F.col("report_year"))).alias("n_years"),
        F.count_distinct(F.when(F.col("v") > 0, F.col("company"))).alias("n_companies"),
    )


def quality_audit(runs: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("n_valid").cast("double"), F.col("n_valid") + F.col("n_rejected"))
    return runs.withColumn("pass_rate", rate).withColumn("pass_text", percent_text(rate))


def calibration(wide: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Linear fit of score on confidence with the parts of its error band."""
    fit = wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("computed_score", "confidence").alias("slope"),
        F.regr_intercept("computed_score", "confidence").alias("intercept"),
        F.corr("computed_score", "confidence").alias("correlation"),
        F.regr_r2("computed_score", "confidence").alias("r2"),
        F.regr_sxx("computed_score", "confidence").alias("sxx"),
        F.regr_syy("computed_score", "confidence").alias("syy"),
        F.regr_sxy("computed_score", "confidence").alias("sxy"),
        F.regr_avgx("computed_score", "confidence").alias("mean_confidence"),
    )
    left = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    residual = F.when(left < 0, F.lit(0.0)).otherwise(left)
    return fit.withColumn("residual_se", F.sqrt(F.try_divide(residual, F.col("n") - 2)))


def calibration_band(fit: DataFrame, points: list[float], width: float = 1.96) -> DataFrame:
    """Fitted value and band at given confidence values."""
    x = F.col("confidence")
    se = F.col("residual_se") * F.sqrt(
        F.try_divide(F.lit(1.0), F.col("n"))
        + F.try_divide(
            (x - F.col("mean_confidence")) * (x - F.col("mean_confidence")), F.col("sxx")
        )
    )
    return (
        fit.withColumn("confidence", F.explode(F.array(*[F.lit(float(p)) for p in points])))
        .withColumn("fitted", F.col("intercept") + F.col("slope") * x)
        .withColumn("lower", F.col("fitted") - width * se)
        .withColumn("upper", F.col("fitted") + width * se)
    )


def tag_stage_counts(long: DataFrame) -> DataFrame:
    return (
        long.select("implementation_stage", F.explode("evidence_tags").alias("tag"))
        .groupBy("tag", "implementation_stage")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def tag_stage_matrix(long: DataFrame) -> DataFrame:
    """The same with one column per stage."""
    return (
        long.select("implementation_stage", F.explode("evidence_tags").alias("tag"))
        .groupBy("tag")
        .pivot("implementation_stage", k.STAGES)
        .agg(F.count(F.lit(1)))
        .fillna(0)
    )


def goal_year_heatmap(goal_years: DataFrame) -> DataFrame:
    return goal_years.select(
        "company", "report_year", "sdg", "sdg_num", "evidence_count", "average_score",
        "implementation_profile",
    )


def volume_trend(runs: DataFrame) -> DataFrame:
    """Counts per company-year next to the company's mean rejection rate."""
    mean = runs.groupBy("company").agg(F.avg("rejection_rate").alias("mean_rejection_rate"))
    return runs.select(*COMPANY_YEAR, "n_valid", "n_rejected", "rejection_rate").join(
        mean, "company"
    )


def stage_shares(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Share of each stage within a group; the window runs over the counts only."""
    counts = wide.groupBy(*keys, "implementation_stage").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") / F.sum("n").over(W.partitionBy(*keys)))


def _quality() -> Column:
    return F.col("quantitative_support") | F.col("oversight_support")


def _index(score, stage, quality, p: MaturityParams) -> Column:
    return (
        (F.col(score) / p.score_divisor) * p.score_weight
        + (F.col(stage) / 4) * p.stage_weight
        + F.col(quality) * p.quality_weight
    )


def maturity_index(
    wide: DataFrame,
    keys: list[str] = COMPANY_YEAR,
    params: MaturityParams = MaturityParams(),
    period: PeriodParams = PeriodParams(),
) -> DataFrame:
    """All maturity measures of a group in one aggregation."""
    stage, strength = F.col("implementation_stage"), F.col("computed_strength")
    table = wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("computed_score").alias("avg_score"),
        F.avg(stage_rank()).alias("stage_weight_avg"),
        share_of(_quality()).alias("quality_rate"),
        share_of(F.col("quantitative_support")).alias("quant_rate"),
        share_of(F.col("oversight_support")).alias("oversight_rate"),
        *[share_of(strength == s).alias(f"pct_{s}") for s in k.STRENGTHS],
        share_of(stage == k.MENTION).alias("pct_mention_only"),
        share_of(stage == k.PLANNED).alias("pct_planned"),
        share_of(stage == k.IN_PROGRESS).alias("pct_in_progress"),
        share_of(stage == k.MEASURABLE).alias("pct_measurable"),
    )
    table = table.withColumn(
        "maturity_index", _index("avg_score", "stage_weight_avg", "quality_rate", params)
    )
    return table.withColumn("period", period_label(period)) if "report_year" in keys else table


def goal_maturity(
    long: DataFrame,
    params: MaturityParams = MaturityParams(),
    period: PeriodParams = PeriodParams(),
) -> DataFrame:
    table = long.groupBy("company", "report_year", "sdg").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("computed_score").alias("avg_score"),
        share_of(_quality()).alias("quality_rate"),
        F.avg(stage_rank()).alias("stage_weight"),
    )
    return (
        table.withColumn(
            "sdg_maturity", _index("avg_score", "stage_weight", "quality_rate", params)
        )
        .withColumn("sdg_num", F.regexp_substr("sdg", F.lit(r"\d+")).try_cast("int"))
        .withColumn("period", period_label(period))
    )


def period_summary(wide: DataFrame) -> DataFrame:
    return wide.groupBy("company", "period").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.avg("computed_score").alias("avg_score"),
        share_of(_quality()).alias("quality_rate"),
        share_of(F.col("quantitative_support")).alias("quant_rate"),
        share_of(F.col("oversight_support")).alias("oversight_rate"),
        share_of(F.col("implementation_stage") == k.MEASURABLE).alias("pct_measurable"),
        share_of(F.col("computed_strength") == "weak").alias("pct_weak"),
        share_of(F.col("computed_strength") == "strong").alias("pct_strong"),
    )


def quality_by_year(wide: DataFrame, keys: list[str] = COMPANY_YEAR) -> DataFrame:
    return wide.groupBy(*keys).agg(
        share_of(F.col("quantitative_support")).alias("quant_rate"),
        share_of(F.col("oversight_support")).alias("oversight_rate"),
    )


def goal_totals(long: DataFrame, keys: list[str] = ("company",)) -> DataFrame:
    """Per goal: items, mean score, quantified and strong shares, years present."""
    return long.groupBy(*keys, "sdg").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("computed_score").alias("avg_score"),
        share_of(F.col("quantitative_support")).alias("quant_share"),
        share_of(F.col("computed_strength") == "strong").alias("strong_share"),
        F.array_join(
            F.transform(F.array_sort(F.collect_set("report_year")), lambda y: y.cast("string")),
            ", ",
        ).alias("years"),
    )


def top_evidence(
    wide: DataFrame, n: int = 30, keys: list[str] = ("company",),
    order: list[str] | None = None,
) -> DataFrame:
    """Best records per company by score, then confidence."""
    best = first_n(
        wide,
        list(keys),
        [
            F.col("computed_score").desc(),
            F.col("confidence").desc_nulls_last(),
            *[F.col(c) for c in record_order(wide, order)],
        ],
        n,
        "rank",
    )
    return best.select(
        *keys,
        "rank",
        "report_year",
        "page_number",
        "computed_score",
        "computed_strength",
        lookup(F.col("implementation_stage"), k.STAGE_SHORT_LABELS).alias("stage"),
        F.array_join("candidate_sdgs", ", ").alias("sdgs"),
        F.array_join("evidence_tags", ", ").alias("tags"),
        *[c for c in ("evidence_summary",) if c in wide.columns],
        "evidence_text",
    )


def full_table(wide: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Every record for display, sorted by year and falling score."""
    tick = "✓"
    return wide.orderBy(
        "report_year", F.col("computed_score").desc(), *[F.col(c) for c in record_order(wide, order)]
    ).select(
        "evidence_id",
        "company",
        "report_year",
        "page_number",
        "computed_score",
        "computed_strength",
        lookup(F.col("implementation_stage"), k.STAGE_TABLE_LABELS).alias("stage"),
        F.array_join("candidate_sdgs", ", ").alias("sdgs"),
        F.array_join("evidence_tags", ", ").alias("tags"),
        F.when(F.col("quantitative_support"), tick).otherwise("").alias("quant"),
        F.when(F.col("oversight_support"), tick).otherwise("").alias("oversight"),
        "evidence_text",
    )


def company_table(runs: DataFrame, wide: DataFrame) -> DataFrame:
    """Year range, reports, valid records and the company's own mean score."""
    spans = runs.groupBy("company").agg(
        F.concat_ws(
            "–", F.min("report_year").cast("string"), F.max("report_year").cast("string")
        ).alias("years"),
        F.count(F.lit(1)).alias("n_reports"),
        F.sum("n_valid").alias("n_valid"),
    )
    means = wide.groupBy("company").agg(F.avg("computed_score").alias("avg_score"))
    return spans.join(means, "company", "left")


def goal_portfolio(long: DataFrame, keys: list[str] = ("company",)) -> DataFrame:
    return long.groupBy(*keys, "sdg").agg(
        F.avg("computed_score").alias("avg_score"), F.count(F.lit(1)).alias("n")
    )


def company_quality(validated_scored: DataFrame) -> DataFrame:
    """Quality of valid records and rejection rate, in one pass over all records."""
    valid = F.col("validation_status") == "valid"

    def share(flag):
        return F.avg(F.when(valid, flag.cast("int")))

    table = validated_scored.groupBy("company").agg(
        F.count_if(valid).alias("n_valid"),
        F.count_if(~valid).alias("n_rejected"),
        F.avg(F.when(valid, F.col("computed_score"))).alias("avg_score"),
        share(F.col("computed_strength") == "strong").alias("strong_share"),
        share(F.col("quantitative_support")).alias("quant_share"),
        share(F.col("oversight_support")).alias("oversight_share"),
    )
    return table.withColumn("rejection_rate", rejection_rate())


def goal_leaders(long: DataFrame) -> DataFrame:
    """Company with the highest mean (two decimals) per goal; ties are kept."""
    means = goal_portfolio(long).withColumn("avg_score", round_binary(F.col("avg_score"), 2))
    order = W.partitionBy("sdg").orderBy(F.col("avg_score").desc())
    return means.withColumn("r", F.rank().over(order)).filter(F.col("r") == 1).drop("r")


def status_from_label(col) -> Column:
    """Status read from the words of a label; a raw code contains none of them."""
    return (
        F.when(col.isNull(), F.lit("No data"))
        .when(col.rlike("None|No SDG"), F.lit("No evidence"))
        .when(col.rlike("Strong"), F.lit("Strong"))
        .when(col.rlike("Substantial|Moderate"), F.lit("Moderate"))
        .otherwise(F.lit("Partial"))
    )


def status_from_assessment(col) -> Column:
    """Status of an assessment code, through its label."""
    return status_from_label(F.coalesce(lookup(col, k.ASSESSMENT_LABELS), col))


def report_index(
    runs: DataFrame, report_files: DataFrame, keys: list[str] = COMPANY_YEAR
) -> DataFrame:
    """Report list with status, counts, rejection percent and file, if any."""
    return runs.join(report_files, keys, "left").select(
        F.initcap("company").alias("company"),
        "report_year",
        F.coalesce("report_name", F.lit("—")).alias("report_name"),
        status_from_label(F.col("overall_assessment")).alias("status"),
        status_from_assessment(F.col("overall_assessment")).alias("assessment_status"),
        "n_valid",
        "n_rejected",
        percent_text(F.col("rejection_rate")).alias("rejected_percent"),
        "report_file",
    )


def only_company(df: DataFrame, company: str) -> DataFrame:
    """Rows of one company; prunes partitions when stored by company."""
    return df.filter(F.col("company") == company)
