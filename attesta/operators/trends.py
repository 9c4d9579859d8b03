"""Change over years: trend breaks, drops, anomalies, shares and slopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.blocks import first_n
from attesta.functions.numbers import share_of


def maturity_components(maturity: DataFrame) -> DataFrame:
    """Long table of the three components per company-year."""
    named = maturity.select(
        "company",
        "report_year",
        F.col("avg_score").alias("score_component"),
        F.col("stage_weight_avg").alias("stage_component"),
        F.col("quality_rate").alias("quality_component"),
    )
    return named.unpivot(
        ["company", "report_year"],
        ["score_component", "stage_component", "quality_component"],
        "component",
        "value",
    )


def trend_breaks(
    series: DataFrame,
    cut_year: int,
    value: str = "maturity_index",
    key: str = "company",
    min_years: int = 5,
) -> DataFrame:
    """Interrupted time series per key: level and slope before a break, change
    of level and slope after it.

    The model with both interactions equals one straight line per side, so
    each side is a plain regression over years. A side with a single year
    leaves one coefficient undetermined, which is NULL.
    """
    first_year = series.groupBy(key).agg(F.min("report_year").alias("first_year"))
    timed = series.join(first_year, key).withColumn(
        "t", (F.col("report_year") - F.col("first_year")).cast("double")
    )
    post = F.col("report_year") > cut_year
    y, t = F.col(value), F.col("t")

    def side(fn, flag) -> Column:
        return fn(F.when(flag, y), F.when(flag, t))

    sums = timed.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_years"),
        F.count_if(~post).alias("n_pre"),
        F.count_if(post).alias("n_post"),
        side(F.regr_slope, ~post).alias("pre_slope"),
        side(F.regr_intercept, ~post).alias("pre_level"),
        side(F.regr_slope, post).alias("post_slope"),
        side(F.regr_intercept, post).alias("post_level"),
        F.avg(F.when(~post, y)).alias("pre_mean"),
        F.avg(F.when(post, y)).alias("post_mean"),
        F.avg(F.when(post, t)).alias("post_t"),
    )
    c = F.col
    level = (
        F.when(c("n_pre") == 0, c("post_level"))
        .when(c("n_pre") == 1, c("pre_mean"))
        .otherwise(c("pre_level"))
    )
    slope = F.when(c("n_pre") <= 1, c("post_slope")).otherwise(c("pre_slope"))
    level_change = (
        F.when((c("n_pre") == 0) | (c("n_post") == 0), F.lit(None))
        .when(c("n_post") == 1, c("post_mean") - (c("pre_level") + c("pre_slope") * c("post_t")))
        .otherwise(c("post_level") - level)
    )
    slope_change = F.when(
        (c("n_pre") >= 2) & (c("n_post") >= 2), c("post_slope") - c("pre_slope")
    )
    return sums.filter(c("n_years") >= min_years).select(
        key,
        "n_years",
        level.alias("level"),
        slope.alias("slope"),
        level_change.alias("level_change"),
        slope_change.alias("slope_change"),
        "post_level",
        "post_slope",
        "post_mean",
        "n_post",
        "n_pre",
    )


def fitted_breaks(
    series: DataFrame, breaks: DataFrame, cut_year: int, key: str = "company"
) -> DataFrame:
    """Fitted value per year for the keys that have a break model."""
    first_year = series.groupBy(key).agg(F.min("report_year").alias("first_year"))
    t = (F.col("report_year") - F.col("first_year")).cast("double")
    post = F.col("report_year") > cut_year
    after = F.when(F.col("n_post") == 1, F.col("post_mean")).otherwise(
        F.col("post_level") + F.col("post_slope") * t
    )
    before = F.when(F.col("n_pre") == 1, F.col("level")).otherwise(
        F.col("level") + F.col("slope") * t
    )
    return (
        series.join(first_year, key)
        .join(breaks, key)
        .select(key, "report_year", F.when(post, after).otherwise(before).alias("fitted"))
    )


def confident_but_weak(wide: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """Weak records the extractor was sure about, most confident first."""
    return (
        wide.filter(
            (F.col("confidence") >= min_confidence) & (F.col("computed_strength") == "weak")
        )
        .orderBy(F.col("confidence").desc(), "evidence_id")
        .select(
            "evidence_id",
            "company",
            "report_year",
            "page_number",
            "computed_score",
            "confidence",
            "implementation_stage",
            F.array_join("candidate_sdgs", ", ").alias("sdgs"),
            *[c for c in ("evidence_summary",) if c in wide.columns],
        )
    )


def score_drops(goal_years: DataFrame, threshold: float = -1.0) -> DataFrame:
    """Goal-years whose mean fell by more than one point since the previous
    reported year. Input has one row per company, goal and year."""
    order = W.partitionBy("company", "sdg").orderBy("report_year")
    return (
        goal_years.withColumn("previous_score", F.lag("average_score").over(order))
        .withColumn("drop", F.col("average_score") - F.col("previous_score"))
        .filter(F.col("drop") < threshold)
        .select("company", "sdg", "report_year", "previous_score", "average_score", "drop")
        .orderBy("drop", "company", "sdg", "report_year")
    )


def disclosure_shares(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Shares of rhetoric, commitment, implementation and measured results."""
    stage = F.col("implementation_stage")
    return wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_valid"),
        share_of(stage == k.MENTION).alias("rhetoric_share"),
        share_of(stage == k.PLANNED).alias("commitment_share"),
        share_of(stage.isin(k.IN_PROGRESS, k.MEASURABLE)).alias("implementation_share"),
        share_of(stage == k.MEASURABLE).alias("measured_share"),
        F.avg("computed_score").alias("mean_score"),
    )


def share_slopes(yearly_shares: DataFrame, key: str = "company") -> DataFrame:
    """Yearly change of the implementation and rhetoric shares."""
    year = F.col("report_year").cast("double")
    return yearly_shares.groupBy(key).agg(
        F.min("report_year").alias("first_year"),
        F.max("report_year").alias("last_year"),
        F.regr_slope("implementation_share", year).alias("implementation_slope"),
        F.regr_slope("rhetoric_share", year).alias("rhetoric_slope"),
    )


def _top_goals(ranked: DataFrame, key: str, measure: str, n: int, name: str) -> DataFrame:
    goal_no = F.regexp_substr("sdg", F.lit(r"\d+")).try_cast("int")
    best = first_n(
        ranked.withColumn("goal_no", goal_no),
        [key],
        [F.col(measure).desc(), F.col("goal_no"), F.col("sdg")],
        n,
        "rn",
    )
    return best.groupBy(key).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rn", "sdg"))), lambda s: s["sdg"]
            ),
            ", ",
        ).alias(name)
    )


def dominant_goals(long: DataFrame, n: int = 3, key: str = "company") -> DataFrame:
    counts = long.groupBy(key, "sdg").agg(F.count(F.lit(1)).alias("n_items"))
    return _top_goals(counts, key, "n_items", n, "dominant_sdgs")


def persistent_goals(long: DataFrame, n: int = 3, key: str = "company") -> DataFrame:
    """Goals present in the most years; equal years go by record count."""
    yearly = long.groupBy(key, "sdg", "report_year").agg(F.count(F.lit(1)).alias("n_items"))
    years = yearly.groupBy(key, "sdg").agg(
        F.struct(F.count(F.lit(1)).alias("n_years"), F.sum("n_items").alias("n_items")).alias("m")
    )
    return _top_goals(years, key, "m", n, "persistent_sdgs")


def country_portfolio(
    company_measures: DataFrame, countries: DataFrame, measures: list[str]
) -> DataFrame:
    """Means of company measures per country; companies without a country are
    kept under NULL."""
    return (
        company_measures.join(countries.select("company", "country"), "company", "left")
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("n_companies"), *[F.avg(m).alias(m) for m in measures]
        )
    )


def to_long(df: DataFrame, keys: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, values, name, value)


def year_grid(df: DataFrame, key: str = "company", year: str = "report_year") -> DataFrame:
    """Every key with every year that occurs anywhere.

    The years are a short list; they are gathered from the distinct years and
    expanded per key, without a join.
    """
    years = df.select(year).distinct().agg(F.sort_array(F.collect_list(year)).alias("y"))
    keys = df.select(key).distinct()
    return keys.withColumn("y", years.scalar()).select(key, F.explode("y").alias(year))


def goal_grid(df: DataFrame, key: str = "company") -> DataFrame:
    goals = F.array(*[F.lit(g) for g in k.GOALS])
    return df.select(key).distinct().select(key, F.explode(goals).alias("sdg"))


def fill_grid(grid: DataFrame, df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Grid cells with their measures, 0 where there is no data."""
    return grid.join(df.select(*keys, *measures), keys, "left").fillna(0, measures)
