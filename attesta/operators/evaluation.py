"""Labelled items against predictions: metrics, rates, ranking of models.

Predictions of all models are one table with a model column, so every model is
evaluated in the same job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.numbers import round_binary, share_of
from attesta.functions.text import lookup
from attesta.functions.vectors import jaccard

RECALL_CUTS = (1, 3, 5, 10)
ITEM_DEFAULTS = {
    "company": "BenchmarkCo",
    "report_name": "Benchmark Report",
    "report_year": 2023,
    "page_number": 1,
    "section_heading": "Benchmark Section",
    "expected_implementation_stage": "",
    "expected_quantitative_support": False,
    "expected_oversight_support": False,
    "expected_valid": True,
}


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def with_item_defaults(items: DataFrame) -> DataFrame:
    filled = items
    for name, value in ITEM_DEFAULTS.items():
        filled = filled.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    for name in ("expected_sdgs", "expected_evidence_tags"):
        filled = filled.withColumn(name, F.coalesce(F.col(name), _no_strings()))
    return filled


# --- single metrics ---------------------------------------------------------------


def _order_of(stage) -> Column:
    return lookup(stage, {s: i for i, s in enumerate(k.STAGES)}, F.lit(-1))


def stage_overclaim(predicted, expected) -> Column:
    both = (F.coalesce(predicted, F.lit("")) != "") & (F.coalesce(expected, F.lit("")) != "")
    return both & (_order_of(predicted) > _order_of(expected))


def quant_overclaim(text, flag) -> Column:
    return flag & ~F.coalesce(text, F.lit("")).rlike("(?U)" + k.NUMERIC_PATTERN)


def oversight_overclaim(text, flag) -> Column:
    return flag & ~F.coalesce(text, F.lit("")).rlike("(?U)" + k.OVERSIGHT_PATTERN)


# --- predictions ------------------------------------------------------------------


def best_predictions(
    scored: DataFrame, keys: list[str] = ("model", "item_id"), order: list[str] = ("seq",)
) -> DataFrame:
    """Per model and item: the valid record with the highest score, first on
    ties, and how many records were extracted and valid.

    One partially aggregated min-by; no per-item list is built. The last key is
    grouped first, so the result lies in the order in which items are joined.
    """
    valid = F.col("validation_status") == "valid"
    record = F.struct(
        "candidate_sdgs",
        "evidence_tags",
        "implementation_stage",
        "quantitative_support",
        "oversight_support",
        "evidence_text",
        "computed_score",
    )
    rank = F.struct((-F.col("computed_score")).alias("s"), *order)
    found = scored.groupBy(*reversed(keys)).agg(
        F.count(F.lit(1)).alias("extracted_count"),
        F.count_if(valid).alias("valid_count"),
        F.min_by(record, F.when(valid, rank)).alias("best"),
    )
    return found.select(*keys, "extracted_count", "valid_count", "best")


def evaluate_items(
    items: DataFrame,
    best: DataFrame,
    models: list[str],
    item_columns: list[str] = (),
    model: str = "model",
) -> DataFrame:
    """Metric row per model and item; an item without valid record counts as
    an empty prediction.

    ``best`` has one row per model and item. The models of an item are brought side by
    side and joined by the item alone, so rows that already lie by item do not move.
    """
    rows = F.struct("extracted_count", "valid_count", "best")
    sides = best.groupBy("item_id").agg(
        *[F.max_by(rows, F.when(F.col(model) == m, F.lit(1))).alias(f"__{i}") for i, m in enumerate(models)]
    )
    grid = F.array(*[F.struct(F.lit(m).alias("m"), F.col(f"__{i}").alias("b")) for i, m in enumerate(models)])
    joined = (
        items.join(sides, "item_id", "left")
        .withColumn("__side", F.explode(grid))
        .withColumns({model: F.col("__side.m"), **{
            name: F.col(f"__side.b.{name}") for name in ("extracted_count", "valid_count", "best")
        }})
    )

    def predicted(name: str, default) -> Column:
        return F.coalesce(F.col(f"best.{name}"), default)

    pairs = joined.select(
        model,
        "item_id",
        *item_columns,
        "expected_sdgs",
        F.col("expected_evidence_tags").alias("expected_tags"),
        F.col("expected_implementation_stage").alias("expected_stage"),
        F.col("expected_quantitative_support").alias("expected_quant"),
        F.col("expected_oversight_support").alias("expected_oversight"),
        "expected_valid",
        predicted("candidate_sdgs", _no_strings()).alias("predicted_sdgs"),
        predicted("evidence_tags", _no_strings()).alias("predicted_tags"),
        predicted("implementation_stage", F.lit("")).alias("predicted_stage"),
        predicted("quantitative_support", F.lit(False)).alias("predicted_quant"),
        predicted("oversight_support", F.lit(False)).alias("predicted_oversight"),
        F.col("best").isNotNull().alias("predicted_valid"),
        predicted("evidence_text", F.lit("")).alias("predicted_text"),
        F.coalesce("extracted_count", F.lit(0)).alias("extracted_count"),
        F.coalesce("valid_count", F.lit(0)).alias("valid_count"),
    )
    return add_metrics(pairs)


def add_metrics(pairs: DataFrame) -> DataFrame:
    c = F.col
    return pairs.withColumns(
        {
            "sdg_jaccard": jaccard(c("predicted_sdgs"), c("expected_sdgs")),
            "tag_jaccard": jaccard(c("predicted_tags"), c("expected_tags")),
            "stage_exact": c("predicted_stage") == c("expected_stage"),
            "stage_overclaim": stage_overclaim(c("predicted_stage"), c("expected_stage")),
            "quant_exact": c("predicted_quant") == c("expected_quant"),
            "oversight_exact": c("predicted_oversight") == c("expected_oversight"),
            "validation_correct": c("predicted_valid") == c("expected_valid"),
            "quant_overclaim": quant_overclaim(c("predicted_text"), c("predicted_quant")),
            "oversight_overclaim": oversight_overclaim(
                c("predicted_text"), c("predicted_oversight")
            ),
        }
    )


# --- aggregates -------------------------------------------------------------------


def any_overclaim() -> Column:
    return F.col("stage_overclaim") | F.col("quant_overclaim") | F.col("oversight_overclaim")


def aggregate_metrics(results: DataFrame, keys: list[str] = ("model",)) -> DataFrame:
    """Item count, two means and six rates per group, in one aggregation."""
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("sdg_jaccard").alias("sdg_jaccard_mean"),
        F.avg("tag_jaccard").alias("tag_jaccard_mean"),
        share_of(F.col("stage_exact")).alias("stage_exact_rate"),
        share_of(F.col("stage_overclaim")).alias("stage_overclaim_rate"),
        share_of(F.col("quant_exact")).alias("quant_exact_rate"),
        share_of(F.col("oversight_exact")).alias("oversight_exact_rate"),
        share_of(F.col("validation_correct")).alias("validation_accuracy"),
        share_of(any_overclaim()).alias("over_claim_rate"),
    )


def rounded_metrics(aggregates: DataFrame, digits: int = 3) -> DataFrame:
    """The published metrics: every mean and rate rounded."""
    return aggregates.select(
        *[
            round_binary(F.col(f.name), digits).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f.name)
            for f in aggregates.schema
        ]
    )


def selection_score() -> Column:
    return (
        (1.0 - F.col("over_claim_rate")) * 2.0
        + F.col("sdg_jaccard_mean")
        + F.col("tag_jaccard_mean")
        + F.col("stage_exact_rate")
        + F.col("quant_exact_rate")
        + F.col("oversight_exact_rate")
    )


def model_combinations(chat_models: DataFrame, embedding_models: list[str]) -> DataFrame:
    """Every chat model with every embedding model. The models are a short
    configured list; the embedding model does not change extraction results."""
    return chat_models.select(
        "*",
        F.posexplode(F.array(*[F.lit(m) for m in embedding_models])).alias(
            "embedding_no", "embedding_model"
        ),
    ).withColumn("combo_key", F.concat_ws("+", "model", "embedding_model"))


def rank_models(aggregates: DataFrame, tie_order: list[str]) -> DataFrame:
    """Ranked groups, the first one recommended. Runs on one row per model.

    The score is taken from the published (rounded) metrics and rounded to four
    digits itself, so models that publish the same figures tie; ties keep the
    order of the combinations.
    """
    scored = rounded_metrics(aggregates).withColumn(
        "selection_score", round_binary(selection_score(), 4)
    )
    order = W.orderBy(F.col("selection_score").desc(), *[F.col(c) for c in tie_order])
    return scored.withColumn("rank", F.row_number().over(order)).withColumn(
        "recommended", F.col("rank") == 1
    )


def runtime_totals(results: DataFrame, keys: list[str] = ("model",)) -> DataFrame:
    return results.groupBy(*keys).agg(
        F.sum("runtime_seconds").alias("total_runtime_seconds"),
        F.avg("runtime_seconds").alias("avg_item_runtime_seconds"),
        F.sum("extracted_count").alias("extracted_evidence_count"),
        F.sum("valid_count").alias("valid_evidence_count"),
    )


def recall_curve(
    ranked: DataFrame, relevant: DataFrame, query: str = "query_id", doc: str = "doc_id",
    cuts=RECALL_CUTS,
) -> DataFrame:
    """Recall per query and cut-off; a query nothing is expected for scores 1.

    ``ranked``: (query, doc, rank); ``relevant``: (query, doc). Only the ranks
    up to the largest cut-off are joined.
    """
    expected = relevant.select(query, doc).distinct()
    totals = expected.groupBy(query).agg(F.count(F.lit(1)).alias("n_relevant"))
    deepest = max(cuts)
    hits = (
        ranked.filter(F.col("rank") <= deepest)
        .select(query, doc, "rank")
        .join(expected, [query, doc], "left_semi")
        .groupBy(query, doc)
        .agg(F.min("rank").alias("rank"))
        .groupBy(query)
        .agg(*[F.count_if(F.col("rank") <= c).alias(f"hits_{c}") for c in cuts])
    )
    asked = ranked.select(query).union(relevant.select(query)).distinct()
    joined = asked.join(totals, query, "left").join(hits, query, "left")
    curve = F.array(
        *[
            F.struct(
                F.lit(c).alias("k"),
                F.when(F.col("n_relevant").isNull(), F.lit(1.0))
                .otherwise(F.coalesce(F.col(f"hits_{c}"), F.lit(0)) / F.col("n_relevant"))
                .alias("recall"),
            )
            for c in cuts
        ]
    )
    return joined.select(query, F.inline(curve))


def goal_f1(results: DataFrame, keys: list[str]) -> DataFrame:
    """Micro-averaged F1 of predicted goals and precision of valid items."""
    hit = F.size(F.array_intersect("predicted_sdgs", "expected_sdgs"))
    n_predicted = F.size(F.array_distinct("predicted_sdgs"))
    n_expected = F.size(F.array_distinct("expected_sdgs"))
    sums = results.groupBy(*keys).agg(
        F.sum(hit).alias("tp"),
        F.sum(n_predicted - hit).alias("fp"),
        F.sum(n_expected - hit).alias("fn"),
        F.count_if(F.col("predicted_valid")).alias("n_predicted_valid"),
        F.count_if(F.col("predicted_valid") & F.col("expected_valid")).alias("n_correct_valid"),
    )
    return sums.withColumn(
        "sdg_f1", F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    ).withColumn(
        "valid_precision",
        F.try_divide(F.col("n_correct_valid").cast("double"), F.col("n_predicted_valid")),
    )


def model_agreement(
    results: DataFrame, first: str, second: str, keys: list[str], model: str = "model"
) -> DataFrame:
    """Agreement of two models on the same items.

    Both predictions of an item are brought side by side by one aggregation
    instead of a self-join.
    """

    def of(name: str, which: str) -> Column:
        return F.max_by(
            F.col(name), F.when(F.col(model) == which, F.lit(1))
        )

    flagged = results.withColumn("overclaim", any_overclaim())
    sides = flagged.filter(F.col(model).isin(first, second)).groupBy("item_id", *keys).agg(
        (F.min(model) != F.max(model)).alias("both"),
        of("predicted_sdgs", first).alias("sdgs_a"),
        of("predicted_sdgs", second).alias("sdgs_b"),
        of("predicted_stage", first).alias("stage_a"),
        of("predicted_stage", second).alias("stage_b"),
        of("overclaim", first).alias("over_a"),
        of("overclaim", second).alias("over_b"),
    )
    return (
        sides.filter("both")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.avg(jaccard(F.col("sdgs_a"), F.col("sdgs_b"))).alias("sdg_agreement"),
            share_of(F.col("stage_a") == F.col("stage_b")).alias("stage_agreement"),
            F.abs(share_of(F.col("over_a")) - share_of(F.col("over_b"))).alias(
                "overclaim_difference"
            ),
        )
    )


def ablation_table(results: DataFrame, variant: str = "variant") -> DataFrame:
    """Long table (variant, metric, value) of the aggregate metrics."""
    wide = aggregate_metrics(results, [variant]).drop("n")
    return wide.unpivot([variant], [c for c in wide.columns if c != variant], "metric", "value")
