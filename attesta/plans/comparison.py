"""Labelled items and predictions of several models to a ranking, in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import evaluation


def compare(
    items: DataFrame,
    predictions: DataFrame,
    models: list[str],
    embedding_models: list[str] = ("default",),
    order: list[str] = ("seq",),
) -> dict[str, DataFrame]:
    """``predictions``: validated, scored records with model, item_id and an
    order column."""
    best = evaluation.best_predictions(predictions, order=list(order))
    results = evaluation.evaluate_items(items, best, list(models))
    aggregates = evaluation.aggregate_metrics(results)
    listed = F.array(*[F.lit(m) for m in models])
    combos = evaluation.model_combinations(aggregates, list(embedding_models)).withColumn(
        "model_no", F.array_position(listed, F.col("model"))
    )
    return {
        "results": results,
        "aggregates": aggregates,
        "ranking": evaluation.rank_models(combos, ["model_no", "embedding_no"]),
    }
