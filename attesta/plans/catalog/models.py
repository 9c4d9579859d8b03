"""Evaluation of predictions against labelled items."""

from pyspark.sql import functions as F

from attesta import constants as k
from attesta.operators import evaluation
from attesta.functions.blocks import first_n
from attesta.functions.text import preview
from attesta.plans.catalog import register
from attesta.plans.catalog.texts import SIMILAR_SQL, similarities
from attesta.plans.driver_tables import EVIDENCE_SQL, MODELS, checked_sql

_ORDER = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(k.STAGES))
ITEMS_SQL = f"""WITH {EVIDENCE_SQL}, {checked_sql('lines', 'line_checks')},
  items AS (SELECT l_orderkey AS item_id, company, candidate_sdgs AS expected_sdgs,
    evidence_tags AS expected_tags, implementation_stage AS expected_stage,
    quantitative_support AS expected_quant, oversight_support AS expected_oversight,
    validation_status = 'valid' AS expected_valid FROM (SELECT *, row_number() OVER (
      PARTITION BY l_orderkey ORDER BY evidence_id) AS rn FROM line_checks) WHERE rn = 1)"""
PREDICTIONS_SQL = (
    ITEMS_SQL
    + f""", moved AS (SELECT * REPLACE (
      CASE WHEN l_partkey % (5 + model_no) <> 0 THEN implementation_stage
        WHEN implementation_stage = 'mention_only' THEN 'planned_action'
        WHEN implementation_stage = 'planned_action' THEN 'implementation_in_progress'
        ELSE implementation_stage END AS implementation_stage,
      l_partkey % (5 + model_no) = 0 OR oversight_support AS oversight_support),
      'm' || model_no AS model, l_orderkey AS item_id
      FROM lines, (SELECT unnest([1, 2, 3]) AS model_no)),
    {checked_sql('moved', 'predictions')},
    counts AS (SELECT model, item_id, count(*) AS extracted_count,
      count(*) FILTER (validation_status = 'valid') AS valid_count FROM predictions GROUP BY ALL),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, item_id
      ORDER BY computed_score DESC, evidence_id) AS rn FROM predictions
      WHERE validation_status = 'valid') WHERE rn = 1),
    paired AS (SELECT m.model, i.*, coalesce(b.candidate_sdgs, []) AS predicted_sdgs,
      coalesce(b.evidence_tags, []) AS predicted_tags,
      coalesce(b.implementation_stage, '') AS predicted_stage,
      coalesce(b.quantitative_support, false) AS predicted_quant,
      coalesce(b.oversight_support, false) AS predicted_oversight,
      b.item_id IS NOT NULL AS predicted_valid, coalesce(b.evidence_text, '') AS predicted_text,
      coalesce(c.extracted_count, 0) AS extracted_count, coalesce(c.valid_count, 0) AS valid_count
      FROM items i CROSS JOIN (SELECT unnest(['m1', 'm2', 'm3']) AS model) m
      LEFT JOIN best b ON b.model = m.model AND b.item_id = i.item_id
      LEFT JOIN counts c ON c.model = m.model AND c.item_id = i.item_id)"""
)


def _jaccard(a, b):
    union = f"len(list_distinct({a} || {b}))"
    return (
        f"CASE WHEN {union} = 0 THEN 1.0::DOUBLE "
        f"ELSE len(list_distinct(list_intersect({a}, {b})))::DOUBLE / {union} END"
    )


RESULTS_SQL = (
    PREDICTIONS_SQL
    + f""", results AS (SELECT *, {_jaccard('predicted_sdgs', 'expected_sdgs')} AS sdg_jaccard,
      {_jaccard('predicted_tags', 'expected_tags')} AS tag_jaccard,
      predicted_stage = expected_stage AS stage_exact,
      predicted_stage <> '' AND expected_stage <> '' AND
        CASE predicted_stage {_ORDER} ELSE -1 END > CASE expected_stage {_ORDER} ELSE -1 END
        AS stage_overclaim,
      predicted_quant = expected_quant AS quant_exact,
      predicted_oversight = expected_oversight AS oversight_exact,
      predicted_valid = expected_valid AS validation_correct,
      predicted_quant AND NOT regexp_matches(predicted_text,
        '\\b\\d[\\d,.]*\\s*(%|tonne|mt|gwh|mwh|kwh|m[³3]|kg|litres?|l\\b)') AS quant_overclaim,
      predicted_oversight AND NOT regexp_matches(predicted_text,
        '(?i)\\b(board|committee|executive|ceo|cfo|director|oversight|audit|governance)\\b')
        AS oversight_overclaim FROM paired)"""
)
AGGREGATE_SQL = (
    RESULTS_SQL
    + """, aggregates AS (SELECT model, count(*) AS n, round(avg(sdg_jaccard), 9) AS sdg_jaccard_mean,
      round(avg(tag_jaccard), 9) AS tag_jaccard_mean,
      avg(CAST(stage_exact AS INT)) AS stage_exact_rate,
      avg(CAST(stage_overclaim AS INT)) AS stage_overclaim_rate,
      avg(CAST(quant_exact AS INT)) AS quant_exact_rate,
      avg(CAST(oversight_exact AS INT)) AS oversight_exact_rate,
      avg(CAST(validation_correct AS INT)) AS validation_accuracy,
      avg(CAST(stage_overclaim OR quant_overclaim OR oversight_overclaim AS INT))
        AS over_claim_rate FROM results GROUP BY model)"""
)
_METRICS = (
    "sdg_jaccard_mean", "tag_jaccard_mean", "stage_exact_rate", "stage_overclaim_rate",
    "quant_exact_rate", "oversight_exact_rate", "validation_accuracy", "over_claim_rate",
)
_ROUNDED = ", ".join(f"CAST(printf('%.3f', {c}) AS DOUBLE) AS {c}" for c in _METRICS)
PUBLISHED_SQL = AGGREGATE_SQL + f", published AS (SELECT model, n, {_ROUNDED} FROM aggregates)"
SCORE_SQL = (
    "CAST(printf('%.4f', (1 - over_claim_rate) * 2 + sdg_jaccard_mean + tag_jaccard_mean "
    "+ stage_exact_rate + quant_exact_rate + oversight_exact_rate) AS DOUBLE)"
)


def aggregates(t):
    return evaluation.aggregate_metrics(t.results()).withColumns(
        {c: F.round(c, 9) for c in ("sdg_jaccard_mean", "tag_jaccard_mean")}
    )


@register(
    "models_best_predictions",
    PREDICTIONS_SQL
    + """ SELECT c.model, c.item_id, c.extracted_count, c.valid_count,
    array_to_string(b.candidate_sdgs, ',') AS sdgs, b.implementation_stage AS stage,
    b.computed_score AS score FROM counts c LEFT JOIN best b USING (model, item_id)""",
)
def models_best_predictions(t):
    return evaluation.best_predictions(t.predictions()).select(
        "model", "item_id", "extracted_count", "valid_count",
        F.array_join("best.candidate_sdgs", ",").alias("sdgs"),
        F.col("best.implementation_stage").alias("stage"),
        F.col("best.computed_score").alias("score"),
    )


@register(
    "models_item_results",
    RESULTS_SQL
    + """ SELECT model, item_id, extracted_count, valid_count, predicted_valid, sdg_jaccard,
    tag_jaccard, stage_exact, stage_overclaim, quant_exact, oversight_exact, validation_correct,
    quant_overclaim, oversight_overclaim, predicted_text AS text_preview FROM results""",
)
def models_item_results(t):
    return t.results().select(
        "model", "item_id", "extracted_count", "valid_count", "predicted_valid", "sdg_jaccard",
        "tag_jaccard", "stage_exact", "stage_overclaim", "quant_exact", "oversight_exact",
        "validation_correct", "quant_overclaim", "oversight_overclaim",
        preview("predicted_text", 100).alias("text_preview"),
    )


@register("models_aggregate", AGGREGATE_SQL + " SELECT * FROM aggregates")
def models_aggregate(t):
    return aggregates(t)


@register(
    "models_rounded_metrics",
    PUBLISHED_SQL + " SELECT * FROM published",
)
def models_rounded_metrics(t):
    return evaluation.rounded_metrics(aggregates(t))


@register(
    "models_ranking",
    PUBLISHED_SQL
    + f""" SELECT combo_key, selection_score, rank, rank = 1 AS recommended
    FROM (SELECT *, row_number() OVER (ORDER BY selection_score DESC, model, embedding_no) AS rank
      FROM (SELECT *, model || '+' || embedding_model AS combo_key, {SCORE_SQL} AS selection_score
        FROM published, (SELECT unnest(['e1', 'e2']) AS embedding_model,
          unnest([0, 1]) AS embedding_no)))""",
)
def models_ranking(t):
    combos = evaluation.model_combinations(aggregates(t), ["e1", "e2"])
    return evaluation.rank_models(combos, ["model", "embedding_no"]).select(
        "combo_key", "selection_score", F.col("rank").cast("bigint").alias("rank"), "recommended"
    )


@register(
    "models_runtime",
    RESULTS_SQL
    + """ SELECT model, CAST(sum(extracted_count * 2) AS BIGINT) AS total_runtime_seconds,
    avg(extracted_count * 2) AS avg_item_runtime_seconds,
    CAST(sum(extracted_count) AS BIGINT) AS extracted_evidence_count,
    CAST(sum(valid_count) AS BIGINT) AS valid_evidence_count FROM results GROUP BY model""",
)
def models_runtime(t):
    timed = t.results().withColumn("runtime_seconds", F.col("extracted_count") * 2)
    return evaluation.runtime_totals(timed)


@register(
    "models_goal_f1",
    RESULTS_SQL
    + """, s AS (SELECT model, company,
      CAST(sum(len(list_distinct(list_intersect(predicted_sdgs, expected_sdgs)))) AS BIGINT) AS tp,
      CAST(sum(len(list_distinct(predicted_sdgs))) AS BIGINT) AS np,
      CAST(sum(len(list_distinct(expected_sdgs))) AS BIGINT) AS ne,
      count(*) FILTER (predicted_valid) AS pv,
      count(*) FILTER (predicted_valid AND expected_valid) AS cv FROM results GROUP BY ALL)
    SELECT model, company, tp, np - tp AS fp, ne - tp AS fn,
    CASE WHEN np + ne > 0 THEN 2.0::DOUBLE * tp / (np + ne) END AS sdg_f1,
    CASE WHEN pv > 0 THEN cv::DOUBLE / pv END AS valid_precision FROM s""",
)
def models_goal_f1(t):
    return evaluation.goal_f1(t.results(), ["model", "company"]).drop(
        "n_predicted_valid", "n_correct_valid"
    )


@register(
    "models_agreement",
    RESULTS_SQL
    + f""", r AS (SELECT *, stage_overclaim OR quant_overclaim OR oversight_overclaim AS o FROM results)
    SELECT company, count(*) AS n_items, round(avg({_jaccard('ap', 'bp')}), 9) AS sdg_agreement,
    avg(CAST(astage = bstage AS INT)) AS stage_agreement,
    abs(avg(CAST(ao AS INT)) - avg(CAST(bo AS INT))) AS overclaim_difference FROM (
      SELECT a.company, a.predicted_sdgs AS ap, b.predicted_sdgs AS bp, a.predicted_stage AS astage,
      b.predicted_stage AS bstage, a.o AS ao, b.o AS bo FROM r a JOIN r b USING (item_id)
      WHERE a.model = 'm1' AND b.model = 'm2') GROUP BY company""",
)
def models_agreement(t):
    return evaluation.model_agreement(t.results(), "m1", "m2", ["company"]).withColumn(
        "sdg_agreement", F.round("sdg_agreement", 9)
    )


@register(
    "models_ablation",
    AGGREGATE_SQL
    + """ SELECT model AS variant, metric, value FROM (UNPIVOT (SELECT * EXCLUDE (n) FROM aggregates)
    ON COLUMNS(* EXCLUDE (model)) INTO NAME metric VALUE value)""",
)
def models_ablation(t):
    table = evaluation.ablation_table(t.results().withColumnRenamed("model", "variant"))
    jaccard = F.col("metric").contains("jaccard")
    return table.withColumn(
        "value", F.when(jaccard, F.round("value", 9)).otherwise(F.col("value"))
    )


@register(
    "models_company_rates",
    RESULTS_SQL
    + """ SELECT company, model, count(*) AS n, avg(CAST(stage_exact AS INT)) AS stage_exact_rate,
    avg(CAST(stage_overclaim OR quant_overclaim OR oversight_overclaim AS INT)) AS over_claim_rate
    FROM results GROUP BY ALL""",
)
def models_company_rates(t):
    return evaluation.aggregate_metrics(t.results(), ["company", "model"]).select(
        "company", "model", "n", "stage_exact_rate", "over_claim_rate"
    )


@register(
    "models_recall_curve",
    SIMILAR_SQL
    + """, rk AS (SELECT query_id, doc_id, label, row_number() OVER (PARTITION BY query_id
      ORDER BY round(similarity, 9) DESC, doc_id) AS rank FROM sims),
    k AS (SELECT unnest([1, 3, 5, 10]) AS k)
    SELECT query_id, k, count(*) FILTER (rank <= k AND label = query_id)::DOUBLE
      / count(*) FILTER (label = query_id) AS recall FROM rk, k GROUP BY ALL""",
)
def models_recall_curve(t):
    ranked = first_n(
        similarities(t).withColumn("s", F.round("similarity", 9)),
        ["query_id"],
        [F.col("s").desc(), F.col("doc_id")],
        max(evaluation.RECALL_CUTS),
        "rank",
    )
    relevant = t.vectors().select(F.col("label").alias("query_id"), "doc_id")
    return evaluation.recall_curve(ranked, relevant)
