"""Findings, evaluation, tables, networks, trends and panel on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.operators import (
    evaluation,
    findings,
    networks,
    observatory,
    panel,
    scoring,
    trends,
)
from attesta.params import PeriodParams


@pytest.fixture(scope="module")
def scored(make_records):
    mk = lambda n, goals, tags, stage, page, **kw: {
        "evidence_id": n, "candidate_sdgs": goals, "evidence_tags": tags,
        "implementation_stage": stage, "page_number": page, "validation_status": "valid", **kw,
    }
    rows = {
        "a": mk("a", ["SDG 2", "SDG 10"], ["kpi", "target"], k.PLANNED, 3),
        "b": mk("b", ["SDG 2", "SDG 2"], ["policy"], k.PLANNED, 9),
        "c": mk("c", ["SDG 2"], ["target", "policy"], k.MENTION, 3),
        "d": mk("d", ["SDG 10", "SDG 13"], ["aspiration"], k.MENTION, 5, report_year=2022),
    }
    return scoring.score(make_records(rows))


def test_goal_summary_details(scored):
    got = {(r.report_year, r.sdg): r for r in findings.goal_summaries(scored).collect()}
    two = got[(2020, "SDG 2")]
    assert two.evidence_count == 4  # b lists the goal twice
    assert two.average_score == round((4 + 3 + 3 + 3) / 4, 2)
    assert two.strongest_pages == [3, 9]
    assert two.implementation_profile == "planned (75% of items)"
    assert two.summary.endswith("Average score: 3.25/10. Key evidence types: policy, target, kpi.")
    assert got[(2022, "SDG 13")].implementation_profile == "mentions_only"
    assert got[(2022, "SDG 13")].summary.endswith("Average score: 1/10. Key evidence types: aspiration.")


def test_goal_numbers(spark):
    df = spark.createDataFrame([("SDG 7",), ("SDG13",), ("other",)], "sdg string")
    assert [r[0] for r in df.select(findings.goal_number()).collect()] == [7, 13, 99]


def test_assessment_tiers(spark, make_records):
    tiers = {
        "measured": {"implementation_stage": k.MEASURABLE, "quantitative_support": True},
        "claimed": {"implementation_stage": k.MEASURABLE},
        "active": {"implementation_stage": k.IN_PROGRESS},
        "committed": {"evidence_tags": ["governance"]},
        "symbolic": {"evidence_tags": ["aspiration"]},
    }
    records = make_records({c: {"company": c, **over} for c, over in tiers.items()})
    reports = spark.createDataFrame([(c, 2020) for c in [*tiers, "empty"]], "company string, report_year int")
    got = {r.company: r.overall_assessment for r in
           findings.overall_assessment(records, reports).collect()}
    assert got == {
        "measured": "measurable_implementation_evidence", "claimed": "symbolic_alignment_only",
        "active": "implementation_in_progress", "committed": "strategic_commitment_present",
        "symbolic": "symbolic_alignment_only", "empty": "no_evidence_found",
    }


def test_pairs_with_and_without_repeats(scored):
    once = {(r.source, r.target): r.n for r in networks.goal_pairs(scored).collect()}
    assert once == {("SDG 10", "SDG 2"): 1, ("SDG 10", "SDG 13"): 1}
    repeated = {(r.source, r.target): r.n for r in networks.goal_pairs(scored, dedupe=False).collect()}
    assert repeated == {**once, ("SDG 2", "SDG 2"): 1}


def test_pairs_of_all_goals(make_records):
    full = make_records({"x": {"candidate_sdgs": k.GOALS}})
    assert networks.goal_pairs(full).count() == 136


def test_difference_equals_full_outer_join(scored):
    period = PeriodParams(cut_year=2021)
    long = observatory.long_table(observatory.wide_table(scored, params=period))
    tagged = long.withColumn("tag", F.explode("evidence_tags"))

    def side(p, name):
        return tagged.filter(F.col("period") == p).groupBy("sdg", "tag").agg(
            F.avg("computed_score").alias(name)
        )

    joined = side("before", "x").join(side("after", "y"), ["sdg", "tag"], "full_outer").fillna(0.0)
    expected = {(r.sdg, r.tag): r.y - r.x for r in joined.collect() if abs(r.y - r.x) > 0.5}
    got = {(r.sdg, r.tag): r.delta for r in networks.difference_edges(long, "before", "after").collect()}
    assert got == expected and got


def test_leaders_keep_ties(spark):
    rows = [("a", "SDG 1", 4), ("b", "SDG 1", 4), ("c", "SDG 1", 1), ("c", "SDG 2", 2)]
    long = spark.createDataFrame(rows, "company string, sdg string, computed_score int")
    got = {(r.sdg, r.company) for r in observatory.goal_leaders(long).collect()}
    assert got == {("SDG 1", "a"), ("SDG 1", "b"), ("SDG 2", "c")}


def test_status_words(spark):
    df = spark.createDataFrame(
        [(c,) for c in [*k.ASSESSMENT_LABELS, None]], "a string"
    ).select("a", observatory.status_from_label(F.col("a")).alias("l"),
             observatory.status_from_assessment(F.col("a")).alias("m"))
    got = {r.a: (r.l, r.m) for r in df.collect()}
    assert {v[0] for a, v in got.items() if a} == {"Partial"}
    assert [got[a][1] for a in k.ASSESSMENT_LABELS] == [
        "Strong", "Moderate", "Moderate", "Partial", "No evidence",
    ]
    assert got[None] == ("No data", "No data")


def test_empty_report_has_no_rate(spark, scored):
    reports = spark.createDataFrame([("acme", 2020), ("acme", 2019)], "company string, report_year int")
    runs = observatory.run_table(reports, scored, scored.filter("false"))
    got = {r.report_year: (r.n_valid, r.n_rejected, r.rejection_rate) for r in runs.collect()}
    assert got == {2020: (3, 0, 0.0), 2019: (0, 0, None)}


def test_overclaim_patterns(spark):
    rows = [
        ("saved 5 GWh", True), ("saved 5 gwh", False), ("saved 5%", False), ("5 m³ of it", False),
        ("10 litres", False), ("none", True), ("2 l", False), ("2 lm", True),
    ]
    df = spark.createDataFrame(rows, "t string, x boolean")
    for r in df.select("t", "x", evaluation.quant_overclaim(F.col("t"), F.lit(True)).alias("o")).collect():
        assert r.o == r.x, r.t
    over = spark.createDataFrame(
        [("the BOARD met", False), ("boarding", True), (None, True)], "t string, x boolean"
    ).select("x", evaluation.oversight_overclaim(F.col("t"), F.lit(True)).alias("o"))
    assert all(r.o == r.x for r in over.collect())


def test_stage_overclaim(spark):
    rows = [
        (k.PLANNED, k.MENTION, True), (k.MENTION, k.PLANNED, False), (k.MENTION, "odd", True),
        ("odd", k.MENTION, False), ("", k.MENTION, False), (k.MEASURABLE, "", False),
    ]
    df = spark.createDataFrame(rows, "p string, e string, x boolean")
    got = df.select("x", evaluation.stage_overclaim(F.col("p"), F.col("e")).alias("o")).collect()
    assert all(r.o == r.x for r in got)


def test_recall_curve(spark):
    ranked = spark.createDataFrame(
        [("q", d, i + 1) for i, d in enumerate("abcdef")] + [("none", "a", 1)],
        "query_id string, doc_id string, rank int",
    )
    relevant = spark.createDataFrame(
        [("q", "a"), ("q", "d"), ("q", "z"), ("q", "a"), ("lost", "a")], "query_id string, doc_id string"
    )
    got = {(r.query_id, r.k): r.recall for r in evaluation.recall_curve(ranked, relevant).collect()}
    assert [got[("q", c)] for c in (1, 3, 5, 10)] == [1 / 3, 1 / 3, 2 / 3, 2 / 3]
    assert got[("none", 1)] == 1.0 and got[("lost", 10)] == 0.0


def test_missing_prediction_counts_as_empty(spark, scored):
    items = spark.createDataFrame(
        [("i", ["SDG 1"], [], "", False, False, False)],
        "item_id string, expected_sdgs array<string>, expected_evidence_tags array<string>,"
        "expected_implementation_stage string, expected_quantitative_support boolean,"
        "expected_oversight_support boolean, expected_valid boolean",
    )
    none = scored.withColumns(
        {"model": F.lit("m"), "item_id": F.lit("other"), "seq": F.col("evidence_id")}
    )
    row = evaluation.evaluate_items(items, evaluation.best_predictions(none), ["m"]).first()
    assert (row.sdg_jaccard, row.tag_jaccard, row.stage_exact, row.validation_correct) == (
        0.0, 1.0, True, True,
    )
    assert (row.extracted_count, row.stage_overclaim) == (0, False)


# --- trend breaks -----------------------------------------------------------------


def least_squares(years, y, cut):
    t = np.array(years) - min(years)
    post = (np.array(years) > cut).astype(float)
    x = np.column_stack([np.ones(len(t)), t, post, t * post])
    beta, *_ = np.linalg.lstsq(x, np.array(y), rcond=None)
    return beta, x @ beta


def series_of(spark, data):
    rows = [(c, int(y), float(v)) for c, (ys, vs) in data.items() for y, v in zip(ys, vs)]
    return spark.createDataFrame(rows, "company string, report_year int, maturity_index double")


def test_trend_breaks_against_least_squares(spark):
    rng = np.random.default_rng(4)
    data = {
        "full": (range(2016, 2026), rng.uniform(0, 1, 10)),
        "gaps": ([2016, 2019, 2020, 2022, 2023, 2025], rng.uniform(0, 1, 6)),
        "one_pre": ([2020, 2022, 2023, 2024, 2025], rng.uniform(0, 1, 5)),
        "one_post": ([2016, 2017, 2018, 2020, 2022], rng.uniform(0, 1, 5)),
        "all_pre": (range(2010, 2016), rng.uniform(0, 1, 6)),
        "all_post": (range(2022, 2028), rng.uniform(0, 1, 6)),
        "short": ([2020, 2021, 2022, 2023], rng.uniform(0, 1, 4)),
    }
    series = series_of(spark, data)
    fit = trends.trend_breaks(series, 2021)
    got = {r.company: r for r in fit.collect()}
    assert set(got) == set(data) - {"short"}
    for name in ("full", "gaps"):
        beta, _ = least_squares(list(data[name][0]), data[name][1], 2021)
        r = got[name]
        assert np.allclose([r.level, r.slope, r.level_change, r.slope_change], beta)
    one = got["one_pre"]
    assert one.level == pytest.approx(data["one_pre"][1][0]) and one.slope_change is None
    assert got["one_post"].slope_change is None and got["one_post"].level_change is not None
    for name in ("all_pre", "all_post"):
        assert (got[name].level_change, got[name].slope_change) == (None, None)
    fitted = {}
    for r in trends.fitted_breaks(series, fit, 2021).collect():
        fitted.setdefault(r.company, {})[r.report_year] = r.fitted
    for name in got:
        years = list(data[name][0])
        _, expected = least_squares(years, data[name][1], 2021)
        assert np.allclose([fitted[name][y] for y in years], expected), name


def test_score_drops_use_reported_years(spark):
    rows = [("a", "SDG 1", 2019, 6.0), ("a", "SDG 1", 2022, 4.0), ("a", "SDG 1", 2023, 3.0)]
    df = spark.createDataFrame(rows, "company string, sdg string, report_year int, average_score double")
    got = trends.score_drops(df).collect()
    assert [(r.report_year, r.previous_score, r.drop) for r in got] == [(2022, 6.0, -2.0)]


def test_persistent_goals(spark):
    rows = [("a", "SDG 2", y) for y in (1, 2, 3)] + [("a", "SDG 10", 1)] * 9 + [("a", "SDG 3", 1)]
    df = spark.createDataFrame(rows, "company string, sdg string, report_year int")
    assert trends.persistent_goals(df, 2).first().persistent_sdgs == "SDG 2, SDG 10"
    assert trends.dominant_goals(df, 2).first().dominant_sdgs == "SDG 10, SDG 2"


# --- panel ------------------------------------------------------------------------


def test_profiles(spark):
    a = [45.0, 40.0] + [15.0 / 15] * 15
    b = [95.0] + [5.0 / 16] * 16
    rows = [(n, f"SDG{i}", s) for n, p in (("a", a), ("b", b)) for i, s in enumerate(p)]
    rows += [("short", "SDG1", 100.0), ("off", "x", 50.0), ("off", "y", 49.0)]
    rows += [("zero", "x", 100.0), ("zero", "y", 0.0)]
    df = spark.createDataFrame(rows, "scenario string, category string, score double")
    metrics = panel.profile_metrics(df, ["scenario"])
    got = {r.scenario: r for r in panel.usable_profiles(metrics).collect()}
    assert set(got) == {"a", "b", "zero"}
    for name, p in (("a", a), ("b", b)):
        s = np.array(p) / 100
        assert got[name].hhi == pytest.approx((s**2).sum())
        assert got[name].entropy == pytest.approx(-(s * np.log(s)).sum())
        assert got[name].dominant_score == p[0] and got[name].top2_score == p[0] + p[1]
        assert got[name].dominant_category == "SDG0"
    assert got["zero"].entropy == 0.0
    bad = {r.scenario: r.reason for r in panel.rejected_profiles(metrics).collect()}
    assert bad == {"short": "fewer than two categories", "off": "scores do not sum to 100"}


def test_zero_variance_is_an_error(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "entity int, size int")
    with pytest.raises(Exception, match="zero variance"):
        panel.standardise_log(df, "size", "z").collect()


def test_variance_inflation(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3))
    x = np.column_stack([x, x[:, 0] + 0.3 * x[:, 1] + 0.2 * rng.normal(size=400)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    got = {r.term: r.vif for r in panel.variance_inflation(df, ["a", "b", "c", "d"]).collect()}
    for i, name in enumerate("abcd"):
        others = np.column_stack([np.ones(400), np.delete(x, i, axis=1)])
        beta, *_ = np.linalg.lstsq(others, x[:, i], rcond=None)
        rest = x[:, i] - others @ beta
        r2 = 1 - rest @ rest / ((x[:, i] - x[:, i].mean()) ** 2).sum()
        assert got[name] == pytest.approx(1 / (1 - r2))


def test_histogram(spark):
    values = [0.0, 0.0, 5.0, 10.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.bin: (r.centre, r.n) for r in panel.histogram(df, "v", 11).collect()}
    assert got == {0: (0.0, 2), 5: (5.0, 1), 9: (9.0, 1), 10: (10.0, 1)}
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r.bin, r.n) for r in panel.histogram(same, "v").collect()] == [(0, 2)]


def test_minimum_observations(spark):
    panel_rows = spark.createDataFrame(
        [("a", 2022, "s", 1.0), ("b", 2020, "s", 2.0), ("b", 2021, "s", 2.0)],
        "entity string, year int, sector string, hhi double",
    )
    entities = spark.createDataFrame([("a", "s"), ("b", "s")], "entity string, sector string")
    got = sorted(
        (r.entity, r.year, r.hhi)
        for r in panel.ensure_observations(panel_rows, entities, "entity", [2022, 2023]).collect()
    )
    assert got == [("a", 2022, 1.0), ("a", 2023, None), ("b", 2020, 2.0), ("b", 2021, 2.0)]


def test_sample_is_repeatable(spark):
    df = spark.range(300).select((F.col("id") % 50).alias("entity"), "id")
    one = sorted(r.id for r in panel.sample_entities(df, "entity", 6, 1).collect())
    two = sorted(r.id for r in panel.sample_entities(df.repartition(9), "entity", 6, 1).collect())
    assert one == two and len({i % 50 for i in one}) == 6 and len(one) == 36


def test_ranking_ties_after_rounding(spark):
    names = ["model", "n", "sdg_jaccard_mean", "tag_jaccard_mean", "stage_exact_rate", "stage_overclaim_rate",
             "quant_exact_rate", "oversight_exact_rate", "validation_accuracy", "over_claim_rate"]
    rows = [("b", 10, 0.5004, *[0.5] * 7), ("a", 10, 0.5001, *[0.5] * 7), ("c", 10, 0.51, *[0.5] * 7)]
    schema = ", ".join(f"{n} {'string' if n == 'model' else 'bigint' if n == 'n' else 'double'}" for n in names)
    ranked = evaluation.rank_models(spark.createDataFrame(rows, schema), ["model"]).orderBy("rank").collect()
    assert [(r.model, r.selection_score, r.recommended) for r in ranked] == [
        ("c", 3.51, True), ("a", 3.5, False), ("b", 3.5, False)]


def test_items_without_predictions_of_a_model(spark):
    """Every model has a row for every item, also one that it gave nothing for."""
    items = spark.sql(
        "SELECT id AS item_id, array('SDG 1') AS expected_sdgs, array('policy') AS expected_evidence_tags,"
        " 'planned_action' AS expected_implementation_stage, false AS expected_quantitative_support,"
        " false AS expected_oversight_support, true AS expected_valid FROM VALUES (1L), (2L), (NULL) AS v(id)"
    )
    scored = spark.sql(
        "SELECT model, id AS item_id, id AS seq, 'valid' AS validation_status, array('SDG 1') AS candidate_sdgs,"
        " array('policy') AS evidence_tags, 'planned_action' AS implementation_stage, false AS quantitative_support,"
        " false AS oversight_support, 't' AS evidence_text, 3 AS computed_score"
        " FROM VALUES ('a', 1L), ('b', 1L), ('b', 2L), ('b', NULL) AS v(model, id)"
    )
    results = evaluation.evaluate_items(items, evaluation.best_predictions(scored), ["a", "b", "c"])
    got = {(r.model, r.item_id): (r.predicted_valid, r.extracted_count) for r in results.collect()}
    found = {("a", 1), ("b", 1), ("b", 2)}
    assert got == {(m, i): ((m, i) in found, int((m, i) in found)) for m in "abc" for i in (1, 2, None)}


def test_evaluation_moves_lines_by_order_only(spark):
    """Predictions of all models are grouped and joined where the order join left them."""
    from attesta.plans.driver_tables import Tables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results = Tables(spark, "/root/testdata/sf0.001").results()
        plan = results._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = {key.split("#")[0] for key in plan.split("Exchange hashpartitioning(")[1:]}
    assert moved == {"l_orderkey", "o_orderkey", "o_custkey", "c_custkey", "c_nationkey", "n_nationkey"}


def test_goal_summaries_read_the_records_once(spark):
    """Measures, pages and tags share one stored copy of the records' columns."""
    from attesta.plans.driver_tables import Tables

    summaries = findings.goal_summaries(Tables(spark, "/root/testdata/sf0.001").scored())
    assert "lineitem" not in summaries._jdf.queryExecution().executedPlan().toString()


def test_predictions_lie_in_tasks_of_bounded_size(spark, monkeypatch):
    """What is sorted by item does not grow with the table: more lines, more tasks."""
    from attesta.plans import driver_tables

    monkeypatch.setattr(driver_tables, "LINES_PER_TASK", 100, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        predictions = driver_tables.Tables(spark, "/root/testdata/sf0.001").predictions()
        largest = predictions.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert largest <= 3 * 100 * len(driver_tables.MODELS)
