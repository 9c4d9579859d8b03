"""Tables and networks across companies and years."""

from pyspark.sql import functions as F

from attesta import constants as k
from attesta.operators import networks, observatory
from attesta.plans.catalog import register
from attesta.plans.catalog.records import ASSESSMENT_SQL, GOAL_MEASURES_SQL
from attesta.plans.driver_tables import (
    ALL_SCORED_SQL,
    CUT_YEAR,
    LONG_SQL,
    PERIOD,
    RUNS_SQL,
    SCORED_SQL,
)
from attesta.operators import findings

_PERIOD = f"CASE WHEN report_year <= {CUT_YEAR} THEN 'before' ELSE 'after' END"
_STRENGTH = "CASE computed_strength WHEN 'weak' THEN 1 WHEN 'moderate' THEN 2 WHEN 'strong' THEN 3 END"


@register(
    "table_wide",
    SCORED_SQL
    + f""" SELECT evidence_id, company, report_year, computed_score, stage_rank,
    {_STRENGTH} AS strength_rank, period FROM scored""",
)
def table_wide(t):
    return t.wide().select(
        "evidence_id", "company", "report_year", "computed_score", "stage_rank", "strength_rank",
        "period",
    )


@register("table_long", LONG_SQL + " SELECT evidence_id, sdg, sdg_num, computed_score FROM long")
def table_long(t):
    return t.long().select("evidence_id", "sdg", "sdg_num", "computed_score")


@register(
    "table_rejected",
    SCORED_SQL
    + """ SELECT evidence_id, company, report_year, page_number, evidence_text,
    implementation_stage, array_to_string(validation_errors, ', ') AS validation_errors
    FROM rejected""",
)
def table_rejected(t):
    table = observatory.rejected_table(t.rejected()).drop("computed_score")
    return table.withColumn("validation_errors", F.array_join("validation_errors", ", "))


def goal_years(t):
    return observatory.goal_year_table(findings.goal_measures(t.scored()), PERIOD)


@register(
    "table_goal_year",
    GOAL_MEASURES_SQL
    + f""" SELECT company, report_year, sdg, CAST(substr(sdg, 5) AS INT) AS sdg_num, evidence_count,
    average_score, implementation_profile, {_PERIOD} AS period FROM profiles""",
)
def table_goal_year(t):
    return goal_years(t).select(
        "company", "report_year", "sdg", "sdg_num", "evidence_count", "average_score",
        "implementation_profile", "period",
    )


@register(
    "table_runs",
    RUNS_SQL + " SELECT company, report_year, n_valid, n_rejected, rejection_rate FROM runs",
)
def table_runs(t):
    return t.runs().drop("report_name")


@register(
    "table_company_totals",
    RUNS_SQL
    + """ SELECT initcap_company AS company, n_reports, n_valid, n_rejected, n_goals FROM (
    SELECT upper(substr(r.company, 1, 1)) || lower(substr(r.company, 2)) AS initcap_company,
      count(*) AS n_reports, CAST(sum(n_valid) AS BIGINT) AS n_valid,
      CAST(sum(n_rejected) AS BIGINT) AS n_rejected,
      coalesce(any_value(g.n), 0) AS n_goals FROM runs r LEFT JOIN
      (SELECT company, count(DISTINCT sdg) AS n FROM long GROUP BY 1) g USING (company) GROUP BY 1
    UNION ALL SELECT 'Total', count(*), CAST(sum(n_valid) AS BIGINT),
      CAST(sum(n_rejected) AS BIGINT), (SELECT count(DISTINCT sdg) FROM long) FROM runs)""",
)
def table_company_totals(t):
    return observatory.company_totals(t.runs(), t.long()).drop("is_total")


@register(
    "table_yearly_counts",
    RUNS_SQL
    + """ SELECT upper(substr(company, 1, 1)) || lower(substr(company, 2)) AS company, report_year,
    CAST(sum(n_valid) AS BIGINT) AS n_valid, CAST(sum(n_rejected) AS BIGINT) AS n_rejected
    FROM runs GROUP BY 1, 2""",
)
def table_yearly_counts(t):
    return observatory.yearly_counts(t.runs())


@register(
    "table_load_audit",
    SCORED_SQL
    + """ SELECT (SELECT count(*) FROM scored) AS n_valid, (SELECT count(*) FROM rejected) AS n_rejected,
    (SELECT count(DISTINCT report_year) FROM scored) AS n_years,
    (SELECT count(DISTINCT company) FROM scored) AS n_companies""",
)
def table_load_audit(t):
    return observatory.load_audit(t.validated())


@register(
    "table_quality_audit",
    RUNS_SQL
    + """ SELECT company, report_year, report_name, n_valid, n_rejected,
    CASE WHEN n_valid + n_rejected > 0 THEN n_valid::DOUBLE / (n_valid + n_rejected) END
      AS pass_rate,
    CASE WHEN n_valid + n_rejected > 0 THEN CAST(round_even(
      100 * (n_valid::DOUBLE / (n_valid + n_rejected)), 0) AS INT) || '%' END AS pass_text FROM runs""",
)
def table_quality_audit(t):
    return observatory.quality_audit(t.runs()).drop("rejection_rate")


@register(
    "table_calibration",
    SCORED_SQL
    + """ SELECT company, count(*) AS n, round(regr_slope(computed_score, confidence), 6) AS slope,
    round(regr_intercept(computed_score, confidence), 6) AS intercept,
    round(corr(computed_score, confidence), 6) AS correlation,
    round(regr_r2(computed_score, confidence), 6) AS r2,
    round(sqrt(greatest(0, regr_syy(computed_score, confidence) - regr_sxy(computed_score, confidence)
      ** 2 / regr_sxx(computed_score, confidence)) / (count(*) - 2)), 6) AS residual_se
    FROM scored GROUP BY company""",
)
def table_calibration(t):
    fit = observatory.calibration(t.wide(), ["company"])
    return fit.select(
        "company",
        "n",
        *[
            F.round(c, 6).alias(c)
            for c in ("slope", "intercept", "correlation", "r2", "residual_se")
        ],
    )


@register(
    "table_calibration_band",
    SCORED_SQL
    + """, f AS (SELECT company, count(*) AS n, regr_slope(computed_score, confidence) AS b,
      regr_intercept(computed_score, confidence) AS a, regr_sxx(computed_score, confidence) AS sxx,
      regr_syy(computed_score, confidence) AS syy, regr_sxy(computed_score, confidence) AS sxy,
      avg(confidence) AS mx FROM scored GROUP BY company),
    x AS (SELECT *, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS se,
      unnest([0.0, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) AS confidence FROM f)
    SELECT company, confidence, round(a + b * confidence, 6) AS fitted,
    round(a + b * confidence - 1.96 * se * sqrt(1.0 / n + (confidence - mx) ** 2 / sxx), 6) AS lower,
    round(a + b * confidence + 1.96 * se * sqrt(1.0 / n + (confidence - mx) ** 2 / sxx), 6) AS upper
    FROM x""",
)
def table_calibration_band(t):
    fit = observatory.calibration(t.wide(), ["company"])
    band = observatory.calibration_band(fit, [0.0, 0.25, 0.5, 0.75, 1.0])
    return band.select(
        "company", "confidence", *[F.round(c, 6).alias(c) for c in ("fitted", "lower", "upper")]
    )


@register(
    "table_tag_stage_counts",
    LONG_SQL
    + """ SELECT tag, implementation_stage, count(*) AS n FROM (
    SELECT implementation_stage, unnest(evidence_tags) AS tag FROM long) GROUP BY ALL""",
)
def table_tag_stage_counts(t):
    return observatory.tag_stage_counts(t.long())


@register(
    "table_tag_stage_matrix",
    LONG_SQL
    + " SELECT tag, "
    + ", ".join(f"count(*) FILTER (implementation_stage = '{s}') AS {s}" for s in k.STAGES)
    + " FROM (SELECT implementation_stage, unnest(evidence_tags) AS tag FROM long) GROUP BY tag",
)
def table_tag_stage_matrix(t):
    return observatory.tag_stage_matrix(t.long())


@register(
    "table_goal_year_heatmap",
    GOAL_MEASURES_SQL
    + """ SELECT company, report_year, sdg, CAST(substr(sdg, 5) AS INT) AS sdg_num, evidence_count,
    average_score, implementation_profile FROM profiles""",
)
def table_goal_year_heatmap(t):
    return observatory.goal_year_heatmap(goal_years(t))


@register(
    "table_volume_trend",
    RUNS_SQL
    + """ SELECT company, report_year, n_valid, n_rejected, rejection_rate,
    round(avg(rejection_rate) OVER (PARTITION BY company), 9) AS mean_rejection_rate FROM runs""",
)
def table_volume_trend(t):
    return observatory.volume_trend(t.runs()).withColumn(
        "mean_rejection_rate", F.round("mean_rejection_rate", 9)
    )


@register(
    "table_stage_shares_year",
    SCORED_SQL
    + """ SELECT report_year, implementation_stage, count(*) AS n,
    count(*) / sum(count(*)) OVER (PARTITION BY report_year) AS pct FROM scored GROUP BY 1, 2""",
)
def table_stage_shares_year(t):
    return observatory.stage_shares(t.wide(), ["report_year"])


@register(
    "table_stage_shares_company",
    SCORED_SQL
    + """ SELECT company, implementation_stage, count(*) AS n,
    count(*) / sum(count(*)) OVER (PARTITION BY company) AS pct FROM scored GROUP BY 1, 2""",
)
def table_stage_shares_company(t):
    return observatory.stage_shares(t.wide(), ["company"])


_QUALITY = "avg(CAST(quantitative_support OR oversight_support AS INT))"
MATURITY_SQL = (
    SCORED_SQL
    + f""", maturity_parts AS (SELECT company, report_year, count(*) AS n,
      avg(computed_score) AS avg_score, avg(stage_rank) AS stage_weight_avg,
      {_QUALITY} AS quality_rate,
      avg(CAST(quantitative_support AS INT)) AS quant_rate,
      avg(CAST(oversight_support AS INT)) AS oversight_rate,
      avg(CAST(computed_strength = 'weak' AS INT)) AS pct_weak,
      avg(CAST(computed_strength = 'moderate' AS INT)) AS pct_moderate,
      avg(CAST(computed_strength = 'strong' AS INT)) AS pct_strong,
      avg(CAST(stage_rank = 1 AS INT)) AS pct_mention_only,
      avg(CAST(stage_rank = 2 AS INT)) AS pct_planned,
      avg(CAST(stage_rank = 3 AS INT)) AS pct_in_progress,
      avg(CAST(stage_rank = 4 AS INT)) AS pct_measurable,
      any_value(period) AS period FROM scored GROUP BY company, report_year),
    maturity AS (SELECT *, (avg_score / 13.0::DOUBLE) * 0.5::DOUBLE
      + (stage_weight_avg / 4) * 0.3::DOUBLE + quality_rate * 0.2::DOUBLE AS maturity_index
      FROM maturity_parts)"""
)


@register(
    "table_maturity_index",
    MATURITY_SQL + " SELECT * REPLACE (round(maturity_index, 9) AS maturity_index) FROM maturity",
)
def table_maturity_index(t):
    return observatory.maturity_index(t.wide(), period=PERIOD).withColumn(
        "maturity_index", F.round("maturity_index", 9)
    )


@register(
    "table_goal_maturity",
    LONG_SQL
    + f""" SELECT company, report_year, sdg, sdg_num, period, n, avg_score, quality_rate,
    stage_weight, round((avg_score / 13.0::DOUBLE) * 0.5::DOUBLE + (stage_weight / 4) * 0.3::DOUBLE
      + quality_rate * 0.2::DOUBLE, 9) AS sdg_maturity FROM (SELECT company, report_year, sdg,
      any_value(sdg_num) AS sdg_num, any_value(period) AS period, count(*) AS n,
      avg(computed_score) AS avg_score, {_QUALITY} AS quality_rate,
      avg(stage_rank) AS stage_weight FROM long GROUP BY company, report_year, sdg)""",
)
def table_goal_maturity(t):
    return observatory.goal_maturity(t.long(), period=PERIOD).withColumn(
        "sdg_maturity", F.round("sdg_maturity", 9)
    )


@register(
    "table_period_summary",
    SCORED_SQL
    + f""" SELECT company, period, count(*) AS n_items, avg(computed_score) AS avg_score,
    {_QUALITY} AS quality_rate, avg(CAST(quantitative_support AS INT)) AS quant_rate,
    avg(CAST(oversight_support AS INT)) AS oversight_rate,
    avg(CAST(stage_rank = 4 AS INT)) AS pct_measurable,
    avg(CAST(computed_strength = 'weak' AS INT)) AS pct_weak,
    avg(CAST(computed_strength = 'strong' AS INT)) AS pct_strong FROM scored GROUP BY 1, 2""",
)
def table_period_summary(t):
    return observatory.period_summary(t.wide())


@register(
    "table_quality_by_year",
    SCORED_SQL
    + """ SELECT company, report_year, avg(CAST(quantitative_support AS INT)) AS quant_rate,
    avg(CAST(oversight_support AS INT)) AS oversight_rate FROM scored GROUP BY 1, 2""",
)
def table_quality_by_year(t):
    return observatory.quality_by_year(t.wide())


@register(
    "table_goal_totals",
    LONG_SQL
    + """ SELECT company, sdg, count(*) AS n, avg(computed_score) AS avg_score,
    avg(CAST(quantitative_support AS INT)) AS quant_share,
    avg(CAST(computed_strength = 'strong' AS INT)) AS strong_share,
    array_to_string(list_sort(list(DISTINCT report_year)), ', ') AS years FROM long GROUP BY 1, 2""",
)
def table_goal_totals(t):
    return observatory.goal_totals(t.long())


@register(
    "table_top_evidence",
    SCORED_SQL
    + f""" SELECT company, rank, report_year, page_number, computed_score, computed_strength,
    CASE implementation_stage {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in k.STAGE_SHORT_LABELS.items())}
      END AS stage, array_to_string(candidate_sdgs, ', ') AS sdgs,
    array_to_string(evidence_tags, ', ') AS tags, evidence_text FROM (
    SELECT *, row_number() OVER (PARTITION BY company ORDER BY computed_score DESC,
      confidence DESC, seq) AS rank FROM scored) WHERE rank <= 30""",
)
def table_top_evidence(t):
    return observatory.top_evidence(t.wide()).withColumn("rank", F.col("rank").cast("bigint"))


@register(
    "table_full_evidence",
    SCORED_SQL
    + f""" SELECT evidence_id, company, report_year, page_number, computed_score, computed_strength,
    CASE implementation_stage {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in k.STAGE_TABLE_LABELS.items())}
      END AS stage, array_to_string(candidate_sdgs, ', ') AS sdgs,
    array_to_string(evidence_tags, ', ') AS tags,
    CASE WHEN quantitative_support THEN '✓' ELSE '' END AS quant,
    CASE WHEN oversight_support THEN '✓' ELSE '' END AS oversight, evidence_text FROM scored""",
)
def table_full_evidence(t):
    return observatory.full_table(t.wide())


@register(
    "table_companies",
    RUNS_SQL
    + """ SELECT company, min(report_year) || '–' || max(report_year) AS years, count(*) AS n_reports,
    CAST(sum(n_valid) AS BIGINT) AS n_valid, any_value(m.a) AS avg_score FROM runs LEFT JOIN (
      SELECT company, avg(computed_score) AS a FROM scored GROUP BY 1) m USING (company)
    GROUP BY company""",
)
def table_companies(t):
    return observatory.company_table(t.runs(), t.wide())


@register(
    "table_goal_portfolio",
    LONG_SQL
    + " SELECT company, sdg, avg(computed_score) AS avg_score, count(*) AS n FROM long GROUP BY 1, 2",
)
def table_goal_portfolio(t):
    return observatory.goal_portfolio(t.long())


@register(
    "table_company_quality",
    ALL_SCORED_SQL
    + """ SELECT company, count(*) FILTER (validation_status = 'valid') AS n_valid,
    count(*) FILTER (validation_status <> 'valid') AS n_rejected,
    avg(computed_score) AS avg_score,
    avg(CAST(computed_strength = 'strong' AS INT)) AS strong_share,
    avg(CAST(quantitative_support AS INT)) FILTER (validation_status = 'valid') AS quant_share,
    avg(CAST(oversight_support AS INT)) FILTER (validation_status = 'valid') AS oversight_share,
    count(*) FILTER (validation_status <> 'valid')::DOUBLE / count(*) AS rejection_rate
    FROM all_scored GROUP BY company""",
)
def table_company_quality(t):
    return observatory.company_quality(t.all_scored())


@register(
    "table_goal_leaders",
    LONG_SQL
    + """, m AS (SELECT company, sdg, CAST(printf('%.2f', avg(computed_score)) AS DOUBLE)
      AS avg_score, count(*) AS n FROM long GROUP BY 1, 2)
    SELECT company, sdg, avg_score, n FROM (SELECT *, rank() OVER (PARTITION BY sdg
      ORDER BY avg_score DESC) AS r FROM m) WHERE r = 1""",
)
def table_goal_leaders(t):
    return observatory.goal_leaders(t.long())


def _status(col):
    return (
        f"CASE WHEN {col} IS NULL THEN 'No data' "
        f"WHEN regexp_matches({col}, 'None|No SDG') THEN 'No evidence' "
        f"WHEN regexp_matches({col}, 'Strong') THEN 'Strong' "
        f"WHEN regexp_matches({col}, 'Substantial|Moderate') THEN 'Moderate' ELSE 'Partial' END"
    )


_LABELS = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in k.ASSESSMENT_LABELS.items())


@register(
    "table_report_index",
    ASSESSMENT_SQL
    + f""", n AS (SELECT company, report_year, count(*) FILTER (validation_status = 'valid') AS v,
      count(*) FILTER (validation_status <> 'valid') AS x FROM all_scored GROUP BY ALL),
    joined AS (SELECT r.company, r.report_year, r.report_name, a.overall_assessment AS oa,
      coalesce(v, 0) AS n_valid, coalesce(x, 0) AS n_rejected FROM reports r
      JOIN assessed a USING (company, report_year) LEFT JOIN n USING (company, report_year))
    SELECT upper(substr(company, 1, 1)) || lower(substr(company, 2)) AS company, report_year,
    report_name, {_status('oa')} AS status,
    {_status(f"(CASE oa {_LABELS} ELSE oa END)")} AS assessment_status, n_valid, n_rejected,
    CASE WHEN n_valid + n_rejected > 0 THEN CAST(round_even(
      n_rejected::DOUBLE / (n_valid + n_rejected) * 100, 0) AS INT) || '%' END AS rejected_percent,
    CASE WHEN n_valid > 0 THEN lower(company) || '/report.md' END AS report_file FROM joined""",
)
def table_report_index(t):
    runs = t.runs().join(
        findings.overall_assessment(t.scored(), t.reports()), findings.REPORT
    )
    files = (
        t.scored()
        .select(*findings.REPORT)
        .distinct()
        .withColumn("report_file", F.concat(F.lower("company"), F.lit("/report.md")))
    )
    return observatory.report_index(runs, files)


@register(
    "table_one_company",
    SCORED_SQL
    + """ SELECT evidence_id, report_year, computed_score FROM scored WHERE company = (
    SELECT max(n_name) FROM nation)""",
)
def table_one_company(t):
    last = t.read("nation").agg(F.max("n_name"))
    return t.wide().filter(F.col("company") == last.scalar()).select(
        "evidence_id", "report_year", "computed_score"
    )


# --- networks -----------------------------------------------------------------------

TAG_EDGES_SQL = (
    LONG_SQL
    + """, tag_edges AS (SELECT sdg AS source, tag AS target, count(*) AS n,
      avg(computed_score) AS avg_score FROM (SELECT *, unnest(evidence_tags) AS tag FROM long)
      GROUP BY 1, 2)"""
)
_NODE_LABEL = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in k.STAGE_NODE_LABELS.items())
STAGE_EDGES_SQL = (
    LONG_SQL
    + f""", stage_edges AS (SELECT sdg AS source, CASE implementation_stage {_NODE_LABEL} END
      AS target, count(*) AS n, avg(computed_score) AS avg_score FROM long GROUP BY 1, 2)"""
)


@register("network_goal_tag", TAG_EDGES_SQL + " SELECT * FROM tag_edges")
def network_goal_tag(t):
    return networks.goal_tag_edges(t.long())


@register(
    "network_goal_tag_by_period",
    LONG_SQL
    + """ SELECT period, sdg AS source, tag AS target, count(*) AS n, avg(computed_score) AS avg_score
    FROM (SELECT *, unnest(evidence_tags) AS tag FROM long) GROUP BY 1, 2, 3""",
)
def network_goal_tag_by_period(t):
    return networks.goal_tag_edges(t.long(), keys=["period"])


@register("network_goal_stage", STAGE_EDGES_SQL + " SELECT * FROM stage_edges")
def network_goal_stage(t):
    return networks.goal_stage_edges(t.long())


_PAIR_SQL = """, listed AS (SELECT evidence_id, {goals} AS g FROM scored WHERE len(candidate_sdgs) > 1),
  placed AS (SELECT evidence_id, unnest(g) AS goal, generate_subscripts(g, 1) AS pos FROM listed)
  SELECT a.goal AS source, b.goal AS target, count(*) AS n FROM placed a JOIN placed b
  ON a.evidence_id = b.evidence_id AND a.pos < b.pos GROUP BY 1, 2"""


@register(
    "network_goal_pairs",
    SCORED_SQL + _PAIR_SQL.format(goals="list_sort(list_distinct(candidate_sdgs))"),
)
def network_goal_pairs(t):
    return networks.goal_pairs(t.wide())


@register(
    "network_goal_pairs_with_repeats",
    SCORED_SQL + _PAIR_SQL.format(goals="list_sort(candidate_sdgs)"),
)
def network_goal_pairs_with_repeats(t):
    return networks.goal_pairs(t.wide(), dedupe=False)


@register(
    "network_tag_nodes",
    TAG_EDGES_SQL
    + """ SELECT DISTINCT source AS name, 'SDG' AS node_type, false AS second_side FROM tag_edges
    UNION SELECT DISTINCT target, 'Tag', true FROM tag_edges""",
)
def network_tag_nodes(t):
    return networks.bipartite_nodes(networks.goal_tag_edges(t.long()), "SDG", "Tag")


@register(
    "network_stage_nodes",
    STAGE_EDGES_SQL
    + """ SELECT DISTINCT source AS name, 'SDG' AS node_type, false AS second_side FROM stage_edges
    UNION SELECT DISTINCT target, 'Stage', true FROM stage_edges""",
)
def network_stage_nodes(t):
    return networks.bipartite_nodes(networks.goal_stage_edges(t.long()), "SDG", "Stage")


@register(
    "network_pair_nodes",
    SCORED_SQL
    + """ SELECT DISTINCT goal AS name, 'SDG' AS node_type, CAST(substr(goal, 5) AS INT) AS sdg_num
    FROM (SELECT unnest(list_distinct(candidate_sdgs)) AS goal FROM scored
    WHERE len(list_distinct(candidate_sdgs)) > 1)""",
)
def network_pair_nodes(t):
    return networks.goal_nodes(networks.goal_pairs(t.wide()))


@register(
    "network_matrix_count",
    TAG_EDGES_SQL + " SELECT source AS sdg, target AS tag, n::DOUBLE AS weight FROM tag_edges",
)
def network_matrix_count(t):
    return networks.goal_tag_matrix(t.long(), "count")


@register(
    "network_matrix_score",
    TAG_EDGES_SQL + " SELECT source AS sdg, target AS tag, avg_score AS weight FROM tag_edges",
)
def network_matrix_score(t):
    return networks.goal_tag_matrix(t.long(), "score")


@register(
    "network_difference",
    LONG_SQL
    + """, x AS (SELECT *, unnest(evidence_tags) AS tag FROM long),
    b AS (SELECT company, sdg, tag, avg(computed_score) AS s FROM x WHERE period = 'before' GROUP BY ALL),
    a AS (SELECT company, sdg, tag, avg(computed_score) AS s FROM x WHERE period = 'after' GROUP BY ALL)
    SELECT company, sdg, tag, score_before, score_after, score_after - score_before AS delta,
    CASE WHEN score_after - score_before >= 0 THEN 'Strengthened' ELSE 'Weakened' END AS direction
    FROM (SELECT company, sdg, tag, coalesce(b.s, 0) AS score_before, coalesce(a.s, 0) AS score_after
      FROM b FULL JOIN a USING (company, sdg, tag)) WHERE abs(score_after - score_before) > 0.5""",
)
def network_difference(t):
    return networks.difference_edges(t.long(), "before", "after", ["company"])
