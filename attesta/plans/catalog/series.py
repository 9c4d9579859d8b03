"""Trends over years and measures on the customer panel."""

from pyspark.sql import functions as F

from attesta.operators import observatory, panel, trends
from attesta.plans.catalog import register
from attesta.plans.catalog.tables import MATURITY_SQL, goal_years
from attesta.plans.catalog.records import GOAL_MEASURES_SQL
from attesta.plans.driver_tables import CUT_YEAR, LONG_SQL, PERIOD, SCORED_SQL

# --- trends ---------------------------------------------------------------------------


def maturity(t):
    return observatory.maturity_index(t.wide(), period=PERIOD)


@register(
    "trend_components",
    MATURITY_SQL
    + """ SELECT company, report_year, component, value FROM (UNPIVOT (SELECT company, report_year,
      avg_score AS score_component, stage_weight_avg AS stage_component,
      quality_rate AS quality_component FROM maturity)
      ON score_component, stage_component, quality_component INTO NAME component VALUE value)""",
)
def trend_components(t):
    return trends.maturity_components(maturity(t))


_FIT_SQL = (
    MATURITY_SQL
    + f""", timed AS (SELECT *, report_year - min(report_year) OVER (PARTITION BY company) AS t,
      report_year > {CUT_YEAR} AS post FROM maturity),
    fits AS (SELECT company, count(*) AS n_years,
      regr_intercept(maturity_index, t) FILTER (NOT post) AS a0,
      regr_slope(maturity_index, t) FILTER (NOT post) AS b0,
      regr_intercept(maturity_index, t) FILTER (post) AS a1,
      regr_slope(maturity_index, t) FILTER (post) AS b1 FROM timed GROUP BY company
      HAVING count(*) >= 5)"""
)


@register(
    "trend_breaks",
    _FIT_SQL
    + """ SELECT company, n_years, round(a0, 6) AS level, round(b0, 6) AS slope,
    round(a1 - a0, 6) AS level_change, round(b1 - b0, 6) AS slope_change FROM fits""",
)
def trend_breaks(t):
    fit = trends.trend_breaks(maturity(t), CUT_YEAR)
    return fit.select(
        "company",
        "n_years",
        *[F.round(c, 6).alias(c) for c in ("level", "slope", "level_change", "slope_change")],
    )


@register(
    "trend_break_fit",
    _FIT_SQL
    + """ SELECT company, report_year, round(CASE WHEN post THEN a1 + b1 * t ELSE a0 + b0 * t END, 6)
    AS fitted FROM timed JOIN fits USING (company)""",
)
def trend_break_fit(t):
    series = maturity(t)
    return trends.fitted_breaks(series, trends.trend_breaks(series, CUT_YEAR), CUT_YEAR).withColumn(
        "fitted", F.round("fitted", 6)
    )


@register(
    "trend_confident_but_weak",
    SCORED_SQL
    + """ SELECT evidence_id, company, report_year, page_number, computed_score, confidence,
    implementation_stage, array_to_string(candidate_sdgs, ', ') AS sdgs FROM scored
    WHERE confidence >= 0.3 AND computed_strength = 'weak'""",
)
def trend_confident_but_weak(t):
    # On these tables a confidence of 0.5 or more implies a quantified, stronger record.
    return trends.confident_but_weak(t.wide(), min_confidence=0.3)


@register(
    "trend_score_drops",
    GOAL_MEASURES_SQL
    + """ SELECT company, sdg, report_year, previous_score, average_score,
    average_score - previous_score AS drop FROM (SELECT *, lag(average_score) OVER (
      PARTITION BY company, sdg ORDER BY report_year) AS previous_score FROM profiles)
    WHERE average_score - previous_score < -1""",
)
def trend_score_drops(t):
    return trends.score_drops(goal_years(t))


_SHARES = """count(*) AS n_valid, avg(CAST(stage_rank = 1 AS INT)) AS rhetoric_share,
    avg(CAST(stage_rank = 2 AS INT)) AS commitment_share,
    avg(CAST(stage_rank IN (3, 4) AS INT)) AS implementation_share,
    avg(CAST(stage_rank = 4 AS INT)) AS measured_share, avg(computed_score) AS mean_score"""


@register("trend_shares", SCORED_SQL + f" SELECT company, {_SHARES} FROM scored GROUP BY company")
def trend_shares(t):
    return trends.disclosure_shares(t.wide(), ["company"])


@register(
    "trend_share_slopes",
    SCORED_SQL
    + f""", y AS (SELECT company, report_year, {_SHARES} FROM scored GROUP BY 1, 2)
    SELECT company, min(report_year) AS first_year, max(report_year) AS last_year,
    round(regr_slope(implementation_share, report_year), 6) AS implementation_slope,
    round(regr_slope(rhetoric_share, report_year), 6) AS rhetoric_slope FROM y GROUP BY company""",
)
def trend_share_slopes(t):
    slopes = trends.share_slopes(trends.disclosure_shares(t.wide(), ["company", "report_year"]))
    return slopes.withColumns(
        {c: F.round(c, 6) for c in ("implementation_slope", "rhetoric_slope")}
    )


@register(
    "trend_dominant_goals",
    LONG_SQL
    + """ SELECT company, string_agg(sdg, ', ' ORDER BY rn) AS dominant_sdgs FROM (
    SELECT company, sdg, row_number() OVER (PARTITION BY company ORDER BY count(*) DESC,
      any_value(sdg_num), sdg) AS rn FROM long GROUP BY company, sdg) WHERE rn <= 3 GROUP BY company""",
)
def trend_dominant_goals(t):
    return trends.dominant_goals(t.long())


@register(
    "trend_persistent_goals",
    LONG_SQL
    + """ SELECT company, string_agg(sdg, ', ' ORDER BY rn) AS persistent_sdgs FROM (
    SELECT company, sdg, row_number() OVER (PARTITION BY company ORDER BY
      count(DISTINCT report_year) DESC, count(*) DESC, any_value(sdg_num), sdg) AS rn
    FROM long GROUP BY company, sdg) WHERE rn <= 3 GROUP BY company""",
)
def trend_persistent_goals(t):
    return trends.persistent_goals(t.long())


@register(
    "trend_country_portfolio",
    SCORED_SQL
    + f""", c AS (SELECT company, {_SHARES} FROM scored GROUP BY company)
    SELECT r_name AS country, count(*) AS n_companies, round(avg(rhetoric_share), 9) AS rhetoric_share,
    round(avg(implementation_share), 9) AS implementation_share, round(avg(mean_score), 9) AS mean_score
    FROM c LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
    ON company = n_name GROUP BY r_name""",
)
def trend_country_portfolio(t):
    countries = t.read("nation").join(t.read("region"), F.expr("n_regionkey = r_regionkey")).select(
        F.col("n_name").alias("company"), F.col("r_name").alias("country")
    )
    measures = ["rhetoric_share", "implementation_share", "mean_score"]
    table = trends.country_portfolio(
        trends.disclosure_shares(t.wide(), ["company"]), countries, measures
    )
    return table.withColumns({m: F.round(m, 9) for m in measures})


@register(
    "trend_shares_long",
    SCORED_SQL
    + f""", c AS (SELECT company, {_SHARES} FROM scored GROUP BY company)
    SELECT company, category, share FROM (UNPIVOT (SELECT company, rhetoric_share, commitment_share,
      measured_share FROM c) ON rhetoric_share, commitment_share, measured_share
      INTO NAME category VALUE share)""",
)
def trend_shares_long(t):
    return trends.to_long(
        trends.disclosure_shares(t.wide(), ["company"]),
        ["company"],
        ["rhetoric_share", "commitment_share", "measured_share"],
        "category",
        "share",
    )


@register(
    "trend_year_grid",
    SCORED_SQL
    + """, y AS (SELECT company, report_year, count(*) AS n_valid FROM scored GROUP BY 1, 2)
    SELECT company, report_year, coalesce(n_valid, 0) AS n_valid FROM
    (SELECT DISTINCT company FROM y) CROSS JOIN (SELECT DISTINCT report_year FROM y)
    LEFT JOIN y USING (company, report_year)""",
)
def trend_year_grid(t):
    yearly = trends.disclosure_shares(t.wide(), ["company", "report_year"])
    return trends.fill_grid(
        trends.year_grid(yearly), yearly, ["company", "report_year"], ["n_valid"]
    )


@register(
    "trend_goal_grid",
    LONG_SQL
    + """, y AS (SELECT company, sdg, count(*) AS n, avg(computed_score) AS avg_score FROM long
      GROUP BY 1, 2)
    SELECT company, sdg, coalesce(n, 0) AS n, coalesce(avg_score, 0) AS avg_score FROM
    (SELECT DISTINCT company FROM y) CROSS JOIN (SELECT 'SDG ' || unnest(range(1, 18)) AS sdg)
    LEFT JOIN y USING (company, sdg)""",
)
def trend_goal_grid(t):
    portfolio = observatory.goal_portfolio(t.long())
    return trends.fill_grid(
        trends.goal_grid(portfolio), portfolio, ["company", "sdg"], ["n", "avg_score"]
    )


# --- panel ----------------------------------------------------------------------------

PROFILE_SQL = """WITH cents AS (SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INT) AS year,
    o_orderpriority AS category, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c
    FROM orders GROUP BY 1, 2, 3),
  profiles AS (SELECT entity, year, category, 100.0::DOUBLE * c
    / CAST(sum(c) OVER (PARTITION BY entity, year) AS BIGINT) AS score FROM cents),
  ordered AS (SELECT *, row_number() OVER (PARTITION BY entity, year ORDER BY score DESC, category)
    AS rn, score / 100 AS s FROM profiles),
  metrics AS (SELECT entity, year, count(*) AS n_categories, sum(score) AS total_score,
    max(score) AS dominant_score, sum(score) FILTER (rn <= 2) AS top2_score, sum(s * s) AS hhi,
    -sum(s * ln(s)) AS entropy, max(category) FILTER (rn = 1) AS dominant_category
    FROM ordered GROUP BY 1, 2),
  sizes AS (SELECT o_custkey AS entity, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)
    AS size FROM orders GROUP BY 1),
  entities AS (SELECT c_custkey AS entity, c_mktsegment AS sector, r_name AS country,
    c_acctbal AS balance, size FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey JOIN sizes ON c_custkey = entity),
  panel AS (SELECT m.*, sector, country, balance, size FROM metrics m JOIN entities USING (entity)
    WHERE n_categories >= 2 AND abs(total_score / 100 - 1) <= 1e-8)"""
_ROUNDED = ("total_score", "dominant_score", "top2_score", "hhi", "entropy")


def metrics(t):
    return panel.profile_metrics(t.panel_profiles(), ["entity", "year"])


def full_panel(t):
    return panel.usable_profiles(metrics(t)).join(t.panel_entities(), "entity")


@register(
    "panel_profile_metrics",
    PROFILE_SQL
    + " SELECT entity, year, n_categories, dominant_category, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED)
    + " FROM metrics",
)
def panel_profile_metrics(t):
    return metrics(t).withColumns({c: F.round(c, 6) for c in _ROUNDED})


@register(
    "panel_rejected_profiles",
    PROFILE_SQL
    + """ SELECT entity, year, n_categories, CASE WHEN n_categories < 2
    THEN 'fewer than two categories' ELSE 'scores do not sum to 100' END AS reason FROM metrics
    WHERE NOT (n_categories >= 2 AND abs(total_score / 100 - 1) <= 1e-8)""",
)
def panel_rejected_profiles(t):
    return panel.rejected_profiles(metrics(t)).select("entity", "year", "n_categories", "reason")


@register(
    "panel_standardised_size",
    PROFILE_SQL
    + """ SELECT entity, round((ln(size) - (SELECT avg(ln(size)) FROM entities))
    / (SELECT stddev_samp(ln(size)) FROM entities), 6) AS log_size_z FROM entities""",
)
def panel_standardised_size(t):
    return panel.standardise_log(t.panel_entities(), "size", "log_size_z").select(
        "entity", F.round("log_size_z", 6).alias("log_size_z")
    )


@register(
    "panel_grid",
    PROFILE_SQL + " SELECT entity, year FROM entities, (SELECT unnest([2000, 2001]) AS year)",
)
def panel_grid(t):
    return panel.panel_grid(t.panel_entities(), [2000, 2001]).select("entity", "year")


@register(
    "panel_min_observations",
    PROFILE_SQL
    + """, few AS (SELECT entity FROM panel GROUP BY entity HAVING count(*) < 2)
    SELECT entity, year, sector, hhi IS NOT NULL AS observed FROM (
      SELECT entity, year, sector, hhi FROM panel UNION ALL
      SELECT entity, y, sector, NULL FROM entities e JOIN few USING (entity),
        (SELECT unnest([2000, 2001]) AS y)
      WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.entity = e.entity AND p.year = y))""",
)
def panel_min_observations(t):
    filled = panel.ensure_observations(full_panel(t), t.panel_entities(), "entity", [2000, 2001])
    return filled.select("entity", "year", "sector", F.col("hhi").isNotNull().alias("observed"))


@register(
    "panel_summary",
    PROFILE_SQL
    + """ SELECT (SELECT count(*) FROM panel) AS n_rows,
    (SELECT count(DISTINCT entity) FROM panel) AS n_entities,
    round((SELECT avg(n) FROM (SELECT count(*) AS n FROM panel GROUP BY entity)), 6) AS mean_years,
    round(avg(dominant_score), 6) AS mean_dominant_score, round(avg(hhi), 6) AS mean_hhi,
    round(corr(dominant_score, hhi), 6) AS correlation FROM panel""",
)
def panel_summary(t):
    table = panel.panel_summary(full_panel(t), "entity", "dominant_score", "hhi")
    rounded = ("mean_years", "mean_dominant_score", "mean_hhi", "correlation")
    return table.withColumns({c: F.round(c, 6) for c in rounded})


@register(
    "panel_quantiles",
    PROFILE_SQL
    + """, probs AS (SELECT unnest([0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]) AS p,
      unnest((SELECT quantile_cont(dominant_score, [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99])
        FROM panel)) AS q)
    SELECT CAST(p AS DOUBLE) AS prob, round(q, 6) AS quantile FROM probs""",
)
def panel_quantiles(t):
    return panel.quantile_table(full_panel(t), "dominant_score").withColumn(
        "quantile", F.round("quantile", 6)
    )


@register(
    "panel_six_numbers",
    PROFILE_SQL
    + """ SELECT statistic, round(value, 6) AS value FROM (
    SELECT 'min' AS statistic, min(hhi) AS value FROM panel
    UNION ALL SELECT 'q1', quantile_cont(hhi, 0.25) FROM panel
    UNION ALL SELECT 'median', quantile_cont(hhi, 0.5) FROM panel
    UNION ALL SELECT 'mean', avg(hhi) FROM panel
    UNION ALL SELECT 'q3', quantile_cont(hhi, 0.75) FROM panel
    UNION ALL SELECT 'max', max(hhi) FROM panel)""",
)
def panel_six_numbers(t):
    return panel.six_numbers(full_panel(t), "hhi").withColumn("value", F.round("value", 6))


@register(
    "panel_category_mix",
    PROFILE_SQL
    + """ SELECT sector, dominant_category, count(*) AS n,
    count(*) / sum(count(*)) OVER (PARTITION BY sector) AS share FROM panel GROUP BY 1, 2""",
)
def panel_category_mix(t):
    return panel.category_mix(full_panel(t), "sector", "dominant_category")


@register(
    "panel_group_means",
    PROFILE_SQL
    + """ SELECT sector, country, round(avg(dominant_score), 6) AS mean_dominant_score,
    round(avg(hhi), 6) AS mean_hhi FROM panel GROUP BY 1, 2""",
)
def panel_group_means(t):
    table = panel.group_means(full_panel(t), ["sector", "country"], ["dominant_score", "hhi"])
    return table.withColumns({c: F.round(c, 6) for c in ("mean_dominant_score", "mean_hhi")})


@register(
    "panel_sample",
    PROFILE_SQL
    + """ SELECT entity, year, dominant_category FROM panel WHERE entity IN (
    SELECT entity FROM (SELECT DISTINCT entity FROM panel) ORDER BY md5('99|' || entity), entity
    LIMIT 6)""",
)
def panel_sample(t):
    return panel.sample_entities(full_panel(t), "entity", 6, 99).select(
        "entity", "year", "dominant_category"
    )


@register(
    "panel_histogram",
    PROFILE_SQL
    + """, span AS (SELECT min(hhi) AS lo, (max(hhi) - min(hhi)) / 34 AS w FROM panel)
    SELECT CAST(greatest(0, least(34, ceil((round(hhi, 9) - lo) / w - 0.5))) AS INT) AS bin,
    count(*) AS n FROM (SELECT hhi FROM panel), span GROUP BY 1""",
)
def panel_histogram(t):
    rounded = full_panel(t).select(F.round("hhi", 9).alias("hhi"))
    return panel.histogram(rounded, "hhi").select("bin", "n")


def vif_input(t):
    return full_panel(t).select(
        "dominant_score",
        F.col("year").cast("double").alias("year_number"),
        "balance",
    )


@register(
    "panel_variance_inflation",
    PROFILE_SQL
    + """, c AS (SELECT corr(dominant_score, year) AS a, corr(dominant_score, balance) AS b,
      corr(year, balance) AS c FROM panel),
    d AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM c)
    SELECT term, round(vif, 6) AS vif FROM (SELECT 'dominant_score' AS term, (1 - c * c) / det AS vif
      FROM d UNION ALL SELECT 'year_number', (1 - b * b) / det FROM d
      UNION ALL SELECT 'balance', (1 - a * a) / det FROM d)""",
)
def panel_variance_inflation(t):
    table = panel.variance_inflation(vif_input(t), ["dominant_score", "year_number", "balance"])
    return table.withColumn("vif", F.round("vif", 6))


@register(
    "panel_level_ranks",
    "WITH m AS (SELECT c_custkey AS entity, c_mktsegment AS sector, dense_rank() OVER ("
    "ORDER BY c_mktsegment) AS r FROM customer) "
    "SELECT entity, sector, CAST(r AS INT) AS sector_rank, "
    "CAST(r = 2 AS INT)::DOUBLE AS is_second FROM m",
)
def panel_level_ranks(t):
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    customers = t.read("customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("sector")
    )
    ranked = customers.withColumn("sector_rank", panel.level_rank("sector", segments))
    return panel.indicator_columns(ranked, "sector", segments).select(
        "entity", "sector", "sector_rank", F.col("sector_1").alias("is_second")
    )
