"""Validation, scoring and findings on evidence records."""

from pyspark.sql import functions as F

from attesta import constants as k
from attesta.operators import findings, scoring, validation
from attesta.params import FindingsParams
from attesta.plans.catalog import register
from attesta.plans.driver_tables import (
    ALL_SCORED_SQL,
    EVIDENCE_SQL,
    REPORTS_SQL,
    RULES_SQL,
    SCORED_SQL,
)

_RANKED = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(k.STAGES, 1))
BY_GOAL_SQL = SCORED_SQL + ", g AS (SELECT *, unnest(candidate_sdgs) AS sdg FROM scored)"


@register(
    "validation_errors",
    ALL_SCORED_SQL
    + " SELECT evidence_id, validation_status, array_to_string(validation_errors, ';') AS errors "
    "FROM all_scored",
)
def validation_errors(t):
    return t.validated().select(
        "evidence_id", "validation_status", F.array_join("validation_errors", ";").alias("errors")
    )


@register(
    "validation_rule_counts",
    f"WITH {EVIDENCE_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER ({cond}) AS n_records FROM evidence"
        for name, cond in RULES_SQL.items()
    ),
)
def validation_rule_counts(t):
    return validation.rule_violations(t.evidence())


@register(
    "validation_status_counts",
    ALL_SCORED_SQL
    + """ SELECT company, report_year, count(*) FILTER (validation_status = 'valid') AS n_valid,
    count(*) FILTER (validation_status = 'rejected') AS n_rejected
    FROM all_scored GROUP BY ALL""",
)
def validation_status_counts(t):
    return validation.status_counts(t.validated(), findings.REPORT)


@register(
    "score_records",
    SCORED_SQL + " SELECT evidence_id, computed_score, computed_strength FROM scored",
)
def score_records(t):
    return t.scored().select("evidence_id", "computed_score", "computed_strength")


@register(
    "score_parts",
    f"""WITH {EVIDENCE_SQL} SELECT evidence_id,
    CAST(CASE implementation_stage {" ".join(f"WHEN '{s}' THEN {p}" for s, p in k.STAGE_POINTS.items())}
      ELSE 1 END AS INT) AS stage_points,
    CAST(coalesce(list_sum(list_transform(evidence_tags, lambda t: CASE t
      {" ".join(f"WHEN '{t}' THEN {p}" for t, p in k.TAG_POINTS.items())} ELSE 0 END)), 0) AS INT)
      AS tag_points,
    CAST(quantitative_support AS INT) + CAST(oversight_support AS INT) AS support_points
    FROM evidence""",
)
def score_parts(t):
    return t.evidence().select(
        "evidence_id",
        scoring.stage_points().alias("stage_points"),
        scoring.tag_points().cast("int").alias("tag_points"),
        scoring.support_points().alias("support_points"),
    )


@register(
    "score_strength_counts",
    SCORED_SQL
    + """ SELECT company, report_year, count(*) FILTER (computed_strength = 'weak') AS n_weak,
    count(*) FILTER (computed_strength = 'moderate') AS n_moderate,
    count(*) FILTER (computed_strength = 'strong') AS n_strong FROM scored GROUP BY ALL""",
)
def score_strength_counts(t):
    return scoring.strength_counts(t.scored(), findings.REPORT)


GOAL_MEASURES_SQL = (
    BY_GOAL_SQL
    + f""", m AS (SELECT company, report_year, sdg, count(*) AS evidence_count,
      CAST(sum(computed_score) AS BIGINT) AS score_sum, avg(computed_score) AS mean_score,
      max(CASE implementation_stage {_RANKED} END) AS top_rank,
      list(CASE implementation_stage {_RANKED} END) AS ranks FROM g GROUP BY ALL),
    measures AS (SELECT *,
      CAST(round_even(100.0::DOUBLE * len(list_filter(ranks, lambda r: r = top_rank))
        / evidence_count, 0) AS BIGINT) AS pct,
      CAST(printf('%.2f', mean_score) AS DOUBLE) AS average_score FROM m),
    profiles AS (SELECT *, CASE top_rank WHEN 4 THEN 'measurable_evidence (' || pct || '% of items)'
      WHEN 3 THEN 'in_progress (' || pct || '% of items)'
      WHEN 2 THEN 'planned (' || pct || '% of items)' ELSE 'mentions_only' END
      AS implementation_profile FROM measures)"""
)


@register(
    "findings_goal_measures",
    GOAL_MEASURES_SQL
    + """ SELECT company, report_year, sdg, evidence_count, mean_score, average_score,
    implementation_profile FROM profiles""",
)
def findings_goal_measures(t):
    return findings.goal_measures(t.scored()).select(
        "company", "report_year", "sdg", "evidence_count", "mean_score", "average_score",
        "implementation_profile",
    )


KEY_PAGES_SQL = """, best AS (SELECT company, report_year, sdg, page_number, row_number() OVER (
      PARTITION BY company, report_year, sdg ORDER BY computed_score DESC, seq) AS rn FROM g),
    firsts AS (SELECT company, report_year, sdg, page_number, min(rn) AS rn FROM best
      WHERE rn <= 5 AND page_number <> 0 GROUP BY ALL),
    pages AS (SELECT company, report_year, sdg,
      string_agg(CAST(page_number AS VARCHAR), ',' ORDER BY rn) AS strongest_pages
      FROM firsts GROUP BY ALL)"""
TOP_TAGS_SQL = """, tagged AS (SELECT company, report_year, sdg, seq,
      unnest(evidence_tags) AS tag, generate_subscripts(evidence_tags, 1) AS pos FROM g),
    tag_counts AS (SELECT company, report_year, sdg, tag, count(*) AS n,
      min(seq * 1000 + pos) AS seen FROM tagged GROUP BY ALL),
    tag_ranks AS (SELECT *, row_number() OVER (PARTITION BY company, report_year, sdg
      ORDER BY n DESC, seen) AS rn FROM tag_counts),
    tags AS (SELECT company, report_year, sdg, string_agg(tag, ', ' ORDER BY rn) AS top_tags
      FROM tag_ranks WHERE rn <= 4 GROUP BY ALL)"""


EVERYTHING = FindingsParams(None, None, None, None, None)


@register(
    "findings_all_pages",
    BY_GOAL_SQL
    + """ SELECT company, report_year, sdg, count(DISTINCT page_number) AS n_pages,
    count(DISTINCT page_number) AS n_listed FROM g WHERE page_number <> 0 GROUP BY ALL""",
)
def findings_all_pages(t):
    pages = findings.key_pages(t.scored(), params=EVERYTHING).filter("n_pages > 0")
    return pages.select(
        "company", "report_year", "sdg", "n_pages", F.size("strongest_pages").cast("bigint").alias("n_listed")
    )


@register(
    "findings_all_tags",
    BY_GOAL_SQL
    + TOP_TAGS_SQL
    + """ SELECT company, report_year, sdg, string_agg(tag, ', ' ORDER BY rn) AS top_tags,
    count(*) AS n_tags FROM tag_ranks GROUP BY company, report_year, sdg""",
)
def findings_all_tags(t):
    return findings.top_tags(t.scored(), params=EVERYTHING).withColumn(
        "top_tags", F.array_join("top_tags", ", ")
    )


@register("findings_key_pages", BY_GOAL_SQL + KEY_PAGES_SQL + " SELECT * FROM pages")
def findings_key_pages(t):
    return findings.key_pages(t.scored()).drop("n_pages").withColumn(
        "strongest_pages", F.array_join(F.col("strongest_pages").cast("array<string>"), ",")
    )


@register("findings_top_tags", BY_GOAL_SQL + TOP_TAGS_SQL + " SELECT * FROM tags")
def findings_top_tags(t):
    return findings.top_tags(t.scored()).drop("n_tags").withColumn("top_tags", F.array_join("top_tags", ", "))


@register(
    "findings_goal_summaries",
    GOAL_MEASURES_SQL
    + KEY_PAGES_SQL
    + TOP_TAGS_SQL
    + """ SELECT company, report_year, sdg, CAST(substr(sdg, 5) AS INT) AS sdg_num, evidence_count,
    average_score, strongest_pages, implementation_profile,
    evidence_count || ' evidence item(s) found. Dominant stage: '
    || replace(CASE top_rank WHEN 4 THEN 'implemented_with_measurable_evidence'
      WHEN 3 THEN 'implementation_in_progress' WHEN 2 THEN 'planned_action'
      ELSE 'mention_only' END, '_', ' ')
    || '. Average score: ' || CASE WHEN score_sum % evidence_count = 0
      THEN CAST(score_sum // evidence_count AS VARCHAR) ELSE CAST(average_score AS VARCHAR) END
    || '/10.' || coalesce(' Key evidence types: ' || top_tags || '.', '') AS summary
    FROM profiles LEFT JOIN pages USING (company, report_year, sdg)
    LEFT JOIN tags USING (company, report_year, sdg)""",
)
def findings_goal_summaries(t):
    return findings.goal_summaries(t.scored()).withColumn(
        "strongest_pages", F.array_join(F.col("strongest_pages").cast("array<string>"), ",")
    )


ASSESSMENT_SQL = (
    SCORED_SQL
    + f""", {REPORTS_SQL}, tiers AS (SELECT company, report_year,
      bool_or(implementation_stage = 'implemented_with_measurable_evidence'
        AND quantitative_support) AS a,
      bool_or(implementation_stage = 'implementation_in_progress') AS b,
      bool_or(list_contains(evidence_tags, 'policy') OR list_contains(evidence_tags, 'governance'))
        AS c, count(*) AS n FROM scored GROUP BY ALL),
    assessed AS (SELECT company, report_year, CASE WHEN n IS NULL THEN 'no_evidence_found'
      WHEN a THEN 'measurable_implementation_evidence' WHEN b THEN 'implementation_in_progress'
      WHEN c THEN 'strategic_commitment_present' ELSE 'symbolic_alignment_only' END
      AS overall_assessment FROM reports LEFT JOIN tiers USING (company, report_year))"""
)
LABEL_CASES = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in k.ASSESSMENT_LABELS.items())


@register(
    "findings_overall_assessment",
    ASSESSMENT_SQL
    + f""" SELECT *, CASE overall_assessment {LABEL_CASES} ELSE overall_assessment END AS label
    FROM assessed""",
)
def findings_overall_assessment(t):
    return findings.overall_assessment(t.scored(), t.reports()).withColumn(
        "label", findings.assessment_label()
    )


@register(
    "findings_goal_order",
    BY_GOAL_SQL
    + """ SELECT company, report_year, sdg,
    CAST(coalesce(TRY_CAST(trim(replace(sdg, 'SDG', '')) AS INT), 99) AS INT) AS sdg_num,
    row_number() OVER (PARTITION BY company, report_year ORDER BY
      coalesce(TRY_CAST(trim(replace(sdg, 'SDG', '')) AS INT), 99), sdg) AS place
    FROM (SELECT DISTINCT company, report_year, sdg FROM g)""",
)
def findings_goal_order(t):
    from pyspark.sql import Window as W

    goals = findings.by_goal(t.scored()).select("company", "report_year", "sdg").distinct()
    numbered = goals.withColumn("sdg_num", findings.goal_number())
    order = W.partitionBy("company", "report_year").orderBy("sdg_num", "sdg")
    return numbered.withColumn("place", F.row_number().over(order).cast("bigint"))


@register(
    "findings_executive_summary",
    ALL_SCORED_SQL
    + """ SELECT a.*, coalesce(n_goals, 0) AS n_goals FROM (SELECT company, report_year,
      count(*) FILTER (validation_status = 'valid') AS n_valid,
      count(*) FILTER (validation_status = 'rejected') AS n_rejected,
      avg(computed_score) AS mean_score,
      count(*) FILTER (computed_strength = 'weak') AS n_weak,
      count(*) FILTER (computed_strength = 'moderate') AS n_moderate,
      count(*) FILTER (computed_strength = 'strong') AS n_strong
      FROM all_scored GROUP BY ALL) a LEFT JOIN (SELECT company, report_year,
      count(DISTINCT sdg) AS n_goals FROM (SELECT company, report_year,
      unnest(candidate_sdgs) AS sdg FROM all_scored WHERE validation_status = 'valid')
      GROUP BY ALL) USING (company, report_year)""",
)
def findings_executive_summary(t):
    return findings.executive_summary(t.all_scored())


@register(
    "findings_strongest_items",
    SCORED_SQL
    + """ SELECT company, report_year, item_rank, evidence_id, computed_score, n_strong,
    evidence_text AS preview FROM (SELECT *,
      count(*) OVER (PARTITION BY company, report_year) AS n_strong, row_number() OVER (PARTITION BY company, report_year
      ORDER BY computed_score DESC, seq) AS item_rank FROM scored
      WHERE computed_strength = 'strong') WHERE item_rank <= 10""",
)
def findings_strongest_items(t):
    return findings.strongest_items(t.scored()).select(
        "company", "report_year", F.col("item_rank").cast("bigint").alias("item_rank"),
        "evidence_id", "computed_score", "n_strong",
        F.col("evidence_text").alias("preview"),
    )


@register(
    "findings_moderate_items",
    SCORED_SQL
    + """ SELECT company, report_year, item_rank, evidence_id, computed_score, n_moderate
    FROM (SELECT *, row_number() OVER (PARTITION BY company, report_year
      ORDER BY computed_score DESC, seq) AS item_rank,
      count(*) OVER (PARTITION BY company, report_year) AS n_moderate FROM scored
      WHERE computed_strength = 'moderate') WHERE item_rank <= 20""",
)
def findings_moderate_items(t):
    return findings.moderate_items(t.scored()).select(
        "company", "report_year", F.col("item_rank").cast("bigint").alias("item_rank"),
        "evidence_id", "computed_score", "n_moderate",
    )


@register(
    "findings_rejection_reasons",
    SCORED_SQL
    + """ SELECT company, report_year, reason, n_items, rank, n_reasons FROM (SELECT *,
      count(*) OVER (PARTITION BY company, report_year) AS n_reasons, row_number() OVER (
      PARTITION BY company, report_year ORDER BY n_items DESC, seen) AS rank FROM (
      SELECT company, report_year, trim(split_part(split_part(message, ':', 1), '(', 1)) AS reason, count(*) AS n_items,
        min(seq * 1000 + pos) AS seen FROM (
        SELECT company, report_year, seq, unnest(validation_errors) AS message,
          generate_subscripts(validation_errors, 1) AS pos FROM rejected) GROUP BY 1, 2, 3))
    WHERE rank <= 10""",
)
def findings_rejection_reasons(t):
    return findings.rejection_reasons(t.rejected()).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@register(
    "findings_display_values",
    GOAL_MEASURES_SQL
    + KEY_PAGES_SQL
    + """ SELECT company, report_year, sdg, printf('%.1f', average_score) AS score_text,
    coalesce('p.' || replace(strongest_pages, ',', ', p.'), '') AS page_text
    FROM profiles LEFT JOIN pages USING (company, report_year, sdg)""",
)
def findings_display_values(t):
    return findings.goal_summaries(t.scored()).select(
        "company", "report_year", "sdg",
        findings.one_decimal(F.col("average_score")).alias("score_text"),
        findings.page_references().alias("page_text"),
    )
