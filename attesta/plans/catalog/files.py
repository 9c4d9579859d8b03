"""Sources and sinks, run in memory: the text a sink writes is parsed back."""

import uuid

from pyspark.sql import functions as F

from attesta import constants as k
from attesta import schemas
from attesta.functions.text import is_blank
from attesta.operators import evaluation, findings, increments, validation
from attesta.plans.catalog import ORACLES, register
from attesta.plans.catalog.models import AGGREGATE_SQL, PUBLISHED_SQL, RESULTS_SQL, SCORE_SQL
from attesta.plans.catalog.records import (
    ASSESSMENT_SQL,
    BY_GOAL_SQL,
    GOAL_MEASURES_SQL,
    KEY_PAGES_SQL,
    LABEL_CASES,
    TOP_TAGS_SQL,
)
from attesta.plans.driver_tables import ALL_SCORED_SQL, RUNS_SQL, SCORED_SQL
from attesta.plans.report import report_findings
from attesta.staging import shared_folder, staged, unstage
from attesta.sinks import documents, texts
from attesta.sources import items, runs

RUN_TIME = "20240101_120000"


def item_lines(t):
    """One JSON line per order, with comments, blank and broken lines mixed in."""
    body = F.to_json(
        F.struct(
            F.lit("Co").alias("company"),
            F.col("item_id").cast("string").alias("notes"),
            F.lit("text").alias("chunk_text"),
            "expected_sdgs",
            "expected_implementation_stage",
        )
    )
    kind = F.pmod("item_id", F.lit(5))
    return t.items().select(
        F.when(kind == 0, F.concat(F.lit("# "), body))
        .when(kind == 1, F.lit("   "))
        .when(kind == 2, F.concat(body, F.lit(" }")))
        .otherwise(body)
        .alias("value")
    )


_KIND = """CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'skipped' WHEN o_orderkey % 5 = 2 THEN 'malformed'
  ELSE 'item' END"""
_USED = "(SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem)"


@register(
    "item_line_counts",
    f"SELECT {_KIND} AS line_status, count(*) AS n_lines FROM {_USED} GROUP BY 1",
)
def item_line_counts(t):
    return items.line_counts(items.parse_item_lines(item_lines(t)))


@register(
    "item_table",
    RESULTS_SQL
    + """ SELECT CAST(item_id AS VARCHAR) AS notes, 'Co' AS company, 2023 AS report_year,
    1 AS page_number, array_to_string(expected_sdgs, ',') AS sdgs,
    expected_stage AS expected_implementation_stage, true AS expected_valid
    FROM items WHERE item_id % 5 IN (3, 4)""",
)
def item_table(t):
    return items.items_of(items.parse_item_lines(item_lines(t))).select(
        "notes", "company", "report_year", "page_number",
        F.array_join("expected_sdgs", ",").alias("sdgs"), "expected_implementation_stage",
        "expected_valid",
    )


# --- runs ------------------------------------------------------------------------------


def run_names(t):
    """Runs named after nation, order year and order date: many per company-year."""
    named = (
        t.read("orders")
        .join(t.read("customer"), F.expr("o_custkey = c_custkey"))
        .join(t.read("nation"), F.expr("c_nationkey = n_nationkey"))
        .select(
            F.concat_ws(
                "_",
                documents.slug(F.col("n_name")),
                F.year("o_orderdate").cast("string"),
                F.date_format("o_orderdate", "yyyyMMdd"),
                F.lpad((F.col("o_orderkey") % 240000).cast("string"), 6, "0"),
            ).alias("run_name")
        )
    )
    return named.distinct()


_RUN_NAME_SQL = """SELECT DISTINCT substr(replace(lower(n_name), ' ', '_'), 1, 30) || '_'
  || year(o_orderdate) || '_' || strftime(o_orderdate, '%Y%m%d') || '_'
  || lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0') AS run_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


@register(
    "run_latest",
    f"""WITH names AS ({_RUN_NAME_SQL}), p AS (SELECT run_name,
      regexp_extract(run_name, '^(.+)_(\\d{{4}})_(\\d{{8}}_\\d{{6}})$', 1) AS company,
      CAST(regexp_extract(run_name, '^(.+)_(\\d{{4}})_(\\d{{8}}_\\d{{6}})$', 2) AS INT) AS report_year,
      regexp_extract(run_name, '^(.+)_(\\d{{4}})_(\\d{{8}}_\\d{{6}})$', 3) AS run_time FROM names)
    SELECT run_name, company, report_year, run_time FROM (SELECT *, row_number() OVER (
      PARTITION BY company, report_year ORDER BY run_time DESC, run_name DESC) AS rn FROM p)
    WHERE rn = 1""",
)
def run_latest(t):
    return runs.latest_runs(run_names(t))


@register(
    "run_keys",
    """SELECT DISTINCT n_name AS company, substr(replace(lower(n_name), ' ', '_'), 1, 30) || '_'
    || n_nationkey || '_20240101_120000' AS run_key FROM nation""",
)
def run_keys(t):
    return t.read("nation").select(
        F.col("n_name").alias("company"),
        documents.run_key(F.col("n_name"), F.col("n_nationkey"), RUN_TIME).alias("run_key"),
    )


_STATUS_SQL = (
    RUNS_SQL
    + """, done AS (SELECT company, report_year, n_valid, n_rejected FROM runs
      WHERE n_valid + n_rejected > 0),
    status AS (SELECT company, report_year, report_name, d.n_valid, d.n_rejected,
      CASE WHEN d.n_valid IS NULL THEN 'pending' ELSE 'DONE' END AS status
      FROM reports LEFT JOIN done d USING (company, report_year))"""
)


def status(t):
    done = t.runs().filter(F.col("n_valid") + F.col("n_rejected") > 0)
    return runs.run_status(
        t.reports(), done.select("company", "report_year", "n_valid", "n_rejected")
    )


@register("run_status", _STATUS_SQL + " SELECT * FROM status")
def run_status(t):
    return status(t)


@register(
    "run_progress",
    _STATUS_SQL
    + """ SELECT company, count(*) FILTER (status = 'DONE') AS n_done, count(*) AS n_expected,
    CAST(coalesce(sum(n_valid), 0) AS BIGINT) AS total_valid FROM status GROUP BY company""",
)
def run_progress(t):
    return runs.run_progress(status(t))


def stage_inputs(t):
    """Records computed once for all tables of a report, reports and errors. Ids and texts
    take most of the room, so they are stored with a codec that codes single characters."""
    records = staged(t.all_scored(), codec="zstd")
    valid = validation.valid_only(records)
    reports = staged(
        t.reports().join(findings.overall_assessment(valid, t.reports()), findings.REPORT)
    )
    # A record without any text stands for an extraction that failed.
    errors = records.filter(is_blank("evidence_text")).select(
        *findings.REPORT, F.concat(F.lit("chunk failed: "), F.col("evidence_id")).alias("message")
    )
    return records, valid, reports, errors


def run_documents(t, inputs=None):
    """Documents of all reports; the goal summaries, one row per goal of a report, are
    stored, since headers and lists read them."""
    records, valid, reports, errors = inputs or stage_inputs(t)
    return documents.run_documents(
        reports, records, staged(findings.goal_summaries(valid, stage=lambda stored: stored)), errors,
        "2024-01-01T12:00:00", per_part=50,
    )


def parsed_documents(t):
    """Documents as JSON text, parsed back with the reader's schema."""
    written = documents.document_json(run_documents(t), RUN_TIME)
    return written.select(
        "run_name",
        F.col("company").alias("run_company"),
        F.col("report_year").alias("run_year"),
        F.from_json("value", schemas.RUN_DOCUMENT).alias("d"),
    ).select("run_name", "run_company", "run_year", "d.*")


@register(
    "document_records",
    ALL_SCORED_SQL
    + """ SELECT evidence_id, lower(company) AS company, report_year, computed_score,
    validation_status, array_to_string(candidate_sdgs, ',') AS sdgs,
    len(validation_errors) AS n_errors FROM all_scored""",
)
def document_records(t):
    parsed = parsed_documents(t)
    both = runs.run_valid(parsed).unionByName(runs.run_rejected(parsed))
    return both.select(
        "evidence_id", "company", "report_year", "computed_score", "validation_status",
        F.array_join("candidate_sdgs", ",").alias("sdgs"),
        F.size("validation_errors").cast("bigint").alias("n_errors"),
    )


@register(
    "document_runs",
    ASSESSMENT_SQL
    + """ SELECT lower(company) AS company, report_year, 'Annual Report ' || report_year AS report_name,
    overall_assessment FROM assessed""",
)
def document_runs(t):
    return runs.run_metadata(parsed_documents(t)).drop("run_name")


# --- files, written to the shared folder and read back ------------------------------


def new_folder(t, name: str) -> str:
    return f"{shared_folder(t.read('nation').sparkSession)}/attesta-{name}-{uuid.uuid4().hex}"


@register("run_loaded_records", ORACLES["document_records"])
def run_loaded_records(t):
    """Records of the latest runs; the runs before them hold other names and are not opened.
    Documents go from the stored records to the files without a store in between; records
    are deleted when the files hold them."""
    inputs = stage_inputs(t)
    if inputs[2].isEmpty():  # no run folder at all is an error of the reader
        return document_records(t)
    docs, root = run_documents(t, inputs), new_folder(t, "runs")
    old = docs.filter("part = 0").withColumn("report_name", F.lit("superseded"))
    documents.write_run_documents(old, root, "20230101_120000")
    documents.write_run_documents(docs, root, RUN_TIME)
    unstage(inputs[0])
    loaded = runs.load_runs(docs.sparkSession, root)
    both = loaded["valid"].unionByName(loaded["rejected"])
    return both.select(
        "evidence_id", "company", "report_year", "computed_score", "validation_status",
        F.array_join("candidate_sdgs", ",").alias("sdgs"),
        F.size("validation_errors").cast("bigint").alias("n_errors"),
    )


@register(
    "run_report_texts",
    ALL_SCORED_SQL
    + """, reported AS (SELECT DISTINCT company, report_year FROM all_scored),
    written AS (SELECT company, report_year, '# ' || company AS line FROM reported
      UNION ALL SELECT company, report_year, '- ' || evidence_id FROM all_scored)
    SELECT replace(lower(company), ' ', '_') AS company, report_year, count(*) AS n_lines,
    CAST(sum(len(line) + 1) AS BIGINT) AS n_chars FROM written GROUP BY 1, 2""",
)
def run_report_texts(t):
    """Texts of the latest reports as written: lines and characters of each report."""
    records = t.all_scored().select("company", "report_year", "evidence_id")
    if records.isEmpty():
        return spark_rows(t, "company string, report_year int, n_lines bigint, n_chars bigint")
    heads = records.select("company", "report_year").distinct()
    parts = ["company", "report_year", "section", "position", "line_no", "line"]
    zero = F.lit(0).cast("bigint")
    lines = heads.select(
        "company", "report_year", F.lit(0).alias("section"), zero.alias("position"), F.lit(0).alias("line_no"),
        F.concat(F.lit("# "), "company").alias("line"),
    ).union(
        records.select(
            "company", "report_year", F.lit(1).alias("section"), F.xxhash64("evidence_id").alias("position"),
            F.lit(0).alias("line_no"), F.concat(F.lit("- "), F.col("evidence_id").cast("string")).alias("line"),
        ).select(*parts)
    )
    root = new_folder(t, "reports")
    key = lambda time: documents.run_key(F.col("company"), F.col("report_year"), time)
    texts.write_lines(lines.filter("section = 0"), key("20230101_120000"), root)
    texts.write_lines(lines, key(RUN_TIME), root)
    found = runs.read_report_texts(records.sparkSession, root)
    ends = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return found.groupBy("company", "report_year").agg(
        F.sum(ends).cast("bigint").alias("n_lines"), F.sum(F.length("text")).alias("n_chars")
    )


def spark_rows(t, schema: str):
    return t.read("nation").sparkSession.createDataFrame([], schema)


@register(
    "run_plot_inputs",
    ALL_SCORED_SQL
    + """, totals AS (SELECT company, report_year, count(*) AS n,
      count(*) FILTER (validation_status = 'valid') AS n_valid FROM all_scored GROUP BY 1, 2)
    SELECT 'performance' AS source, company AS name, CAST(NULL AS INT) AS year,
      CAST(sum(n) AS DOUBLE) AS value FROM totals GROUP BY company
    UNION ALL SELECT 'longitudinal', company, report_year, CAST(n_valid AS DOUBLE) FROM totals
    UNION ALL SELECT 'agreement', company, NULL, CAST(count(*) AS DOUBLE) FROM totals GROUP BY company""",
)
def run_plot_inputs(t):
    """The three summary tables, written as CSV and read with their schemas."""
    valid = F.count_if(F.col("validation_status") == "valid")
    totals = staged(
        t.all_scored().groupBy("company", "report_year").agg(F.count("*").alias("n"), valid.alias("n_valid"))
    )
    number = lambda c: c.cast("double")
    tables = {
        "performance": totals.groupBy(F.col("company").alias("model")).agg(
            F.first(F.lit("n")).alias("metric"), number(F.sum("n")).alias("value")),
        "longitudinal": totals.select(
            "company", F.col("report_year").alias("year"), number(F.col("n_valid")).alias("implementation_share"),
            F.lit(0.0).alias("rhetoric_share")),
        "agreement": totals.groupBy("company").agg(
            number(F.count("*")).alias("sdg_agreement"), F.first(F.lit(0.0)).alias("stage_agreement"),
            F.first(F.lit(0.0)).alias("overclaim_difference")),
    }
    root = new_folder(t, "plots")
    for name, table in tables.items():
        documents.write_download(table, f"{root}/{name}")
    read = runs.read_plot_inputs(totals.sparkSession, *[f"{root}/{name}" for name in tables])
    none = F.lit(None).cast("int")
    columns = {"performance": ("model", none, "value"), "longitudinal": ("company", F.col("year"), "implementation_share"),
               "agreement": ("company", none, "sdg_agreement")}
    parts = [
        read[name].select(F.lit(name).alias("source"), F.col(who).alias("name"), year.alias("year"), F.col(value).alias("value"))
        for name, (who, year, value) in columns.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


@register(
    "document_goal_summaries",
    BY_GOAL_SQL
    + """ SELECT company, report_year, sdg, CAST(count(*) AS INT) AS evidence_count,
    CAST(printf('%.2f', avg(computed_score)) AS DOUBLE) AS average_score FROM g
    GROUP BY company, report_year, sdg""",
)
def document_goal_summaries(t):
    return runs.run_goal_summaries(parsed_documents(t)).select(
        "company", "report_year", "sdg", "evidence_count", "average_score"
    )


_CSV_SQL = {
    "candidate_sdgs": "array_to_string(candidate_sdgs, ' | ')",
    "evidence_tags": "array_to_string(evidence_tags, ' | ')",
    "validation_errors": "array_to_string(validation_errors, ' | ')",
}
_NOT_HERE = ("report_name", "section_heading", "evidence_summary", "rationale")


@register(
    "flat_evidence",
    ALL_SCORED_SQL
    + " SELECT "
    + ", ".join(f"{_CSV_SQL.get(c, c)} AS {c}" for c in k.CSV_COLUMNS if c not in _NOT_HERE)
    + ", CASE WHEN validation_status = 'valid' THEN 0 ELSE 1 END AS row_group FROM all_scored",
)
def flat_evidence(t):
    return documents.flat_evidence(t.all_scored()).drop(*_NOT_HERE)


@register(
    "download_table",
    SCORED_SQL
    + """ SELECT evidence_id, array_to_string(candidate_sdgs, ', ') AS candidate_sdgs,
    array_to_string(evidence_tags, ', ') AS evidence_tags, computed_score FROM scored""",
)
def download_table(t):
    return documents.flatten_lists(
        t.scored().select("evidence_id", "candidate_sdgs", "evidence_tags", "computed_score")
    )


@register(
    "evaluation_flat",
    RESULTS_SQL
    + """ SELECT model, item_id, array_to_string(predicted_sdgs, ' | ') AS predicted_sdgs,
    array_to_string(expected_sdgs, ' | ') AS expected_sdgs, stage_exact FROM results""",
)
def evaluation_flat(t):
    return documents.evaluation_flat(
        t.results().select("model", "item_id", "predicted_sdgs", "expected_sdgs", "stage_exact")
    )


# --- report texts as lines ------------------------------------------------------------


def _q(text):
    return "'" + text.replace("'", "''") + "'"


def _lines_sql(source, keys, section, position, *lines):
    """Lines of one section: NULL lines are left out before they are numbered."""
    listed = f"list_filter([{', '.join(lines)}], lambda x: x IS NOT NULL)"
    key_list = "".join(f"{key}, " for key in keys)
    return (
        f"SELECT {key_list}{section} AS section, CAST({position} AS BIGINT) AS position, "
        f"unnest(range(len(l))) AS line_no, unnest(l) AS line "
        f"FROM (SELECT *, {listed} AS l FROM {source})"
    )


def _count(condition, text):
    return f"CASE WHEN {condition} THEN {text} END"


_REPORT_PARTS = [
    ("heads", 10, "0", (
        "concat('# SDG Evidence Report: ', company)",
        "concat('**Report:** ', report_name, ' (', report_year, ')')",
        "'**Generated:** 2024-01-01 12:00:00'", "''", "'---'",
        "'## Caveats and Methodology Notes'", "''", _q(texts.CAVEAT), "''", "'---'",
        "'## Executive Summary'", "''", "concat('**Overall Assessment:** ', label)", "''",
        "concat('- **SDGs covered:** ', n_goals)",
        "concat('- **Valid evidence items:** ', n_valid)",
        "concat('- **Rejected items:** ', n_rejected)",
        _count("n_valid > 0", "concat('- **Average evidence score:** ', printf('%.1f', mean_score), ' / 12')"),
        _count("n_valid > 0", "concat('- **Strength distribution:** strong=', n_strong, ', moderate=', "
               "n_moderate, ', weak=', n_weak)"),
        "''", "'---'", "'## SDG-by-SDG Summary'", "''",
        _count("n_goals = 0", "'*No SDG evidence was extracted.*'"),
    )),
    ("goals", 20, "sdg_num", (
        "concat('### ', sdg)", "concat('- **Evidence items:** ', evidence_count)",
        "concat('- **Average score:** ', printf('%.1f', average_score))",
        "concat('- **Implementation profile:** ', implementation_profile)",
        _count("strongest_pages IS NOT NULL",
               "concat('- **Key pages:** p.', replace(strongest_pages, ',', ', p.'))"),
        "concat('- ', summary)", "''",
    )),
    ("heads", 30, "0", (
        "'---'", "'## Strongest Evidence Items'", "''",
        _count("n_strong = 0", "'*No item reached the strong threshold (score ≥ 6).*'"),
    )),
    ("strong", 31, "item_rank", (
        "concat('**[p.', page_number, '] ', sdgs, '** — Score ', computed_score, '/12 | `', "
        "implementation_stage, '` | ', tags)",
        "'> '", """concat('> *"', evidence_text, '"*')""", "''",
    )),
    ("(SELECT * FROM heads WHERE n_moderate > 0)", 40, "0", (
        "'---'", "concat('## Moderate Evidence (', n_moderate, ' items)')", "''",
        "'| Page | SDGs | Tags | Stage | Score |'", "'|------|------|------|-------|-------|'",
    )),
    ("moderate", 41, "item_rank", (
        "concat('| p.', page_number, ' | ', sdgs, ' | ', tags, ' | ', implementation_stage, ' | ', "
        "computed_score, ' |')",
    )),
    ("heads", 50, "0", (
        _count("n_moderate > 0", "''"), "'---'", "'## Rejected / Uncertain Evidence'", "''",
        "CASE WHEN n_rejected = 0 THEN '*No evidence items were rejected.*' ELSE concat('**', "
        "n_rejected, ' items were rejected** by fixed rules. Common reasons:') END",
        _count("n_rejected > 0", "''"),
    )),
    ("reasons", 51, "rank", ("concat('- `', reason, '` (', n_items, '×)')",)),
    ("(SELECT * FROM heads WHERE n_rejected > 0)", 52, "0", (
        "''", "'*All rejected items are part of the run document.*'",
    )),
    ("failed", 60, "0", ("'---'", "'## Pipeline Errors'", "''")),
    ("(SELECT * FROM rejected WHERE trim(evidence_text) = '')", 61, "0", (
        "concat('- `chunk failed: ', evidence_id, '`')",
    )),
    ("failed", 62, "0", ("''",)),
    ("heads", 70, "0", ("'---'", _q(texts.FOOTER))),
]


def _ranked_sql(strength, n):
    return f"""(SELECT *, array_to_string(candidate_sdgs, ', ') AS sdgs,
      array_to_string(evidence_tags, ', ') AS tags, row_number() OVER (
      PARTITION BY company, report_year ORDER BY computed_score DESC, seq) AS item_rank
      FROM scored WHERE computed_strength = '{strength}' QUALIFY item_rank <= {n})"""


_GOALS_PREFIX = GOAL_MEASURES_SQL + KEY_PAGES_SQL + TOP_TAGS_SQL
REPORT_LINES_SQL = (
    _GOALS_PREFIX
    + f""", goals AS ({ORACLES["findings_goal_summaries"].removeprefix(_GOALS_PREFIX)})"""
    + ASSESSMENT_SQL.removeprefix(SCORED_SQL)
    + f""", summary AS ({ORACLES["findings_executive_summary"].removeprefix(ALL_SCORED_SQL)}),
    reasons AS ({ORACLES["findings_rejection_reasons"].removeprefix(SCORED_SQL)}),
    strong AS {_ranked_sql("strong", 10)}, moderate AS {_ranked_sql("moderate", 20)},
    failed AS (SELECT DISTINCT company, report_year FROM rejected WHERE trim(evidence_text) = ''),
    heads AS (SELECT r.company, r.report_year, r.report_name,
      CASE a.overall_assessment {LABEL_CASES} END AS label, s.mean_score,
      {", ".join(f"coalesce(s.{c}, 0) AS {c}" for c in
                 ("n_goals", "n_valid", "n_rejected", "n_strong", "n_moderate", "n_weak"))}
      FROM reports r JOIN assessed a USING (company, report_year)
      LEFT JOIN summary s USING (company, report_year)) """
    + " UNION ALL ".join(
        _lines_sql(source, findings.REPORT, section, position, *lines)
        for source, section, position, lines in _REPORT_PARTS
    )
)


def report_lines(t):
    records, _, reports, errors = stage_inputs(t)
    tables = report_findings(records, t.reports())
    return texts.report_lines(
        reports, tables["summary"], tables["goals"], tables["strongest"], tables["moderate"],
        tables["reasons"], errors, "2024-01-01 12:00:00",
    )


@register("report_lines", REPORT_LINES_SQL)
def report_lines_query(t):
    return report_lines(t).withColumn("line_no", F.col("line_no").cast("bigint"))


def _value(column, digits):
    return f"CAST(printf('%.{digits}f', {column}) AS DOUBLE)"


_METRICS = [
    "sdg_jaccard_mean", "tag_jaccard_mean", "stage_exact_rate", "stage_overclaim_rate",
    "quant_exact_rate", "oversight_exact_rate", "validation_accuracy", "over_claim_rate",
]
_ITEM_METRICS = [
    "sdg_jaccard", "tag_jaccard", "stage_exact", "stage_overclaim", "quant_exact", "oversight_exact",
    "validation_correct", "quant_overclaim", "oversight_overclaim",
]


def stored_metrics(t):
    """Metrics of every model and item, computed once for texts that read them twice."""
    return staged(t.results().select("model", "item_id", "extracted_count", "valid_count", *_ITEM_METRICS))


@register(
    "scorecard_lines",
    AGGREGATE_SQL
    + " "
    + _lines_sql(
        "aggregates", ["model"], 10, "0", "'# Evaluation Scorecard'",
        "concat('**Chat model:** `', model, '`')", "'**Run at:** 2024-01-01 12:00:00'",
        "concat('**Items evaluated:** ', n)", "''", "'## Aggregate Metrics'", "''",
        "'| Metric | Value |'", "'|--------|-------|'",
        *[f"concat('| {m} | ', {_value(m, 3)}, ' |')" for m in _METRICS],
        "''", "'## Per-Item Results'", "''",
        "'| Item | SDG Jaccard | Tag Jaccard | Stage Match | Over-claim |'",
        "'|------|-------------|-------------|-------------|------------|'",
    )
    + " UNION ALL "
    + _lines_sql(
        "results", ["model"], 20, "0",
        "concat('| ', item_id, ' | ', printf('%.2f', sdg_jaccard), ' | ', "
        "printf('%.2f', tag_jaccard), ' | ', CASE WHEN stage_exact THEN '✓' ELSE '✗' END, ' | ', "
        "CASE WHEN stage_overclaim OR quant_overclaim OR oversight_overclaim THEN '⚠ YES' "
        "ELSE 'no' END, ' |')",
    ),
)
def scorecard_lines(t):
    results = stored_metrics(t)
    lines = texts.scorecard_lines(
        evaluation.aggregate_metrics(results), results, "2024-01-01 12:00:00"
    )
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


_RANKED_LINE = (
    "concat('| ', rank, ' | ', combo_key, ' | ', "
    + ", ' | ', ".join(
        _value(c, d)
        for c, d in (("selection_score", 4), ("over_claim_rate", 3), ("sdg_jaccard_mean", 3),
                     ("stage_exact_rate", 3), ("seconds", 2))
    )
    + ", 's |')"
)


@register(
    "comparison_lines",
    PUBLISHED_SQL
    + f""", timed AS (SELECT model, avg(extracted_count * 2) AS seconds FROM results GROUP BY model),
    combos AS (SELECT *, model || '+' || embedding_model AS combo_key,
      {SCORE_SQL} AS selection_score FROM published JOIN timed USING (model),
      (SELECT unnest(['e1', 'e2']) AS embedding_model, unnest([0, 1]) AS embedding_no)),
    ranked AS (SELECT *, row_number() OVER (ORDER BY selection_score DESC, model, embedding_no)
      AS rank FROM combos) """
    + _lines_sql(
        "(SELECT * FROM ranked WHERE rank = 1)", [], 10, "0",
        "'# Model Comparison Report'", "'**Run at:** 2024-01-01 12:00:00'",
        "'**Benchmark:** items.jsonl'", "''", "'## Recommended Combination'", "''",
        "concat('**', combo_key, '**')",
        f"concat('- Selection score: ', {_value('selection_score', 4)})",
        f"concat('- Over-claim rate: ', {_value('over_claim_rate', 3)})",
        f"concat('- SDG Jaccard mean: ', {_value('sdg_jaccard_mean', 3)})",
        f"concat('- Avg item runtime: ', {_value('seconds', 2)}, 's')",
        "''", "'## All Combinations (ranked)'", "''",
        "'| Rank | Combo | Select Score | Over-claim | SDG Jaccard | Stage Exact | Avg RT |'",
        "'|------|-------|-------------|------------|-------------|-------------|--------|'",
    )
    + " UNION ALL "
    + _lines_sql("ranked", [], 20, "rank", _RANKED_LINE),
)
def comparison_lines(t):
    results = stored_metrics(t).withColumn("runtime_seconds", F.col("extracted_count") * 2)
    combos = evaluation.model_combinations(evaluation.aggregate_metrics(results), ["e1", "e2"])
    times = evaluation.runtime_totals(results).select("model", "avg_item_runtime_seconds")
    ranked = evaluation.rank_models(combos, ["model", "embedding_no"]).join(times, "model")
    lines = texts.comparison_lines(ranked, "items.jsonl", "2024-01-01 12:00:00")
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


# --- measures from stored sums ---------------------------------------------------------

CUT = 1997


def stored_scores(t):
    """The columns that are summed, stored once: each run and the ranks read them."""
    return staged(t.scored().select("company", "report_year", "confidence", "computed_score"))


def stored_sums(t, scored):
    """Sums of the earlier years, then of the later ones, one of them stored twice."""
    path = new_folder(t, "sums")
    for part in (F.col("report_year") < CUT, F.col("report_year") >= CUT, F.col("report_year") == CUT):
        increments.store_years(increments.year_sums(scored.filter(part)), path)
    return increments.stored_years(t.read("nation").sparkSession, path)


@register("table_calibration_stored", ORACLES["table_calibration"])
def table_calibration_stored(t):
    fit = increments.fit_from_sums(stored_sums(t, stored_scores(t)))
    return fit.select(
        "company", "n",
        *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "correlation", "r2", "residual_se")],
    )


@register(
    "table_score_sketches",
    SCORED_SQL
    + """ SELECT company, p AS prob, count(*) AS n, true AS within FROM scored,
    (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[]) AS p) GROUP BY company, p""",
)
def table_score_sketches(t):
    """Quantiles of the score from merged sketches: ranks within 2 % of the asked ones."""
    scored = stored_scores(t)
    found = increments.quantiles_from_sketches(stored_sums(t, scored), [0.1, 0.25, 0.5, 0.75, 0.9])
    off = increments.rank_error(scored, found, "computed_score")
    return off.select("company", "prob", "n", (F.col("error") <= 0.02).alias("within"))
