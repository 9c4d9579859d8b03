"""Domain tables derived from the benchmark schema (orders, documents, vectors).

The functions give Spark frames over the whole given tables; the text blocks
are the same tables as common table expressions for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.text import strip, word_count
from attesta.operators import evaluation, observatory, pages, validation
from attesta.params import ChunkParams, PeriodParams, RetrievalParams
from attesta.plans.report import score_all

CUT_YEAR = 1998
PERIOD = PeriodParams(cut_year=CUT_YEAR)
CHUNKS = ChunkParams(max_tokens=40, overlap_tokens=8, min_tokens=4, block_pages=16)
MODELS = ["m1", "m2", "m3"]
LINES_PER_TASK = 150_000
LEXICON = {
    "en": ["the", "tion", "ing", "and", "hed"],
    "fr": ["eau", "ment", "elle", "que", "la"],
    "de": ["ein", "sch", "ung", "der", "la"],
    "es": ["cion", "los", "que", "ado", "ent"],
}
SEARCH = RetrievalParams(
    top_k=5, lexicon=LEXICON, rhetoric=(r"the ", r"les? "), action=(r"[0-9]{2}", r"@")
)


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- evidence records from order lines -----------------------------------

    def order_lines(self) -> DataFrame:
        """Order lines with their order, customer and nation. The lines move once, by
        order; what groups them by order does not move them again."""
        return self._with_orders(self.read("lineitem"))

    def lines_by_order(self) -> DataFrame:
        """Order lines in tasks of a bounded number of lines, for what sorts the lines of a
        task. Spark sizes tasks by the bytes that move, but a line becomes a far wider
        record for each model, so those tasks spill."""
        lines = self.read("lineitem")
        parts = max(self.spark.sparkContext.defaultParallelism, -(-lines.count() // LINES_PER_TASK))
        return self._with_orders(lines.repartition(parts, "l_orderkey"))

    def _with_orders(self, lines: DataFrame) -> DataFrame:
        orders = (
            self.read("orders")
            .join(self.read("customer"), F.expr("o_custkey = c_custkey"))
            .join(self.read("nation"), F.expr("c_nationkey = n_nationkey"))
        )
        return lines.join(orders, F.expr("l_orderkey = o_orderkey"))

    def evidence(self) -> DataFrame:
        return self.order_lines().selectExpr(*EVIDENCE_COLUMNS)

    def validated(self) -> DataFrame:
        return validation.validate(self.evidence())

    def all_scored(self) -> DataFrame:
        return score_all(self.validated())

    def scored(self) -> DataFrame:
        return validation.valid_only(self.all_scored())

    def rejected(self) -> DataFrame:
        return validation.rejected_only(self.validated())

    def reports(self) -> DataFrame:
        """Expected reports: every company in every order year, and in the year
        before the first one, which has no records."""
        years = self.read("orders").agg(
            F.sequence(
                F.min(F.year("o_orderdate")) - 1, F.max(F.year("o_orderdate"))
            ).alias("y")
        )
        return (
            self.read("nation")
            .withColumn("y", years.scalar())
            .select(F.col("n_name").alias("company"), F.explode("y").alias("report_year"))
            .withColumn(
                "report_name",
                F.concat(F.lit("Annual Report "), F.col("report_year").cast("string")),
            )
        )

    def wide(self) -> DataFrame:
        return observatory.wide_table(self.scored(), params=PERIOD)

    def long(self) -> DataFrame:
        return observatory.long_table(self.wide())

    def runs(self) -> DataFrame:
        return observatory.run_table(self.reports(), self.scored(), self.rejected())

    # --- labelled items and predictions -----------------------------------------

    def items(self) -> DataFrame:
        """One item per order: its first record is the expected one."""
        lines = self.lines_by_order().selectExpr("l_orderkey", *EVIDENCE_COLUMNS)
        expected = F.struct(
            "candidate_sdgs", "evidence_tags", "implementation_stage", "quantitative_support",
            "oversight_support", "company",
        )
        valid = validation.is_valid()
        return (
            lines.withColumn("v", valid)
            .groupBy(F.col("l_orderkey").alias("item_id"))
            .agg(
                F.min_by(expected, "evidence_id").alias("e"), F.min_by("v", "evidence_id").alias("v")
            )
            .select(
                "item_id",
                F.col("e.company").alias("company"),
                F.col("e.candidate_sdgs").alias("expected_sdgs"),
                F.col("e.evidence_tags").alias("expected_evidence_tags"),
                F.col("e.implementation_stage").alias("expected_implementation_stage"),
                F.col("e.quantitative_support").alias("expected_quantitative_support"),
                F.col("e.oversight_support").alias("expected_oversight_support"),
                F.col("v").alias("expected_valid"),
            )
        )

    def predictions(self) -> DataFrame:
        """Records of three models: each model shifts the stage and drops the
        quantitative flag of some records."""
        lines = self.lines_by_order().selectExpr(
            "l_orderkey AS item_id", "l_partkey", *EVIDENCE_COLUMNS
        )
        changed = F.col("l_partkey") % (F.lit(5) + F.col("model_no")) == 0
        shifted = (
            F.when(F.col("implementation_stage") == k.MENTION, k.PLANNED)
            .when(F.col("implementation_stage") == k.PLANNED, k.IN_PROGRESS)
            .otherwise(F.col("implementation_stage"))
        )
        moved = (
            lines.withColumn("model_no", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
            .withColumn("model", F.concat(F.lit("m"), F.col("model_no").cast("string")))
            .withColumn(
                "implementation_stage",
                F.when(changed, shifted).otherwise(F.col("implementation_stage")),
            )
            .withColumn("oversight_support", changed | F.col("oversight_support"))
            .withColumn("seq", F.col("evidence_id"))
        )
        return score_all(validation.validate(moved))

    def results(self) -> DataFrame:
        best = evaluation.best_predictions(self.predictions())
        return evaluation.evaluate_items(self.items(), best, MODELS, ["company"])

    # --- texts --------------------------------------------------------------------

    def text_pages(self) -> DataFrame:
        """Lines of a document as pages; short lines act as headings."""
        split = pages.split_pages(
            self.read("documents").select(F.col("doc_id").alias("report_id"), "text")
        )
        n = word_count("text")
        return split.withColumn(
            "section_heading", F.when(n.between(1, 4), strip("text"))
        )

    def spans(self) -> DataFrame:
        """Words of the whole document as spans of one page; sizes by length."""
        return (
            self.read("documents")
            .select(
                F.col("doc_id").alias("report_id"),
                F.lit(1).alias("page_number"),
                F.posexplode(F.split("text", "[ \n]")).alias("span_no", "text"),
            )
            .withColumn("size", (10 + F.length("text") % 4).cast("double"))
        )

    def vectors(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"), "label"
        )

    def label_queries(self) -> DataFrame:
        """One query per label: the mean vector of the label."""
        entries = self.vectors().select("label", F.posexplode("vector").alias("pos", "v"))
        means = entries.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("m"))
        return means.groupBy(F.col("label").alias("query_id")).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]
            ).alias("vector")
        )

    def document_chunks(self) -> DataFrame:
        """Documents that have a vector, as chunks of their source."""
        return self.read("documents").join(self.vectors(), "doc_id").select(
            F.col("source").alias("report_id"),
            F.col("doc_id").alias("chunk_no"),
            "label",
            "text",
            "vector",
        )

    # --- panel -----------------------------------------------------------------------

    def panel_profiles(self) -> DataFrame:
        """Share of each order priority in a customer's yearly order value."""
        by_category = (
            self.read("orders")
            .withColumn("year", F.year("o_orderdate"))
            .groupBy(
                F.col("o_custkey").alias("entity"),
                "year",
                F.col("o_orderpriority").alias("category"),
            )
            .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
        )
        total = F.sum("cents").over(W.partitionBy("entity", "year"))
        return by_category.withColumn("score", F.lit(100.0) * F.col("cents") / total)

    def panel_entities(self) -> DataFrame:
        sizes = (
            self.read("orders")
            .groupBy(F.col("o_custkey").alias("entity"))
            .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("size"))
        )
        return (
            self.read("customer")
            .join(self.read("nation"), F.expr("c_nationkey = n_nationkey"))
            .join(self.read("region"), F.expr("n_regionkey = r_regionkey"))
            .select(
                F.col("c_custkey").alias("entity"),
                F.col("c_mktsegment").alias("sector"),
                F.col("r_name").alias("country"),
                F.col("c_acctbal").alias("balance"),
            )
            .join(sizes, "entity")
        )


_LINE_ID = (
    "md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INT), "
    "CAST(round(l_extendedprice * 100) AS BIGINT), CAST(l_shipdate AS DATE)))"
)
# An order of extraction that does not follow the ids: a hash of its own.
_SEQ_DIGITS = _LINE_ID.replace("concat_ws('|', ", "concat_ws('|', 'seq', ")
_TEXT = (
    "CASE WHEN l_partkey % 97 = 0 THEN '   ' "
    "WHEN CAST(l_quantity AS INT) % 2 = 0 "
    "THEN concat('reduced by ', CAST(l_quantity AS INT), '% under board review') "
    "ELSE concat('we strive to improve part ', l_partkey) END"
)
EVIDENCE_COLUMNS = [
    f"{_LINE_ID} AS evidence_id",
    f"CAST(conv(substr({_SEQ_DIGITS}, 1, 12), 16, 10) AS BIGINT) AS seq",
    "n_name AS company",
    "CAST(year(o_orderdate) AS INT) AS report_year",
    "CAST(l_partkey % 40 AS INT) AS page_number",
    f"{_TEXT} AS evidence_text",
    (
        "CASE WHEN l_partkey % 53 = 0 THEN CAST(array() AS ARRAY<STRING>) "
        "WHEN l_linenumber >= 3 THEN "
        "array(concat('SDG ', l_suppkey % 18), concat('SDG ', l_partkey % 17 + 1)) "
        "ELSE array(concat('SDG ', l_suppkey % 17 + 1)) END AS candidate_sdgs"
    ),
    (
        "array_compact(array("
        "CASE l_returnflag WHEN 'A' THEN 'policy' WHEN 'N' THEN 'target' ELSE 'aspiration' END, "
        "CASE WHEN round(l_discount * 100) >= 5 THEN 'measured_outcome' END, "
        "CASE WHEN round(l_tax * 100) >= 6 THEN 'governance' END, "
        "CASE WHEN l_quantity > 40 THEN 'kpi' END, "
        "CASE WHEN l_linenumber = 7 AND l_partkey % 11 = 0 THEN 'action_item' END)) "
        "AS evidence_tags"
    ),
    (
        "CASE WHEN l_partkey % 61 = 0 THEN 'active' ELSE element_at(array('mention_only', "
        "'planned_action', 'implementation_in_progress', "
        "'implemented_with_measurable_evidence'), CAST(l_quantity AS INT) % 4 + 1) END "
        "AS implementation_stage"
    ),
    "round(l_discount * 100) >= 6 AS quantitative_support",
    "round(l_tax * 100) >= 7 AS oversight_support",
    "round(l_discount * 100) / 10 AS confidence",
]

# ---------------------------------------------------------------------------------
# The same tables as SQL
# ---------------------------------------------------------------------------------

_SQL_FIELDS = f"""
  {_LINE_ID} AS evidence_id,
  CAST('0x' || substr({_SEQ_DIGITS}, 1, 12) AS BIGINT) AS seq,
  n_name AS company,
  CAST(year(o_orderdate) AS INT) AS report_year,
  CAST(l_partkey % 40 AS INT) AS page_number,
  {_TEXT} AS evidence_text,
  CASE WHEN l_partkey % 53 = 0 THEN []::VARCHAR[]
       WHEN l_linenumber >= 3 THEN ['SDG ' || (l_suppkey % 18), 'SDG ' || (l_partkey % 17 + 1)]
       ELSE ['SDG ' || (l_suppkey % 17 + 1)] END AS candidate_sdgs,
  list_filter([
    CASE l_returnflag WHEN 'A' THEN 'policy' WHEN 'N' THEN 'target' ELSE 'aspiration' END,
    CASE WHEN round(l_discount * 100) >= 5 THEN 'measured_outcome' END,
    CASE WHEN round(l_tax * 100) >= 6 THEN 'governance' END,
    CASE WHEN l_quantity > 40 THEN 'kpi' END,
    CASE WHEN l_linenumber = 7 AND l_partkey % 11 = 0 THEN 'action_item' END
  ], lambda x: x IS NOT NULL) AS evidence_tags,
  CASE WHEN l_partkey % 61 = 0 THEN 'active'
       ELSE (['mention_only', 'planned_action', 'implementation_in_progress',
              'implemented_with_measurable_evidence'])[CAST(l_quantity AS INT) % 4 + 1]
  END AS implementation_stage,
  round(l_discount * 100) >= 6 AS quantitative_support,
  round(l_tax * 100) >= 7 AS oversight_support,
  round(l_discount * 100) / 10 AS confidence"""

_SQL_FROM = """
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

EVIDENCE_SQL = f"lines AS (SELECT l_orderkey, l_partkey, {_SQL_FIELDS} {_SQL_FROM}), evidence AS (SELECT * EXCLUDE (l_orderkey, l_partkey) FROM lines)"

_GOAL_LIST = "[" + ", ".join(f"'{g}'" for g in k.GOALS) + "]"
_TAG_LIST = "[" + ", ".join(f"'{t}'" for t in k.TAGS) + "]"
_STAGE_LIST = "[" + ", ".join(f"'{s}'" for s in k.STAGES) + "]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list_text(expr: str) -> str:
    return (
        f"'[' || array_to_string(list_transform({expr}, lambda x: '''' || x || ''''), ', ') || ']'"
    )


_BAD_GOALS = f"list_filter(candidate_sdgs, lambda x: NOT list_contains({_GOAL_LIST}, x))"
_BAD_TAGS = f"list_filter(evidence_tags, lambda x: NOT list_contains({_TAG_LIST}, x))"
_STAGE_MSG = k.MSG_STAGE.format(value="\0", allowed=str(sorted(k.STAGES))).split("\0")
RULES_SQL = {
    "page": "coalesce(page_number, 0) < 1",
    "text": "trim(evidence_text) = ''",
    "no_goals": "len(candidate_sdgs) = 0",
    "bad_goals": f"len({_BAD_GOALS}) > 0",
    "stage": f"NOT list_contains({_STAGE_LIST}, implementation_stage)",
    "tags_type": "evidence_tags IS NULL",
    "bad_tags": f"len({_BAD_TAGS}) > 0",
    "outcome": "list_contains(evidence_tags, 'measured_outcome') AND NOT quantitative_support",
    "governance": "list_contains(evidence_tags, 'governance') AND NOT oversight_support",
    "measurable": "implementation_stage = 'implemented_with_measurable_evidence' "
    "AND NOT quantitative_support",
}
_MESSAGES_SQL = {
    "page": _quoted(k.MSG_PAGE),
    "text": _quoted(k.MSG_TEXT),
    "no_goals": _quoted(k.MSG_NO_GOALS),
    "bad_goals": f"{_quoted(k.MSG_BAD_GOALS)} || {_list_text(_BAD_GOALS)}",
    "stage": f"{_quoted(_STAGE_MSG[0])} || implementation_stage || {_quoted(_STAGE_MSG[1])}",
    "tags_type": _quoted(k.MSG_TAGS_TYPE),
    "bad_tags": f"{_quoted(k.MSG_BAD_TAGS)} || {_list_text(_BAD_TAGS)}",
    "outcome": _quoted(k.MSG_OUTCOME),
    "governance": _quoted(k.MSG_GOVERNANCE),
    "measurable": _quoted(k.MSG_MEASURABLE),
}


def checked_sql(source: str, target: str) -> str:
    """CTEs that add errors, status, score and strength to a record table."""
    cases = ", ".join(
        f"CASE WHEN {cond} THEN {_MESSAGES_SQL[name]} END" for name, cond in RULES_SQL.items()
    )
    stage = " ".join(f"WHEN '{s}' THEN {p}" for s, p in k.STAGE_POINTS.items())
    tag = " ".join(f"WHEN '{t}' THEN {p}" for t, p in k.TAG_POINTS.items())
    return f"""{target}_e AS (SELECT *, list_filter([{cases}], lambda x: x IS NOT NULL)
      AS validation_errors FROM {source}),
    {target}_s AS (SELECT *, CASE WHEN len(validation_errors) = 0 THEN 'valid' ELSE 'rejected' END
      AS validation_status FROM {target}_e),
    {target}_p AS (SELECT *, CASE WHEN validation_status = 'valid' THEN CAST(least(12,
        CASE implementation_stage {stage} ELSE 1 END
        + coalesce(list_sum(list_transform(evidence_tags, lambda t: CASE t {tag} ELSE 0 END)), 0)
        + CAST(quantitative_support AS INT) + CAST(oversight_support AS INT)) AS INT) END
      AS computed_score FROM {target}_s),
    {target} AS (SELECT *, CASE WHEN computed_score <= 2 THEN 'weak'
        WHEN computed_score <= 5 THEN 'moderate' WHEN computed_score > 5 THEN 'strong' END
      AS computed_strength,
      CASE implementation_stage {stage} END AS stage_rank,
      CASE WHEN report_year <= {CUT_YEAR} THEN 'before' ELSE 'after' END AS period
      FROM {target}_p)"""


ALL_SCORED_SQL = f"WITH {EVIDENCE_SQL}, {checked_sql('evidence', 'all_scored')}"
SCORED_SQL = (
    ALL_SCORED_SQL
    + ", scored AS (SELECT * FROM all_scored WHERE validation_status = 'valid')"
    + ", rejected AS (SELECT * FROM all_scored WHERE validation_status = 'rejected')"
)
LONG_SQL = (
    SCORED_SQL
    + ", long AS (SELECT *, CAST(regexp_extract(sdg, '\\d+') AS INT) AS sdg_num "
    "FROM (SELECT *, unnest(candidate_sdgs) AS sdg FROM scored))"
)
REPORTS_SQL = """reports AS (SELECT n_name AS company, CAST(y AS INT) AS report_year,
    'Annual Report ' || y AS report_name
  FROM nation, (SELECT unnest(range(
    (SELECT min(year(o_orderdate)) - 1 FROM orders),
    (SELECT max(year(o_orderdate)) + 1 FROM orders))) AS y))"""
RUNS_SQL = (
    LONG_SQL
    + f", {REPORTS_SQL}, runs AS (SELECT r.*, "
    "coalesce(v.n, 0) AS n_valid, coalesce(x.n, 0) AS n_rejected, "
    "CASE WHEN coalesce(v.n, 0) + coalesce(x.n, 0) > 0 THEN CAST(coalesce(x.n, 0) AS DOUBLE) "
    "/ (coalesce(v.n, 0) + coalesce(x.n, 0)) END AS rejection_rate FROM reports r "
    "LEFT JOIN (SELECT company, report_year, count(*) AS n FROM scored GROUP BY ALL) v "
    "USING (company, report_year) "
    "LEFT JOIN (SELECT company, report_year, count(*) AS n FROM rejected GROUP BY ALL) x "
    "USING (company, report_year))"
)
SPACE_CLASS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def words_sql(col: str) -> str:
    return f"list_filter(string_split_regex({col}, '{SPACE_CLASS}+'), lambda x: x <> '')"


def strip_sql(col: str) -> str:
    return f"regexp_replace(regexp_replace({col}, '^{SPACE_CLASS}+', ''), '{SPACE_CLASS}+$', '')"


PAGES_SQL = f"""WITH split AS (SELECT doc_id AS report_id,
    unnest(string_split(text, chr(10))) AS text,
    CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INT) AS page_number
  FROM documents),
pages_w AS (SELECT *, {words_sql('text')} AS w FROM split),
text_pages AS (SELECT report_id, page_number, text, w, len(w) AS n_words,
    CASE WHEN len(w) BETWEEN 1 AND 4 THEN {strip_sql('text')} END AS section_heading
  FROM pages_w)"""
