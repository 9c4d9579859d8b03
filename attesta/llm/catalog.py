"""Registered queries of the corpus operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from attesta.llm import alignment, bpe, decontam, exactdedup, hamming, idpack, langid, periodic, pii, quality, secrets, simhash, urlfilter
from attesta.llm.common import table

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


URL_RULES = [
    urlfilter.Rule("block", "net", "/"),
    urlfilter.Rule("allow", "example.net", "/en/"),
    urlfilter.Rule("block", "example.com", "/de/"),
    urlfilter.Rule("allow", "org", "/fr/"),
]


@register(
    "op10_url_filter",
    r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
keyed AS (
  SELECT *, try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})(?:\.html|/)?$', 1), '') AS BIGINT) AS n
  FROM parts),
bad AS (
  SELECT DISTINCT host || path AS key FROM keyed
  WHERE n IN (SELECT doc_id FROM labels WHERE quality = 0)),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule,
    host || path IN (SELECT key FROM bad) AS listed
  FROM keyed)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM ruled
""",
)
def _url_filter(spark, folder):
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    return urlfilter.judge(pages, urlfilter.low_quality_keys(pages, labels), URL_RULES)


@register("op7_simhash_groups")
def _simhash_groups(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@register("op1_personal_data")
def _personal_data(spark, folder):
    return pii.find_personal_data(table(spark, folder, "documents"))


@register("op4_secrets")
def _secrets(spark, folder):
    return secrets.find_secrets(table(spark, folder, "documents"))


@register("op6_packed_ids")
def _packed_ids(spark, folder):
    blocks = idpack.pack_documents(table(spark, folder, "documents"))
    return idpack.read_documents(blocks)


@register("op8_bpe_round_trip")
def _bpe_round_trip(spark, folder):
    return bpe.encode_documents(table(spark, folder, "documents"))


@register(
    "op3_hamming_top_k",
    """
WITH codes AS (
  SELECT DISTINCT vec_id AS id, [coalesce(x > 0, false) for x in embedding] AS bits
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
  SELECT q.id AS query_id, c.id AS neighbor_id,
    list_sum([CAST(p[1] <> p[2] AS INTEGER) for p in list_zip(q.bits, c.bits)]) AS distance
  FROM codes q JOIN codes c ON q.id <> c.id WHERE q.id % 100 = 0),
ranked AS (
  SELECT query_id, neighbor_id, CAST(distance AS INTEGER) AS distance,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank
  FROM pairs)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
""",
)
def _hamming_top_k(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), hamming.code_of(F.col("embedding")).alias("code")
    )
    return hamming.nearest(rows, rows.filter(F.col("id") % 100 == 0))


@register("op2_language")
def _language(spark, folder):
    return langid.predict(table(spark, folder, "documents"))


@register("op9_quality")
def _quality(spark, folder):
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register("op5_leaks")
def _leaks(spark, folder):
    return decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@register(
    "op13_exact_copies",
    """
WITH rows AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM rows
""",
)
def _exact_copies(spark, folder):
    return exactdedup.find_copies(table(spark, folder, "documents"))


@register("op12_token_alignment")
def _token_alignment(spark, folder):
    return alignment.align_documents(table(spark, folder, "documents"))


@register("op11_periodic_runs")
def _periodic_runs(spark, folder):
    found = periodic.find_runs(periodic.with_planted_runs(table(spark, folder, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.start.alias("start"),
        best.length.alias("length"), best.period.alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
