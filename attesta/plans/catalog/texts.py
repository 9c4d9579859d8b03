"""Pages, chunks, retrieval and responses."""

import uuid

from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.text import left_out, preview
from attesta.functions.vectors import cosine, norm
from attesta.operators import chunking, extraction, pages, retrieval
from attesta.params import ExtractionParams, RetrievalParams
from attesta.plans.catalog import register
from attesta.plans.driver_tables import (
    CHUNKS,
    EVIDENCE_SQL,
    LEXICON,
    PAGES_SQL,
    SEARCH,
    strip_sql,
    words_sql,
)
from attesta.staging import shared_folder

# --- pages ---------------------------------------------------------------------------


@register(
    "pages_split",
    PAGES_SQL + " SELECT report_id, page_number, length(text) AS n_chars, n_words, text FROM text_pages",
)
def pages_split(t):
    stats = chunking.word_stats(t.text_pages())
    return stats.select(
        "report_id", "page_number", F.length("text").cast("bigint").alias("n_chars"),
        F.col("n_words").cast("bigint").alias("n_words"), "text",
    )


@register(
    "pages_clean",
    """SELECT page_id AS report_id, trim(regexp_replace(translate(regexp_replace(html,
    '\n{3,}', '\n\n', 'g'), chr(9), ' '), ' {2,}', ' ', 'g'), e' \\n\\t\\r') AS text FROM pages""",
)
def pages_clean(t):
    source = t.read("pages").select(
        F.col("page_id").alias("report_id"), F.lit(1).alias("page_number"), F.col("html").alias("text")
    )
    return pages.clean_pages(source).select("report_id", "text")


@register(
    "pages_sparse",
    PAGES_SQL
    + """ SELECT report_id, page_number, length(text) AS n_chars FROM text_pages
    WHERE length(text) < 30""",
)
def pages_sparse(t):
    return pages.sparse_pages(t.text_pages()).withColumn("n_chars", F.col("n_chars").cast("bigint"))


@register(
    "pages_sparse_summary",
    PAGES_SQL
    + """ SELECT report_id, count(*) AS n_pages, count(*) FILTER (length(text) < 30) AS n_sparse,
    min(page_number) FILTER (length(text) < 30) AS first_sparse,
    max(page_number) FILTER (length(text) < 30) AS last_sparse FROM text_pages GROUP BY report_id""",
)
def pages_sparse_summary(t):
    return pages.sparse_summary(t.text_pages())


@register(
    "pages_headings",
    f"""WITH raw AS (SELECT doc_id AS report_id, unnest(string_split_regex(text, '[ \\n]')) AS w,
      generate_subscripts(string_split_regex(text, '[ \\n]'), 1) AS no FROM documents),
    s AS (SELECT report_id, no, {strip_sql('w')} AS txt, 10 + length(w) % 4 AS size,
      len({words_sql('w')}) AS nw FROM raw WHERE {strip_sql('w')} <> ''),
    med AS (SELECT report_id, list_sort(list(size))[count(*) // 2 + 1] AS m FROM s GROUP BY 1),
    r AS (SELECT s.*, m, row_number() OVER (PARTITION BY report_id ORDER BY no) AS rn
      FROM s JOIN med USING (report_id)),
    f AS (SELECT *, size >= m * 1.1 AND nw <= 15 AS big FROM r WHERE rn <= 10),
    c AS (SELECT report_id, coalesce(min(rn) FILTER (NOT big), 99) AS cut,
      min(txt ORDER BY rn) FILTER (rn <= 5 AND upper(txt) = txt AND lower(txt) <> txt
        AND nw BETWEEN 2 AND 15 AND length(txt) > 3) AS caps FROM f GROUP BY 1)
    SELECT report_id, coalesce(string_agg(txt, ' ' ORDER BY rn) FILTER (rn < cut), any_value(caps))
      AS section_heading FROM f JOIN c USING (report_id) GROUP BY report_id
    HAVING section_heading IS NOT NULL""",
)
def pages_headings(t):
    return pages.detect_headings(t.spans()).drop("page_number")


# --- chunks --------------------------------------------------------------------------

_MAX, _STEP, _MIN = CHUNKS.max_words, CHUNKS.step, CHUNKS.min_words
SECTION_SQL = (
    PAGES_SQL
    + """, seen AS (SELECT *, last_value(section_heading IGNORE NULLS) OVER (PARTITION BY report_id
      ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
      row_number() OVER (PARTITION BY report_id ORDER BY page_number) AS rn FROM text_pages),
    marked AS (SELECT *, sum(CASE WHEN section_heading IS NOT NULL AND rn > 1
      AND section_heading <> coalesce(before, '') THEN 1 ELSE 0 END) OVER (PARTITION BY report_id
      ORDER BY page_number) AS g FROM seen),
    sections AS (SELECT report_id, g, min(page_number) AS page_number,
      coalesce(max(section_heading), 'Unknown Section') AS section_heading,
      string_agg(text, chr(10) || chr(10) ORDER BY page_number) FILTER (n_words > 0) AS body,
      flatten(list(w ORDER BY page_number)) AS w FROM marked GROUP BY report_id, g)"""
)
CHUNK_SQL = f""", sized AS (SELECT *, len(w) AS total, CASE WHEN len(w) <= {_MAX} THEN 1
      ELSE CAST(ceil(len(w) / {float(_STEP)}) AS BIGINT) END AS n_win FROM source_table),
    windows AS (SELECT *, unnest(range(n_win)) AS i FROM sized WHERE total > 0),
    cut AS (SELECT *, CASE WHEN total <= {_MAX} THEN {strip_sql('body')}
      ELSE array_to_string(list_slice(w, i * {_STEP} + 1, i * {_STEP} + {_MAX}), ' ') END AS text,
      CASE WHEN total <= {_MAX} THEN total ELSE least({_MAX}, total - i * {_STEP}) END AS n
      FROM windows),
    kept AS (SELECT * FROM cut WHERE floor(n / 0.75) >= {CHUNKS.min_tokens}),
    per AS (SELECT report_id, g, count(*) AS c FROM kept GROUP BY 1, 2),
    ahead AS (SELECT report_id, g, coalesce(sum(c) OVER (PARTITION BY report_id ORDER BY g
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM per),
    chunks AS (SELECT report_id, CAST(base + i AS BIGINT) AS chunk_no, page_number, section_heading,
      text FROM kept JOIN ahead USING (report_id, g))
    SELECT report_id, chunk_no, 'chunk_' || page_number || '_' || chunk_no || '_' || substr(md5(
      page_number || ':' || chunk_no || ':' || substr(text, 1, 80)), 1, 8) AS chunk_id,
    page_number, section_heading, text FROM chunks"""


@register(
    "chunk_sections",
    SECTION_SQL
    + """ SELECT m.report_id, m.page_number, s.page_number AS section_start, s.section_heading,
    m.n_words FROM marked m JOIN sections s USING (report_id, g)""",
)
def chunk_sections(t):
    return chunking.locate_sections(chunking.page_words(t.text_pages()), CHUNKS).withColumn(
        "n_words", F.col("n_words").cast("bigint")
    )


@register("chunk_by_section", SECTION_SQL + CHUNK_SQL.replace("source_table", "sections"))
def chunk_by_section(t):
    return chunking.chunk_pages(t.text_pages(), CHUNKS)


@register(
    "chunk_by_page",
    PAGES_SQL
    + """, paged AS (SELECT report_id, page_number AS g, page_number, text AS body, w,
      coalesce(section_heading, 'Page ' || page_number) AS section_heading FROM text_pages)"""
    + CHUNK_SQL.replace("source_table", "paged"),
)
def chunk_by_page(t):
    return chunking.chunk_pages(t.text_pages(), CHUNKS, by_section=False)


@register(
    "chunk_word_stats",
    f"""SELECT doc_id, len({words_sql('text')}) AS n_words,
    CAST(floor(len({words_sql('text')}) / 0.75) AS INT) AS n_tokens FROM documents""",
)
def chunk_word_stats(t):
    return chunking.word_stats(t.read("documents")).select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), "n_tokens"
    )


@register(
    "text_truncation",
    "SELECT doc_id, md5(text) AS embed_text, greatest(len(text) - 8000, 0) AS left_out_of_8000, "
    "substr(text, 1, 100) AS preview FROM documents",
)
def text_truncation(t):
    return t.read("documents").select(
        "doc_id",
        F.md5(preview(F.col("text"), SEARCH.embed_chars)).alias("embed_text"),
        left_out("text", 8000).cast("bigint").alias("left_out_of_8000"),
        preview("text", 100).alias("preview"),
    )


# --- retrieval -----------------------------------------------------------------------

_KEYWORDS = list(dict.fromkeys(w for group in LEXICON.values() for w in group))
_HITS = (
    "list_filter(["
    + ", ".join(f"CASE WHEN contains(lower(text), '{w}') THEN '{w}' END" for w in _KEYWORDS)
    + "], lambda x: x IS NOT NULL)"
)


@register(
    "retrieval_keyword_hits",
    f"""SELECT doc_id, array_to_string({_HITS}, ',') AS keyword_hits,
    least(len({_HITS}) / 8.0::DOUBLE, 1.0::DOUBLE) AS keyword_score FROM documents""",
)
def retrieval_keyword_hits(t):
    hits = retrieval.keyword_hits(F.col("text"), LEXICON)
    return t.read("documents").select("doc_id", hits.alias("h")).select(
        "doc_id",
        F.array_join("h", ",").alias("keyword_hits"),
        retrieval.keyword_score("h").alias("keyword_score"),
    )


def _goal_hit_sql(text):
    words = list(dict.fromkeys(w for group in k.GOAL_KEYWORDS.values() for w in group))
    cases = ", ".join(f"CASE WHEN contains(lower({text}), '{w}') THEN '{w}' END" for w in words)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


@register(
    "retrieval_goal_keyword_hits",
    f"SELECT doc_id, array_to_string({_goal_hit_sql('text')}, ',') AS keyword_hits FROM documents",
)
def retrieval_goal_keyword_hits(t):
    return t.read("documents").select(
        "doc_id",
        F.array_join(retrieval.keyword_hits(F.col("text"), k.GOAL_KEYWORDS), ",").alias(
            "keyword_hits"
        ),
    )


@register(
    "retrieval_keyword_profile",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id, '{c}' AS category, CAST("
        + " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in dict.fromkeys(words))
        + " AS INT) AS n_hits FROM documents"
        for c, words in LEXICON.items()
    )
    + ") WHERE n_hits > 0",
)
def retrieval_keyword_profile(t):
    return retrieval.keyword_profile(t.read("documents"), ["doc_id"], SEARCH)


_RHETORIC = "|".join(f"(?:{p})" for p in k.RHETORIC_PATTERNS)
_ACTION = "|".join(
    f"(?:{p})" for p in k.ACTION_PATTERNS if "³" not in p
) + r"|(?:\bm[3³]\b)"


@register(
    "retrieval_rhetoric",
    f"""WITH {EVIDENCE_SQL} SELECT evidence_id, regexp_matches(evidence_text, '(?i){_RHETORIC}')
    AND NOT regexp_matches(evidence_text, '(?i){_ACTION}') AS rhetoric FROM evidence""",
)
def retrieval_rhetoric(t):
    return t.evidence().select(
        "evidence_id", retrieval.is_rhetoric(F.col("evidence_text")).alias("rhetoric")
    )


QUERY_SQL = """WITH entries AS (SELECT label, unnest(embedding)::DOUBLE AS v,
    generate_subscripts(embedding, 1) AS pos FROM embeddings),
  means AS (SELECT label, pos, avg(v) AS m FROM entries GROUP BY 1, 2),
  queries AS (SELECT label AS query_id, list(m ORDER BY pos) AS qv FROM means GROUP BY 1),
  vecs AS (SELECT vec_id AS doc_id, label, embedding::DOUBLE[] AS v FROM embeddings)"""
_COSINE = """CASE WHEN list_dot_product(qv, qv) = 0 OR list_dot_product(v, v) = 0 THEN 0
    ELSE list_dot_product(qv, v) / (sqrt(list_dot_product(qv, qv)) * sqrt(list_dot_product(v, v)))
    END"""
SIMILAR_SQL = (
    QUERY_SQL + f", sims AS (SELECT query_id, doc_id, label, {_COSINE} AS similarity FROM vecs, queries)"
)


def similarities(t):
    paired = retrieval.pair_with_queries(
        t.vectors().withColumn("n", norm(F.col("vector"))), t.label_queries(), F.col("doc_id")
    )
    return paired.withColumn(
        "similarity",
        cosine(F.col("query_vector"), F.col("vector"), F.col("query_norm"), F.col("n")),
    ).select("query_id", "doc_id", "label", "similarity")


@register(
    "retrieval_similarity",
    SIMILAR_SQL + " SELECT query_id, doc_id, round(similarity, 6) AS similarity FROM sims",
)
def retrieval_similarity(t):
    return similarities(t).select(
        "query_id", "doc_id", F.round("similarity", 6).alias("similarity")
    )


@register(
    "retrieval_blended_query",
    QUERY_SQL
    + """, other AS (SELECT list(m ORDER BY pos) AS ov FROM (SELECT pos, avg(v) AS m FROM entries
      GROUP BY pos)),
    mixed AS (SELECT query_id, list_transform(list_zip(qv, ov), lambda p: (p[1] + p[2]) / 2.0::DOUBLE)
      AS mv FROM queries, other)
    SELECT query_id, pos, round(x / CASE WHEN n = 0 THEN 1 ELSE n END, 6) AS value FROM (
      SELECT query_id, unnest(mv) AS x, CAST(generate_subscripts(mv, 1) - 1 AS INT) AS pos,
      sqrt(list_dot_product(mv, mv)) AS n FROM mixed)""",
)
def retrieval_blended_query(t):
    queries = t.label_queries()
    overall = (
        t.vectors()
        .select(F.posexplode("vector").alias("pos", "v"))
        .groupBy("pos")
        .agg(F.avg(F.col("v").cast("double")).alias("m"))
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]
            ).alias("vector")
        )
    )
    extra = queries.select("query_id").withColumn("vector", overall.scalar())
    return retrieval.blend_queries(queries, extra).select(
        "query_id", F.posexplode("vector").alias("pos", "value")
    ).withColumn("value", F.round("value", 6))


HYBRID_SQL = (
    SIMILAR_SQL
    + f""", scored AS (SELECT d.source AS report_id, s.query_id, s.doc_id AS chunk_no, similarity,
      least(len({_HITS}) / 8.0::DOUBLE, 1.0::DOUBLE) AS keyword_score,
      regexp_matches(text, '(?i)the |les? ') AND NOT regexp_matches(text, '[0-9]{{2}}|@')
        AS rhetoric FROM sims s JOIN documents d USING (doc_id)),
    hybrid AS (SELECT *, CASE WHEN rhetoric THEN 0.3::DOUBLE ELSE 1 END
      * (0.6::DOUBLE * similarity + 0.4::DOUBLE * keyword_score) AS raw_score FROM scored)"""
)


@register(
    "retrieval_hybrid_scores",
    HYBRID_SQL
    + """ SELECT report_id, query_id, chunk_no, rhetoric, keyword_score,
    round(raw_score, 6) AS raw_score FROM hybrid""",
)
def retrieval_hybrid_scores(t):
    scored = retrieval.score_chunks(t.document_chunks(), t.label_queries(), SEARCH)
    return scored.select(
        "report_id", "query_id", "chunk_no", "rhetoric", "keyword_score",
        F.round("raw_score", 6).alias("raw_score"),
    )


@register(
    "retrieval_top_chunks",
    HYBRID_SQL
    + """ SELECT report_id, query_id, chunk_no, chunk_rank, round(raw_score, 4) AS retrieval_score
    FROM (SELECT *, row_number() OVER (PARTITION BY report_id, query_id
      ORDER BY raw_score DESC, chunk_no) AS chunk_rank FROM hybrid WHERE raw_score >= 0.15)
    WHERE chunk_rank <= 5""",
)
def retrieval_top_chunks(t):
    return retrieval.retrieve(t.document_chunks(), t.label_queries(), SEARCH).select(
        "report_id", "query_id", "chunk_no", F.col("chunk_rank").cast("bigint").alias("chunk_rank"),
        "retrieval_score",
    )


NEAREST = RetrievalParams(top_k=10, vector_weight=1.0, keyword_weight=0.0, rhetoric_factor=1.0, floor=-1.0)


@register(
    "retrieval_nearest",
    SIMILAR_SQL
    + """ SELECT query_id, doc_id, CAST(rank AS INT) AS rank, round(similarity, 6) AS similarity
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS rank
      FROM sims) WHERE rank <= 10""",
)
def retrieval_nearest(t):
    """The nearest vectors of every query, over all vectors as one group."""
    chunks = t.vectors().select(F.col("doc_id").alias("chunk_no"), F.lit("").alias("text"), "vector")
    best = retrieval.best_chunks(chunks, t.label_queries(), NEAREST, ["chunk_no"], [])
    return best.select(
        "query_id", F.col("chunk_no").alias("doc_id"), F.col("chunk_rank").alias("rank"),
        F.round("similarity", 6).alias("similarity"),
    )


def letter_vectors(texts: list[str]) -> list[list[float]]:
    """A stand-in embedder: letter counts of a text."""
    return [[float(text.count(letter)) for letter in "aeiounrst"] for text in texts]


@register(
    "retrieval_embed_function",
    "SELECT doc_id, "
    + ", ".join(
        f"CAST(len(text) - len(replace(text, '{c}', '')) AS DOUBLE)"
        f" AS n_{c}"
        for c in "aeiounrst"
    )
    + " FROM documents",
)
def retrieval_embed_function(t):
    embedded = retrieval.embed_texts(t.read("documents"), letter_vectors, SEARCH)
    return embedded.select(
        "doc_id",
        *[F.col("vector")[i].cast("double").alias(f"n_{c}") for i, c in enumerate("aeiounrst")],
    )


# --- responses -----------------------------------------------------------------------


def responses(t):
    """Model answers per company, year and page, built from the records and
    damaged in several ways by page number. One answer holds a few records."""
    flag = F.when(F.col("page_number") % 6 == 4, F.to_json(F.struct(F.lit("false").alias("v"))))
    item = F.struct(
        "evidence_text",
        F.col("evidence_text").alias("evidence_summary"),
        "candidate_sdgs",
        "evidence_tags",
        "implementation_stage",
        F.when(flag.isNotNull(), F.lit("false"))
        .otherwise(F.col("quantitative_support").cast("string"))
        .alias("quantitative_support"),
        "oversight_support",
        "confidence",
        F.lit("because").alias("rationale"),
    )
    record = F.concat(
        F.lit('{"evidence_items":['), F.to_json(item), F.lit("]}")
    )
    kind = F.col("page_number") % 6
    return t.evidence().select(
        "evidence_id",
        "page_number",
        F.when(kind == 0, F.concat(F.lit("```json\n"), record, F.lit("\n```")))
        .when(kind == 1, F.concat(F.lit("Here it is: "), record, F.lit(" Regards.")))
        .when(kind == 2, F.substring(record, 1, 40))
        .when(kind == 3, F.concat(F.lit("["), record, F.lit("]")))
        .otherwise(record)
        .alias("raw_response"),
    )


@register(
    "response_status",
    f"""WITH {EVIDENCE_SQL} SELECT evidence_id, CASE page_number % 6
    WHEN 2 THEN 'no JSON in response' WHEN 3 THEN 'response is not an object' END AS parse_error,
    CASE WHEN page_number % 6 IN (2, 3) THEN -1 ELSE 1 END AS n_items FROM evidence""",
)
def response_status(t):
    parsed = extraction.parse_responses(responses(t))
    return parsed.select(
        "evidence_id", "parse_error", F.coalesce(F.size("items"), F.lit(-1)).alias("n_items")
    )


@register(
    "response_records",
    f"""WITH {EVIDENCE_SQL} SELECT evidence_id, {strip_sql('evidence_text')} AS evidence_text,
    array_to_string(candidate_sdgs, ',') AS sdgs, array_to_string(evidence_tags, ',') AS tags,
    implementation_stage, true AS quantitative_support, oversight_support,
    confidence FROM evidence WHERE page_number % 6 NOT IN (2, 3) AND trim(evidence_text) <> ''""",
)
def response_records(t):
    parsed = extraction.parse_responses(responses(t))
    return extraction.coerce_items(extraction.response_items(parsed)).select(
        "evidence_id",
        "evidence_text",
        F.array_join("candidate_sdgs", ",").alias("sdgs"),
        F.array_join("evidence_tags", ",").alias("tags"),
        "implementation_stage",
        "quantitative_support",
        "oversight_support",
        "confidence",
    )


@register(
    "response_errors",
    f"""WITH {EVIDENCE_SQL} SELECT evidence_id, 'extraction' AS stage,
    CASE page_number % 6 WHEN 2 THEN 'no JSON in response' ELSE 'response is not an object' END
    AS message FROM evidence WHERE page_number % 6 IN (2, 3)""",
)
def response_errors(t):
    parsed = extraction.parse_responses(responses(t))
    return extraction.error_table(parsed, ["evidence_id"], "extraction", "parse_error")


def repeated_entries(t):
    """Answers with zero to seven entries, by page; some have no list at all."""
    item = F.to_json(
        F.struct(
            "evidence_text", F.col("evidence_text").alias("evidence_summary"), "candidate_sdgs",
            "evidence_tags", "implementation_stage", "quantitative_support", "oversight_support",
            "confidence", F.lit("because").alias("rationale"),
        )
    )
    page = F.col("page_number")
    copies = F.array_join(F.array_repeat(item, (page % 8).cast("int")), ",")
    partial = F.lit('{"evidence_text":"x"}')
    listed = F.when(page % 8 > 6, F.concat(partial, F.lit(","), copies)).otherwise(copies)
    raw = F.when(page % 11 == 0, F.lit('{"evidence_items":"none"}')).otherwise(
        F.concat(F.lit('{"evidence_items":['), listed, F.lit("]}"))
    )
    return t.evidence().select("evidence_id", raw.alias("raw_response"))


@register(
    "response_dropped_entries",
    f"""WITH {EVIDENCE_SQL}, sized AS (SELECT evidence_id, trim(evidence_text) = '' AS blank,
      page_number % 11 = 0 AS no_list, page_number % 8 > 6 AS extra,
      page_number % 8 + CASE WHEN page_number % 8 > 6 THEN 1 ELSE 0 END AS n FROM evidence),
    listed AS (SELECT *, unnest(range(n)) AS item_no FROM sized WHERE NOT no_list)
    SELECT evidence_id, CAST(NULL AS INT) AS item_no, 'entries are not a list' AS reason
    FROM sized WHERE no_list
    UNION ALL SELECT evidence_id, CAST(item_no AS INT), CASE WHEN item_no >= 5
      THEN 'beyond the entry limit' WHEN extra AND item_no = 0 THEN 'field missing'
      ELSE 'no evidence text' END FROM listed
    WHERE item_no >= 5 OR (extra AND item_no = 0) OR blank""",
)
def response_dropped_entries(t):
    parsed = extraction.parse_responses(repeated_entries(t))
    return extraction.dropped_entries(parsed, ["evidence_id"])


@register(
    "retrieval_missing_vectors",
    """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings
    WHERE embedding[1] > 0)""",
)
def retrieval_missing_vectors(t):
    # A null vector counts as missing; here vectors with a negative first entry are.
    vectors = t.read("embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.when(F.col("embedding")[0] > 0, F.col("embedding")).alias("vector"),
    )
    return retrieval.missing_vectors(t.read("documents").select("doc_id"), vectors, ["doc_id"])


@register(
    "prompt_column",
    """SELECT doc_id, md5('Company: ' || source || chr(10) || 'Page: ' || doc_id || chr(10) || text
    || chr(10) || '{"evidence_items": []}') AS prompt_hash FROM documents""",
)
def prompt_column(t):
    template = 'Company: {source}\nPage: {doc_id}\n{text}\n{{"evidence_items": []}}'
    return extraction.with_prompts(t.read("documents"), template).select(
        "doc_id", F.md5("prompt").alias("prompt_hash")
    )


def rule_answer(prompt: str) -> str:
    """A stand-in model: quotes the first line and counts words."""
    first = prompt.split("\n", 1)[0].replace("\\", " ").replace('"', " ")
    return (
        '{"evidence_items": [{"evidence_text": "' + first + '", "evidence_summary": "",'
        '"candidate_sdgs": ["SDG 13"], "evidence_tags": ["policy"],'
        '"implementation_stage": "planned_action", "quantitative_support": false,'
        '"oversight_support": false, "confidence": 0.5, "rationale": ""}]}'
    )


@register(
    "response_from_function",
    """SELECT doc_id, 1 AS attempts, CAST(NULL AS VARCHAR) AS error, md5(
      '{"evidence_items": [{"evidence_text": "' || replace(replace(split_part(text, chr(10), 1),
      chr(92), ' '), '"', ' ') || '", "evidence_summary": "",'
      || '"candidate_sdgs": ["SDG 13"], "evidence_tags": ["policy"],'
      || '"implementation_stage": "planned_action", "quantitative_support": false,'
      || '"oversight_support": false, "confidence": 0.5, "rationale": ""}]}') AS answer
    FROM documents""",
)
def response_from_function(t):
    prompts = t.read("documents").select("doc_id", F.col("text").alias("prompt"))
    return extraction.call_model(prompts, rule_answer, ["doc_id"]).select(
        "doc_id", "attempts", "error", F.md5("raw_response").alias("answer")
    )


def first_call(prompt: str) -> str:
    """A model that is down for some of the prompts."""
    if len(prompt) % 3 == 0:
        raise ConnectionError("model is down")
    return rule_answer(prompt)


@register(
    "response_asked_again",
    """SELECT doc_id, CASE WHEN len(coalesce(text, '')) % 3 = 0 THEN 2 ELSE 1 END AS attempts,
    CAST(NULL AS VARCHAR) AS error FROM documents""",
)
def response_asked_again(t):
    """Two runs over one ledger: the second asks for the failed prompts only."""
    prompts = t.read("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("prompt"))
    path = f"{shared_folder(prompts.sparkSession)}/attesta-ledger-{uuid.uuid4().hex}"
    once_each = ExtractionParams(max_attempts=1)
    extraction.store_responses(prompts, first_call, ["doc_id"], path, once_each)
    stored = extraction.store_responses(prompts, rule_answer, ["doc_id"], path, once_each)
    return stored.select("doc_id", "attempts", "error")
