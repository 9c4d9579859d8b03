"""Pages to findings: the stages in sequence, as one lazy plan per table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import chunking, extraction, findings, retrieval, scoring, validation
from attesta.params import ChunkParams, ExtractionParams, FindingsParams, RetrievalParams
from attesta.staging import staged


def candidate_chunks(
    pages: DataFrame,
    queries: DataFrame,
    embed: Callable[[list[str]], list[list[float]]],
    chunk: ChunkParams = ChunkParams(),
    search: RetrievalParams = RetrievalParams(),
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Best chunks per report for each query. Chunks are kept, because they are
    read once for scoring and once to fetch the texts of the best."""
    chunks = stage(chunking.chunk_pages(pages, chunk))
    return retrieval.retrieve(retrieval.embed_texts(chunks, embed, search), queries, search)


def evidence_from_responses(
    chunks: DataFrame,
    responses: DataFrame,
    params: ExtractionParams = ExtractionParams(),
) -> tuple[DataFrame, DataFrame]:
    """Records (validated and scored) and errors from stored model responses.

    Errors are failed calls, answers that cannot be parsed, and every entry of an
    answer that did not become a record.

    ``chunks``: report_id, chunk_no, chunk_id, chunk_rank, company, report_name,
    report_year, page_number, section_heading. ``responses``: report_id,
    chunk_no, raw_response, error.
    """
    keys = ["report_id", "chunk_no"]
    parsed = extraction.parse_responses(responses, params)
    records = extraction.to_records(extraction.response_items(parsed), chunks, keys, params)
    failed = extraction.error_table(
        parsed.withColumn("message", F.coalesce("error", "parse_error")),
        ["report_id"],
        "extraction",
        "message",
    )
    # Answers that came after an error are kept out of the losses: they are in `failed`.
    lost = extraction.dropped_entries(parsed.filter(F.col("error").isNull()), keys, params)
    place = F.concat(
        F.lit("chunk "), F.col("chunk_no").cast("string"),
        F.coalesce(F.concat(F.lit(", entry "), F.col("item_no").cast("string")), F.lit("")),
    )
    dropped = extraction.error_table(
        lost.withColumn("message", F.concat(place, F.lit(": "), F.col("reason"))),
        ["report_id"],
        "dropped_entry",
        "message",
    )
    return score_all(validation.validate(records)), failed.union(dropped)


def score_all(validated: DataFrame) -> DataFrame:
    """Score valid records, keep rejected ones without a score."""
    valid = F.col("validation_status") == "valid"
    return validated.withColumn(
        "computed_score", F.when(valid, scoring.score_value())
    ).withColumn(
        "computed_strength", F.when(valid, scoring.strength_label(F.col("computed_score")))
    )


def report_findings(
    records: DataFrame,
    reports: DataFrame,
    keys: list[str] = findings.REPORT,
    order: list[str] | None = None,
    params: FindingsParams = FindingsParams(),
) -> dict[str, DataFrame]:
    """All finding tables of the reports."""
    valid = validation.valid_only(records)
    rejected = validation.rejected_only(records)
    return {
        "goals": findings.goal_summaries(valid, keys, order, params),
        "assessment": findings.overall_assessment(valid, reports, keys),
        "summary": findings.executive_summary(records, keys),
        "strongest": findings.strongest_items(valid, keys, order, params),
        "moderate": findings.moderate_items(valid, keys, order, params),
        "reasons": findings.rejection_reasons(rejected, keys, order, params),
    }
