"""Run documents, flat evidence files and download tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from attesta import constants as k
from attesta import schemas
from attesta.functions.blocks import attach_by_key
from attesta.functions.text import preview, slug
from attesta.staging import shuffles_deleted, staged

REPORT = ["company", "report_year"]
RECORDS_PER_PART = 5000
RECORDS_PER_TASK = 50_000


def run_key(company, year, run_time: str) -> Column:
    """<slug>_<year>_<date>_<time>."""
    return F.concat_ws("_", slug(company), year.cast("string"), F.lit(run_time))


def run_documents(
    reports: DataFrame,
    records: DataFrame,
    summaries: DataFrame,
    errors: DataFrame,
    generated_at: str,
    per_part: int = RECORDS_PER_PART,
) -> DataFrame:
    """Documents with header, summaries, valid and rejected records, errors.

    ``reports``: company, report_year, report_name, overall_assessment; one row per
    report. ``records``: all records with status. ``errors``: company, report_year,
    message. A report with few records gives one document. Larger reports give
    several parts with the same header and disjoint lists, cut by a hash of the
    record id, so no task ever holds all records of a large report. Small parts that
    follow each other have the same ``file_no`` and lie in one task.

    Headers, records and messages move once, in one table to tasks of a bounded number
    of rows, and records only with the columns that they have; the full record is formed
    afterwards. The headers, one row per report, are stored once: everything below reads
    them, and records meet a table of known size.
    """
    valid = F.col("validation_status") == "valid"
    counts = records.groupBy(*REPORT).agg(
        F.count_if(valid).alias("valid_count"), F.count_if(~valid).alias("rejected_count")
    )
    goals = summaries.groupBy(*REPORT).agg(
        F.count(F.lit(1)).alias("sdg_count"),
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "sdg_num",
                        F.struct(*[F.col(f.name) for f in schemas.GOAL_SUMMARY]).alias("s"),
                    )
                )
            ),
            lambda x: x["s"],
        ).alias("sdg_summaries"),
    )
    n_errors = errors.groupBy(*REPORT).agg(F.count(F.lit(1)).alias("error_count"))
    n_rows = F.col("valid_count") + F.col("rejected_count") + F.col("error_count")
    heads = staged(
        reports.join(counts, REPORT, "left")
        .join(goals, REPORT, "left")
        .join(n_errors, REPORT, "left")
        .fillna(0, ["valid_count", "rejected_count", "sdg_count", "error_count"])
        .withColumn("n_parts", F.greatest(F.lit(1), F.ceil(n_rows / F.lit(per_part))).cast("int"))
    )
    rows = heads.agg(F.sum(n_rows)).first()[0] or 0
    tasks = max(records.sparkSession.sparkContext.defaultParallelism, -(-rows // RECORDS_PER_TASK))
    file_no = F.floor(F.col("part") / F.lit(max(1, RECORDS_PER_PART // per_part))).cast("int").alias("file_no")

    def parted(df: DataFrame, spread: Column, name: str, value: Column) -> DataFrame:
        sized = attach_by_key(df, heads.select(*REPORT, "n_parts"), REPORT, spread)
        placed = sized.withColumn("part", F.pmod(F.xxhash64(spread), F.col("n_parts")).cast("int"))
        return placed.select(*REPORT, file_no, "part", value.alias(name))

    first = F.col("part") == 0
    header = F.struct(
        "n_parts",
        "report_name",
        F.coalesce("overall_assessment", F.lit("")).alias("overall_assessment"),
        F.when(first, F.col("sdg_summaries")).alias("sdg_summaries"),
        "valid_count",
        "rejected_count",
        "sdg_count",
    )
    parts = heads.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))).select(
        *REPORT, file_no, "part", header.alias("head")
    )
    # Sorted by page, then id; company and year are those of the part.
    own = ["page_number", "evidence_id"]
    have = [f.name for f in schemas.EVIDENCE if f.name in records.columns and f.name not in (*REPORT, *own)]
    packed = F.struct("page_number", _packed_id(F.col("evidence_id")).alias("id"), *have)
    listed = parted(records, F.col("evidence_id"), "r", packed)
    messages = parted(errors, F.struct(*errors.columns), "message", F.col("message"))
    moved = (
        parts.unionByName(listed, allowMissingColumns=True)
        .unionByName(messages, allowMissingColumns=True)
        .repartition(tasks, *REPORT, "file_no")
        .withColumn(
            "r",
            F.when(
                F.col("r").isNotNull(),
                F.struct(
                    "r.page_number", _unpacked_id(F.col("r.id")).alias("evidence_id"),
                    *[F.col(f"r.{name}") for name in have],
                ),
            ),
        )
    )
    is_valid = F.col("r.validation_status") == "valid"
    documents = moved.groupBy(*REPORT, "file_no", "part").agg(
        F.first("head", ignorenulls=True).alias("head"),
        F.array_sort(F.collect_list(F.when(is_valid, F.col("r")))).alias("validated_evidence"),
        F.array_sort(F.collect_list(F.when(~is_valid, F.col("r")))).alias("rejected_evidence"),
        F.array_sort(F.collect_list("message")).alias("pipeline_errors"),
    )

    def in_full(name: str) -> Column:
        return F.transform(name, lambda r: _as_record(r, {*own, *have})).alias(name)

    return documents.select(
        *REPORT,
        "part",
        "head.n_parts",
        "head.report_name",
        "head.overall_assessment",
        "head.sdg_summaries",
        in_full("validated_evidence"),
        in_full("rejected_evidence"),
        "pipeline_errors",
        F.struct(
            F.lit(generated_at).alias("generated_at"),
            F.col("head.valid_count"),
            F.col("head.rejected_count"),
            F.col("head.sdg_count"),
        ).alias("metadata"),
        "file_no",
    )


def _packed_id(name: Column) -> Column:
    """An id with its characters as bytes, or half as many if they are hex digits."""
    is_hex = F.coalesce(F.lower(F.hex(F.unhex(name))) == name, F.lit(False))
    return F.struct(
        is_hex.alias("is_hex"), F.when(is_hex, F.unhex(name)).otherwise(name.cast("binary")).alias("bytes")
    )


def _unpacked_id(packed: Column) -> Column:
    return F.when(packed["is_hex"], F.lower(F.hex(packed["bytes"]))).otherwise(packed["bytes"].cast("string"))


def _as_record(r: Column, have: set[str]) -> Column:
    """Struct with the record schema; company and year are the row's, other fields that
    ``r`` lacks become NULL."""

    def field(name: str) -> Column:
        if name in REPORT:
            return F.col(name)
        return r[name] if name in have else F.lit(None)

    return F.struct(*[field(f.name).cast(f.dataType).alias(f.name) for f in schemas.EVIDENCE])


def document_json(documents: DataFrame, run_time: str) -> DataFrame:
    """Run key, part and the JSON text; missing lists are written as []. ``file_no`` is
    kept where the documents have it."""
    filled = documents.withColumns(
        {
            name: F.coalesce(F.col(name), F.array().cast(documents.schema[name].dataType))
            for name in (
                "sdg_summaries", "validated_evidence", "rejected_evidence", "pipeline_errors",
            )
        }
    )
    body = F.to_json(
        F.struct(
            "company", "report_name", "report_year", "overall_assessment", "sdg_summaries",
            "validated_evidence", "rejected_evidence", "pipeline_errors", "metadata",
        ),
        {"ignoreNullFields": "false"},
    )
    return filled.select(
        run_key(F.col("company"), F.col("report_year"), run_time).alias("run_name"),
        "company",
        "report_year",
        "part",
        body.alias("value"),
        *[name for name in ("file_no",) if name in documents.columns],
    )


def write_run_documents(documents: DataFrame, root: str, run_time: str) -> None:
    """Write <root>/run=<run>/document=evidence.json/, compressed.

    A file holds one part, or the parts of one ``file_no`` as a JSON array; the reader
    takes both. The texts do not move: a task writes the parts that it holds.
    Only the folders of the written runs are replaced, so a rerun is safe.
    """
    texts = document_json(documents, run_time)
    if "file_no" in texts.columns:
        in_order = F.transform(
            F.array_sort(F.collect_list(F.struct("part", "value"))), lambda x: x["value"]
        )
        array = F.concat(F.lit("["), F.array_join("texts", ",\n"), F.lit("]"))
        texts = (
            texts.groupBy(*REPORT, "file_no", "run_name")
            .agg(in_order.alias("texts"))
            .withColumn("value", F.when(F.size("texts") == 1, F.col("texts")[0]).otherwise(array))
        )
    with shuffles_deleted(documents.sparkSession):
        (
            texts.select(F.col("run_name").alias("run"), F.lit("evidence.json").alias("document"), "value")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", 1)
            .option("compression", "gzip")
            .partitionBy("run", "document")
            .text(root)
        )


def flat_evidence(
    validated_scored: DataFrame, text_chars: int | None = None, rationale_chars: int | None = None
) -> DataFrame:
    """Fixed column order, lists joined by " | "; valid records come first through
    the sort column ``row_group``. Texts are whole unless a limit is given."""
    have = set(validated_scored.columns)

    def col(name: str) -> Column:
        if name not in have:
            return F.lit(None).cast("string").alias(name)
        if isinstance(validated_scored.schema[name].dataType, ArrayType):
            return F.coalesce(F.array_join(name, " | "), F.lit("")).alias(name)
        if name == "evidence_text":
            return preview(F.coalesce(name, F.lit("")), text_chars).alias(name)
        if name == "rationale":
            return preview(F.coalesce(name, F.lit("")), rationale_chars).alias(name)
        return F.col(name)

    group = F.when(F.col("validation_status") == "valid", 0).otherwise(1).alias("row_group")
    return validated_scored.select(*[col(c) for c in k.CSV_COLUMNS], group)


def write_flat_evidence(validated_scored: DataFrame, path: str) -> None:
    """CSV per company and year; only the written companies and years are replaced.
    Range partitioning keeps the valid-first order
    across the files of a large report."""
    (
        flat_evidence(validated_scored)
        .withColumn("c", F.col("company"))
        .withColumn("y", F.col("report_year"))
        .repartitionByRange("c", "y", "row_group", "page_number", "evidence_id")
        .sortWithinPartitions("c", "y", "row_group", "page_number", "evidence_id")
        .select(*k.CSV_COLUMNS, "c", "y")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("c", "y")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def flatten_lists(df: DataFrame, separator: str = ", ") -> DataFrame:
    """Join every list column into text."""
    return df.select(
        *[
            F.array_join(F.col(f.name).cast("array<string>"), separator).alias(f.name)
            if isinstance(f.dataType, ArrayType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def write_download(df: DataFrame, path: str) -> None:
    flatten_lists(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def evaluation_flat(results: DataFrame) -> DataFrame:
    return flatten_lists(results, " | ")


def write_evaluation(results: DataFrame, aggregates: DataFrame, path: str) -> None:
    """JSON and CSV per model. Only the written models are replaced; a hot model's
    items are range-partitioned, so no task holds a whole model."""

    def per_model(df: DataFrame, order: list[str]):
        placed = df.repartitionByRange("model", *order)
        return (
            placed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("model")
        )

    per_model(results, ["item_id"]).json(f"{path}/results")
    per_model(aggregates, []).json(f"{path}/aggregate")
    per_model(evaluation_flat(results), ["item_id"]).option("header", True).option(
        "escape", '"'
    ).csv(f"{path}/results_csv")


def write_records(records: DataFrame, path: str) -> None:
    """Record store: Parquet by company and year, the layout that lets
    company and year filters skip files. Only the written companies and years
    are replaced."""
    (
        records.repartitionByRange(*REPORT, "evidence_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*REPORT)
        .parquet(path)
    )
