"""Stored runs: discovery of the latest run, run documents, report texts."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from attesta import schemas
from attesta.functions.blocks import first_n
from attesta.staging import staged

CORRUPT = "corrupt_text"
RUN_NAME = r"(?i)^(.+)_(\d{4})_(\d{8}_\d{6})$"
RUN_IN_PATH = r"/(?:run=)?([^/=]+_\d{4}_\d{8}_\d{6})/"


def parse_run_names(runs: DataFrame, name: str = "run_name") -> DataFrame:
    """Split {company}_{year}_{date}_{time}; other names are left out."""
    return runs.filter(F.col(name).rlike(RUN_NAME)).withColumns(
        {
            "company": F.lower(F.regexp_extract(name, RUN_NAME, 1)),
            "report_year": F.regexp_extract(name, RUN_NAME, 2).cast("int"),
            "run_time": F.regexp_extract(name, RUN_NAME, 3),
        }
    )


def latest_runs(
    named: DataFrame, companies: list[str] | None = None, name: str = "run_name"
) -> DataFrame:
    """Latest run per company and year, exactly one."""
    runs = parse_run_names(named, name)
    if companies is not None:
        runs = runs.filter(F.col("company").isin([c.lower() for c in companies]))
    order = [F.col("run_time").desc(), F.col(name).desc()]
    return first_n(runs, ["company", "report_year"], order, 1, "rn").drop("rn")


def run_name_of(path):
    """Run name from .../<run>/... or .../run=<run>/... in a file path."""
    return F.regexp_extract(path, RUN_IN_PATH, 1)


def _run_of(path: str) -> str:
    """The same as ``run_name_of``, for a path on the driver."""
    found = re.search(RUN_IN_PATH, path)
    return found[1] if found else ""


def document_paths(spark: SparkSession, root: str, document: str) -> DataFrame:
    """(path, run_name) of the files of a document; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(f"{root}/*/*{document}")
        .select("path")
    )
    return files.withColumn("run_name", run_name_of(F.col("path")))


def _latest_paths(
    paths: DataFrame, document: str, companies: list[str] | None, without: list[str] = ()
) -> list[str]:
    """Documents of the latest runs, each a file or a folder of part files. A list on
    the driver with one entry per run, however many parts it has."""
    whole = F.regexp_extract("path", f"^(.*/[^/]*{re.escape(document)})(?:/|$)", 1)
    usable = paths.filter(~F.col("run_name").isin(list(without))) if without else paths
    latest = latest_runs(usable.select("run_name").distinct(), companies)
    chosen = usable.join(latest, "run_name", "left_semi").select(whole.alias("path")).distinct()
    return [r["path"] for r in chosen.collect()]


def read_run_documents(
    spark: SparkSession, root: str, document: str = "evidence.json", paths: list[str] | None = None
) -> DataFrame:
    """All run documents under a folder, or those of the given files and folders, in one job.

    A document is one file, or a folder of files with one part each or an array of
    parts, which carry the same header and disjoint lists. A corrupt file gives a row without company; see
    ``unreadable_documents``.
    """
    layout = StructType([*schemas.RUN_DOCUMENT.fields, StructField(CORRUPT, StringType())])
    docs = (
        spark.read.schema(layout)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .json(f"{root}/*/*{document}" if paths is None else paths)
    )
    return docs.withColumn("path", F.col("_metadata.file_path")).withColumn(
        "run_name", run_name_of(F.col("path"))
    )


def pick_latest(
    documents: DataFrame, companies: list[str] | None = None, names: list[str] | None = None
) -> DataFrame:
    """Documents of the latest run per company and year. With the ``names`` of their runs
    the table of latest runs is known to be small, so documents need not move to meet it."""
    if names is None:
        named = documents.select("run_name").distinct()
    else:
        listed = F.from_json(F.lit(json.dumps(names)), "array<string>")
        named = documents.sparkSession.range(1).select(F.explode(listed).alias("run_name"))
    latest = latest_runs(named, companies)
    return documents.join(
        latest.select(
            "run_name", F.col("company").alias("run_company"), F.col("report_year").alias("run_year")
        ),
        "run_name",
    )


def _header(documents: DataFrame) -> DataFrame:
    """Company and year from the document, else from the run name."""
    return documents.withColumn(
        "company", F.lower(F.coalesce("company", "run_company"))
    ).withColumn("report_year", F.coalesce("report_year", "run_year"))


def run_metadata(documents: DataFrame) -> DataFrame:
    """One row per run, also when the document has several parts."""
    head = _header(documents)
    return head.groupBy("run_name").agg(
        F.max("company").alias("company"),
        F.max("report_year").alias("report_year"),
        F.max("report_name").alias("report_name"),
        F.max("overall_assessment").alias("overall_assessment"),
    )


def _records(documents: DataFrame, column: str, status: str) -> DataFrame:
    """Records of a list column; an empty or missing list gives no rows."""
    head = _header(documents).select(
        "run_name",
        F.col("company").alias("__company"),
        F.col("report_year").alias("__year"),
        F.explode(column).alias("r"),
    )
    rows = head.select("run_name", "__company", "__year", "r.*")
    empty = F.array().cast("array<string>")
    return rows.withColumns(
        {
            "company": F.lower(F.coalesce("company", "__company")),
            "report_year": F.coalesce("report_year", "__year"),
            "candidate_sdgs": F.coalesce("candidate_sdgs", empty),
            "evidence_tags": F.coalesce("evidence_tags", empty),
            "validation_errors": F.coalesce("validation_errors", empty),
            "quantitative_support": F.coalesce("quantitative_support", F.lit(False)),
            "oversight_support": F.coalesce("oversight_support", F.lit(False)),
            "validation_status": F.coalesce("validation_status", F.lit(status)),
        }
    ).drop("__company", "__year")


def run_valid(documents: DataFrame) -> DataFrame:
    return _records(documents, "validated_evidence", "valid")


def run_rejected(documents: DataFrame) -> DataFrame:
    return _records(documents, "rejected_evidence", "rejected")


def run_goal_summaries(documents: DataFrame) -> DataFrame:
    """Goal summaries, keyed by the run's company and year."""
    return documents.select(
        "run_name",
        F.col("run_company").alias("company"),
        F.col("run_year").alias("report_year"),
        F.inline("sdg_summaries"),
    ).withColumn("evidence_count", F.coalesce("evidence_count", F.lit(0)))


def unreadable_documents(documents: DataFrame) -> DataFrame:
    bad = F.col("company").isNull() & F.col(CORRUPT).isNotNull()
    return documents.filter(bad).select("run_name", "path")


def _opened(
    spark: SparkSession, root: str, companies: list[str] | None, keep: Callable[[DataFrame], DataFrame]
) -> tuple[list[str], list[DataFrame], dict[str, str]]:
    """Paths of the latest readable runs, what was read to find them, and run and file
    of the unreadable ones. Each file is opened in one frame, to which ``keep`` is applied.
    """
    paths = document_paths(spark, root, "evidence.json")
    unreadable: dict[str, str] = {}
    readable: list[str] = []
    frames: list[DataFrame] = []
    while True:
        chosen = _latest_paths(paths, "evidence.json", companies, list(unreadable))
        if not chosen:
            raise FileNotFoundError(f"no readable runs under {root}")
        opened = sorted(set(chosen) - set(readable))
        bad = []
        if opened:
            frames.append(keep(read_run_documents(spark, root, paths=opened)))
            bad = unreadable_documents(frames[-1]).collect()
        if not bad:
            return chosen, frames, unreadable
        unreadable |= {r["run_name"]: r["path"] for r in bad}
        readable += [path for path in opened if _run_of(path) not in unreadable]


def latest_documents(
    spark: SparkSession, root: str, companies: list[str] | None = None
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Documents of the latest readable run per company and year, and the
    (run, file) pairs that could not be read.

    The latest runs are chosen from the file names, so superseded runs are not
    opened. A run with an unreadable file gives way to the one before it; files that
    were found readable are not read again to look for that.
    """
    chosen, _, unreadable = _opened(spark, root, companies, lambda documents: documents)
    return pick_latest(read_run_documents(spark, root, paths=chosen), companies), sorted(unreadable.items())


def load_runs(
    spark: SparkSession,
    root: str,
    companies: list[str] | None = None,
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> dict[str, DataFrame]:
    """Tables of all latest readable runs, and of the files that could not be
    read; an error when there is nothing to load.

    Every table reads the documents, so a file is parsed once and its content stored."""
    _, frames, unreadable = _opened(spark, root, companies, stage)
    documents = reduce(DataFrame.unionByName, frames)
    if unreadable:
        documents = documents.filter(~F.col("run_name").isin(list(unreadable)))
    names = [r["run_name"] for r in documents.select("run_name").distinct().collect()]
    documents = pick_latest(documents, companies, names)
    return {
        "runs": run_metadata(documents),
        "valid": run_valid(documents),
        "rejected": run_rejected(documents),
        "summaries": run_goal_summaries(documents),
        "unreadable": spark.createDataFrame(sorted(unreadable.items()), "run_name string, path string"),
    }


def read_report_texts(
    spark: SparkSession, root: str, companies: list[str] | None = None, document: str = "report.md"
) -> DataFrame:
    """Report texts of the latest runs that have one, one row per text file."""
    paths = document_paths(spark, root, document)
    chosen = _latest_paths(paths, document, companies)
    if not chosen:
        return spark.createDataFrame(
            [], "run_name string, report_file string, text string, company string, "
            "report_year int, run_time string"
        )
    texts = (
        spark.read.option("recursiveFileLookup", True).text(chosen, wholetext=True)
        .select(F.col("_metadata.file_path").alias("report_file"), F.col("value").alias("text"))
        .withColumn("run_name", run_name_of(F.col("report_file")))
    )
    return parse_run_names(texts).select(
        "run_name", "report_file", "text", "company", "report_year", "run_time"
    )


def latest_report_files(
    spark: SparkSession, root: str, companies: list[str] | None = None, document: str = "report.md"
) -> DataFrame:
    """Report text files of the latest run, where it has one; contents are not
    read. A report written in several files has a row for each."""
    files = document_paths(spark, root, document)
    latest = latest_runs(files.select("run_name").distinct(), companies)
    return files.join(latest, "run_name").select(
        "company", "report_year", F.col("path").alias("report_file")
    )


def run_status(manifest: DataFrame, counts: DataFrame) -> DataFrame:
    """Expected reports (company, report_year, report_name) against finished
    runs (company, report_year, n_valid, n_rejected)."""
    keys = ["company", "report_year"]
    return (
        manifest.join(counts.withColumn("__done", F.lit(True)), keys, "left")
        .withColumn(
            "status", F.when(F.col("__done"), F.lit("DONE")).otherwise(F.lit("pending"))
        )
        .drop("__done")
    )


def run_progress(status: DataFrame) -> DataFrame:
    return status.groupBy("company").agg(
        F.count_if(F.col("status") == "DONE").alias("n_done"),
        F.count(F.lit(1)).alias("n_expected"),
        F.coalesce(F.sum("n_valid"), F.lit(0)).alias("total_valid"),
    )


def read_plot_inputs(
    spark: SparkSession, performance: str, longitudinal: str, agreement: str
) -> dict[str, DataFrame]:
    """The three summary tables behind the comparison figures."""
    def csv(path, schema):
        return spark.read.schema(schema).option("header", True).csv(path)

    return {
        "performance": csv(performance, schemas.PERFORMANCE_SUMMARY),
        "longitudinal": csv(longitudinal, schemas.LONGITUDINAL_SUMMARY),
        "agreement": csv(agreement, schemas.AGREEMENT_SUMMARY),
    }


def read_flat_evidence(spark: SparkSession, root: str) -> DataFrame:
    """Run documents flattened to one row per record, lists kept as arrays."""
    documents, _ = latest_documents(spark, root)
    return run_valid(documents).unionByName(run_rejected(documents))
