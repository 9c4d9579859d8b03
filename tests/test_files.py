"""Sinks and sources through real files in a temporary folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from attesta import schemas
from attesta.operators import findings, validation
from attesta.plans.catalog.files import report_lines, run_documents
from attesta.plans.driver_tables import Tables
from attesta.sinks import documents, texts
from attesta.sources import items, reports, runs

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, DATA)


def test_run_documents_round_trip(spark, tables, tmp_path):
    root = str(tmp_path / "runs")
    docs = run_documents(tables).filter(F.col("report_year").isin(1994, 1996))
    documents.write_run_documents(docs, root, "20240101_120000")
    older = docs.withColumn("report_name", F.lit("old"))
    documents.write_run_documents(older, root, "20230101_120000")
    loaded = runs.load_runs(spark, root)
    meta = loaded["runs"].collect()
    assert {r.report_name.split()[0] for r in meta} == {"Annual"}
    records = tables.validated().filter(F.col("report_year") == 1996)
    assert loaded["valid"].count() == validation.valid_only(records).count()
    assert loaded["rejected"].count() == validation.rejected_only(records).count()
    ids = {r.evidence_id for r in records.select("evidence_id").collect()}
    got = loaded["valid"].unionByName(loaded["rejected"]).select("evidence_id").collect()
    assert {r.evidence_id for r in got} == ids and len(got) == len(ids)
    goals = findings.goal_measures(validation.valid_only(tables.all_scored())).filter(
        F.col("report_year") == 1996
    )
    assert loaded["summaries"].count() == goals.count()
    assert {r.overall_assessment for r in meta if r.report_year == 1994} == {"no_evidence_found"}
    assert runs.unreadable_documents(runs.read_run_documents(spark, root)).count() == 0
    flat = runs.read_flat_evidence(spark, root)
    assert flat.count() == len(ids)


def test_plain_documents_are_read(spark, tmp_path):
    def put(name, text):
        folder = tmp_path / name
        folder.mkdir()
        if text is not None:
            (folder / "evidence.json").write_text(text, encoding="utf-8")

    item = {"evidence_id": "x", "candidate_sdgs": ["SDG 1"], "implementation_stage": "planned_action"}
    put("acme_2020_20240101_000000", json.dumps({"company": "ACME", "validated_evidence": [item]}))
    put("acme_2020_20240102_000000", json.dumps(
        {"company": "ACME", "report_name": "New", "validated_evidence": [item, item],
         "rejected_evidence": [{"evidence_id": "y"}]}, indent=2))
    put("acme_2021_20240101_000000", json.dumps({"validated_evidence": []}))
    put("acme_2022_20240101_000000", None)
    put("beta_2020_20240101_000000", "{broken")
    put("notes", json.dumps({"company": "no run"}))
    loaded = runs.load_runs(spark, str(tmp_path))
    meta = {(r.company, r.report_year): r.report_name for r in loaded["runs"].collect()}
    assert meta == {("acme", 2020): "New", ("acme", 2021): None}
    assert [r.run_name for r in loaded["unreadable"].collect()] == ["beta_2020_20240101_000000"]
    valid = loaded["valid"].collect()
    assert len(valid) == 2
    row = valid[0]
    assert (row.company, row.report_year, row.evidence_tags, row.quantitative_support,
            row.validation_status) == ("acme", 2020, [], False, "valid")
    assert loaded["rejected"].first().validation_status == "rejected"
    assert loaded["summaries"].count() == 0
    bad = runs.unreadable_documents(runs.read_run_documents(spark, str(tmp_path))).collect()
    assert "beta_2020_20240101_000000" in {r.run_name for r in bad}
    with pytest.raises(FileNotFoundError):  # its only run is broken
        runs.load_runs(spark, str(tmp_path), companies=["beta"])
    put("beta_2020_20230101_000000", json.dumps({"company": "beta", "report_name": "Older"}))
    only = runs.load_runs(spark, str(tmp_path), companies=["beta"])
    assert [r.report_name for r in only["runs"].collect()] == ["Older"]
    assert only["unreadable"].count() == 1


def test_no_runs_is_an_error(spark, tmp_path):
    folder = tmp_path / "x_2020_20240101_000000"
    folder.mkdir()
    (folder / "evidence.json").write_text("{}", encoding="utf-8")
    with pytest.raises(FileNotFoundError):
        runs.load_runs(spark, str(tmp_path), companies=["nobody"])


def test_report_texts(spark, tables, tmp_path):
    root = str(tmp_path / "reports")
    lines = report_lines(tables).filter(F.col("report_year").isin(1994, 1996))
    run = documents.run_key(F.col("company"), F.col("report_year"), "20240101_120000")
    texts.write_lines(lines, run, root)
    found = runs.latest_report_files(spark, root).collect()
    assert len(found) == 50
    whole = {}
    for r in runs.read_report_texts(spark, root).collect():
        whole[(r.company, r.report_year)] = whole.get((r.company, r.report_year), "") + r.text
    some = next(v for (_, y), v in whole.items() if y == 1996)
    order = [
        "# SDG Evidence Report", "## Caveats", "## Executive Summary", "## SDG-by-SDG Summary",
        "### SDG 1\n", "### SDG 2\n", "## Strongest Evidence Items", "## Moderate Evidence",
        "| Page | SDGs", "## Rejected / Uncertain Evidence", "*Scores follow",
    ]
    places = [some.find(x) for x in order if x in some or not x.startswith("###")]
    assert -1 not in places and places == sorted(places)
    empty = next(v for (_, y), v in whole.items() if y == 1994)
    assert "*No SDG evidence was extracted.*" in empty and "None — No SDG Evidence" in empty
    assert "Average evidence score" not in empty and "*No evidence items were rejected.*" in empty


def test_flat_csv(spark, tables, tmp_path):
    path = str(tmp_path / "csv")
    records = tables.all_scored().filter(F.col("report_year") == 1996)
    tricky = records.withColumn("evidence_text", F.concat(F.lit('a "q", b '), F.repeat(F.lit("z"), 600)))
    documents.write_flat_evidence(tricky, path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert back.count() == records.count()
    assert {len(r.evidence_text) for r in back.select("evidence_text").collect()} == {609}  # whole texts
    folder = next(p for p, _, files in os.walk(path) if any(f.startswith("part") for f in files))
    status = [
        r.validation_status
        for f in sorted(os.listdir(folder)) if f.startswith("part")
        for r in spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{f}").collect()
    ]
    assert status == sorted(status, reverse=True)  # valid before rejected


def test_labelled_items(spark, tmp_path):
    lines = [
        '{"company": "A", "chunk_text": "t", "expected_sdgs": ["SDG 1"], "notes": "n1"}',
        "", "   ", "# comment", '{"broken": ', '{"chunk_text": "u", "expected_valid": false} trailing',
        '  {"chunk_text": "v", "expected_valid": false, "page_number": 7}  ',
    ]
    path = tmp_path / "items.jsonl"
    path.write_text("\n".join(lines), encoding="utf-8")
    got = items.read_items(spark, str(path)).collect()
    assert sorted((r.company, r.page_number, r.expected_valid, r.expected_sdgs) for r in got) == [
        ("A", 1, True, ["SDG 1"]), ("BenchmarkCo", 7, False, []),
    ]
    counts = items.line_counts(items.parse_item_lines(spark.read.text(str(path)))).collect()
    assert {r.line_status: r.n_lines for r in counts} == {"item": 2, "skipped": 3, "malformed": 2}


def test_evaluation_and_summary_files(spark, tables, tmp_path):
    from attesta.operators.evaluation import aggregate_metrics

    results = tables.results()
    documents.write_evaluation(results, aggregate_metrics(results), str(tmp_path / "eval"))
    assert spark.read.json(str(tmp_path / "eval/results")).count() == results.count()
    assert spark.read.json(str(tmp_path / "eval/aggregate")).count() == 3
    for name, header, row in (
        ("p.csv", "model,metric,value", "m,f1,0.5"),
        ("l.csv", "company,year,implementation_share,rhetoric_share", "a,2020,0.1,0.2"),
        ("a.csv", "company,sdg_agreement,stage_agreement,overclaim_difference", "a,0.9,0.8,0.1"),
    ):
        (tmp_path / name).write_text(f"{header}\n{row}\n", encoding="utf-8")
    inputs = runs.read_plot_inputs(
        spark, *[str(tmp_path / n) for n in ("p.csv", "l.csv", "a.csv")]
    )
    assert inputs["longitudinal"].first().year == 2020
    documents.write_download(tables.scored().select("evidence_id", "candidate_sdgs"), str(tmp_path / "d"))
    assert spark.read.option("header", True).csv(str(tmp_path / "d")).count() == tables.scored().count()


def test_record_store_prunes_partitions(spark, tables, tmp_path):
    path = str(tmp_path / "store")
    documents.write_records(tables.all_scored(), path)
    plan = spark.read.parquet(path).filter("report_year = 1996").select("computed_score")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_year" in text


def test_page_reader(spark, tmp_path):
    spark.createDataFrame(
        [("r", 1, None)], "report_id string, page_number int, text string"
    ).write.json(str(tmp_path / "pages"))
    assert reports.read_pages(spark, str(tmp_path / "pages"), "json").first().text == ""


def test_writers_leave_other_partitions(spark, tmp_path, make_records):
    from attesta.sinks import documents

    first = make_records({"a": {"company": "a", "evidence_id": "x"}}).drop("case")
    second = make_records({"b": {"company": "b", "evidence_id": "y"}}).drop("case")
    for write, name in ((documents.write_records, "records"), (documents.write_flat_evidence, "flat")):
        path = str(tmp_path / name)
        for part in (first, second, second):
            write(part, path)
        read = spark.read.parquet(path) if name == "records" else spark.read.option("header", True).csv(path)
        assert sorted(r.evidence_id for r in read.collect()) == ["x", "y"]
    results = lambda m: spark.createDataFrame([(m, "i1", ["a", "b"])], "model string, item_id string, tags array<string>")
    totals = lambda m: spark.createDataFrame([(m, 1)], "model string, n bigint")
    path = str(tmp_path / "evaluation")
    for model in ("m1", "m2", "m1"):
        documents.write_evaluation(results(model), totals(model), path)
    for part in ("results", "aggregate"):
        assert sorted(r.model for r in spark.read.json(f"{path}/{part}").collect()) == ["m1", "m2"]
    assert spark.read.option("header", True).csv(f"{path}/results_csv").count() == 2


def test_whole_texts_and_names(spark, make_records):
    from attesta.functions.text import slug
    from attesta.sinks import documents

    long = "w" * 900
    flat = documents.flat_evidence(make_records({"a": {"evidence_text": long, "rationale": long}})).first()
    assert flat.evidence_text == long and flat.rationale == long
    names = spark.createDataFrame([("x" * 40 + " one",), ("x" * 40 + " two",)], "n string")
    assert names.select(slug(F.col("n"))).distinct().count() == 2


def test_missing_vectors(spark):
    from attesta.operators import retrieval

    chunks = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "report_id int, chunk_no int")
    vectors = spark.createDataFrame([(1, 1, [1.0]), (1, 3, None)], "report_id int, chunk_no int, vector array<float>")
    joined = retrieval.attach_vectors(chunks, vectors, retrieval.CHUNK_KEY)
    assert joined.count() == 3
    missing = retrieval.missing_vectors(chunks, vectors, retrieval.CHUNK_KEY)
    assert sorted(r.chunk_no for r in missing.collect()) == [2, 3]


def test_superseded_runs_are_not_opened(spark, tmp_path):
    for day, name in ((1, "old"), (2, "new")):
        folder = tmp_path / f"acme_2020_2024010{day}_000000"
        folder.mkdir()
        (folder / "evidence.json").write_text(json.dumps({"company": "acme", "report_name": name}))
    docs, bad = runs.latest_documents(spark, str(tmp_path))
    files = docs.inputFiles()
    assert bad == [] and len(files) == 1 and "20240102" in files[0]


def test_parts_are_compressed_and_listed_by_run(spark, tmp_path):
    """Texts are stored compressed, one file per part, and a run is one path however many parts it has."""
    import glob

    body = "'" + "x" * 20_000 + "'"
    docs = spark.sql(
        "SELECT 'Acme' AS company, 2020 AS report_year, CAST(id AS INT) AS part, 'R' AS report_name,"
        f" {body} AS overall_assessment, CAST(array() AS {schemas.RUN_DOCUMENT['sdg_summaries'].dataType.simpleString()}) AS sdg_summaries,"
        f" CAST(array() AS {schemas.RUN_DOCUMENT['validated_evidence'].dataType.simpleString()}) AS validated_evidence,"
        f" CAST(array() AS {schemas.RUN_DOCUMENT['rejected_evidence'].dataType.simpleString()}) AS rejected_evidence,"
        " CAST(array() AS array<string>) AS pipeline_errors, named_struct('generated_at', 't') AS metadata FROM range(30)"
    )
    root = str(tmp_path / "runs")
    documents.write_run_documents(docs, root, "20240101_120000")
    files = glob.glob(f"{root}/*/*/part-*")
    assert len(files) == 30 and sum(os.path.getsize(f) for f in files) < 30 * 2000
    paths = runs.document_paths(spark, root, "evidence.json")
    assert len(runs._latest_paths(paths, "evidence.json", None)) == 1
    found, bad = runs.latest_documents(spark, root)
    assert found.count() == 30 and not bad
