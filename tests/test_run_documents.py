"""Run documents: files of many parts, one reading of a file, rows that move once."""

import glob
import json
import os

from pyspark.sql import functions as F

from attesta.operators import findings
from attesta.plans.driver_tables import Tables
from attesta.sinks import documents
from attesta.sources import runs
from attesta.staging import SHUFFLE_CLEANUP, staged

DATA = "/root/testdata/sf0.001"


def documents_of(spark, records, per_part):
    reports = records.select("company", "report_year").distinct().withColumn("report_name", F.lit("R")).withColumn(
        "overall_assessment", F.lit("a"))
    errors = records.filter("evidence_text = ''").select(
        "company", "report_year", F.concat(F.lit("failed "), "evidence_id").alias("message"))
    summaries = findings.goal_summaries(records.filter("validation_status = 'valid'"))
    return documents.run_documents(reports, records, summaries, errors, "t", per_part=per_part)


def records_of(make_records, ids):
    return make_records({
        str(i): {"evidence_id": name, "page_number": 1 + i % 7, "evidence_text": "" if i % 50 == 0 else f"text {i}",
                 "validation_status": "rejected" if i % 3 == 0 else "valid", "computed_score": 3}
        for i, name in enumerate(ids)
    }).drop("case")


def test_small_parts_share_a_file(spark, make_records, tmp_path):
    """600 records in 300 parts of about two; before, each part had a file of its own."""
    records = records_of(make_records, [f"id {i}" for i in range(600)])
    docs = documents_of(spark, records, 2)
    root = str(tmp_path / "runs")
    documents.write_run_documents(docs, root, "20240101_120000")
    assert docs.count() == docs.first().n_parts > 300
    assert len(glob.glob(f"{root}/*/*/part-*")) == 1
    loaded = runs.load_runs(spark, root)
    got = loaded["valid"].unionByName(loaded["rejected"]).select("evidence_id", "validation_status", "page_number")
    assert sorted(got.collect()) == sorted(records.select(*got.columns).collect())
    assert loaded["runs"].count() == 1 and loaded["unreadable"].count() == 0
    found, _ = runs.latest_documents(spark, root)
    messages = [m for r in found.select("pipeline_errors").collect() for m in r[0]]
    assert sorted(messages) == sorted(f"failed id {i}" for i in range(0, 600, 50))
    for r in found.select("validated_evidence").collect():
        places = [(e.page_number, e.evidence_id) for e in r[0]]
        assert places == sorted(places)


def test_a_file_is_read_once(spark, make_records, tmp_path):
    """the tables of the runs read one stored copy of the documents, not the files."""
    docs = documents_of(spark, records_of(make_records, ["a", "b", "c"]), 50)
    root = str(tmp_path / "runs")
    documents.write_run_documents(docs, root, "20240101_120000")
    loaded = runs.load_runs(spark, root)
    for name in ("runs", "valid", "rejected", "summaries"):
        assert not any(root in path for path in loaded[name].inputFiles())
    plan = loaded["valid"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_an_unreadable_array_gives_way(spark, tmp_path):
    texts = {"acme_2020_20240101_000000": [{"company": "acme", "report_name": "Old"}], "acme_2020_20240102_000000": "[{broken"}
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "evidence.json").write_text(text if isinstance(text, str) else json.dumps(text), encoding="utf-8")
    loaded = runs.load_runs(spark, str(tmp_path))
    assert [r.report_name for r in loaded["runs"].collect()] == ["Old"]
    assert [r.run_name for r in loaded["unreadable"].collect()] == ["acme_2020_20240102_000000"]


def test_any_id_comes_back(spark, make_records):
    """hex ids move as half as many bytes; other ids as they are."""
    ids = ["d41d8cd98f00b204e9800998ecf8427e", "ABCD", "abc", "abcd", "", "0", "00", "é", "id 1", "0x1f", None]
    docs = documents_of(spark, records_of(make_records, ids), 50)
    rows = docs.select("validated_evidence", "rejected_evidence").collect()
    got = [e.evidence_id for r in rows for column in r for e in column]
    assert sorted(got, key=str) == sorted(ids, key=str)


def test_records_move_once_and_without_partial_lists(spark, make_records):
    """before, lists were formed before and after the records moved, and header
    and lists met in joins."""
    docs = documents_of(spark, records_of(make_records, ["a", "b"]), 50)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("REPARTITION_BY_NUM")]
    assert above.count("collect_list(") and "Join" not in above and "Exchange" not in above[: above.rindex("Exchange")]


def test_stored_frames_leave_no_shuffle(spark):
    """shuffle files of a stored frame go when it is stored."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {b.name() for b in _listed(blocks.getAllBlocks()) if b.name().startswith("shuffle_")}
    before, setting = shuffles(), spark.conf.get(SHUFFLE_CLEANUP)
    moved = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    stored = staged(moved)
    left = shuffles() - before
    assert left == set() and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert stored.count() == 7


def _listed(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_stored_records_are_compact(spark):
    """before, the stored records of the documents took over 50 bytes each."""
    from attesta.plans.catalog import files

    records = files.stage_inputs(Tables(spark, DATA))[0]
    n_bytes = sum(os.path.getsize(f) for f in glob.glob(f"{records.staged_paths[0].removeprefix('file:')}/*.parquet"))
    plain = staged(records)
    assert n_bytes < 0.85 * sum(os.path.getsize(f) for f in glob.glob(f"{plain.staged_paths[0].removeprefix('file:')}/*.parquet"))
