"""Ids that no double holds, next to null ids in one batch; broadcasts without the package."""

import pickle

import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

import corpus_pipeline
from attesta.llm import catalog, decontam, langid

BIG = 2**53 + 1
OPERATORS = ["op1_personal_data", "op2_language", "op4_secrets", "op5_leaks", "op6_packed_ids", "op7_simhash_groups",
             "op8_bpe_round_trip", "op9_quality", "op11_periodic_runs", "op12_token_alignment", "op13_exact_copies"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ids"))
    item = "one benchmark item of nine plain words is here"
    rows = [(BIG, f"first text {item}", "en", "s", 9), (None, "a text without an id", "en", "s", 9), (5, "last text", "en", "s", 9)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_keep_ids(spark, folder, name):
    ids = {r.doc_id for r in catalog.QUERIES[name](spark, folder).select("doc_id").collect()}
    assert ids == ({BIG} if name == "op5_leaks" else {BIG, None, 5})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_ids(spark, folder, name, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r.doc_id for r in stage(spark, docs, folder).select("doc_id").collect()}
    assert ids == ({None, 5} if name == "decontamination" else {BIG, None, 5})


def test_broadcasts_hold_plain_values(spark, folder, monkeypatch):
    """Workers that lack the package can read every broadcast."""
    sent, send = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(pickle.dumps(value)) or send(self, value))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("lang", F.coalesce("lang", F.lit("en")))
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    langid.predict(docs)
    decontam.find_leaks(docs, items)
    decontam.drop_leaks(docs, items)
    assert len(sent) == 3 and not any(b"attesta" in value for value in sent)
