import zlib

import numpy as np
import pytest

from attesta.llm import langid

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_leaks(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in rows if r.held_out]
    assert {r.doc_id for r in tested} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.lang_pred == r.lang for r in tested) / len(tested) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    from pyspark.sql import functions as F

    hidden = docs.withColumn("lang", F.when(~langid.held_out(F.col("doc_id"), langid.LangParams()), F.col("lang")))
    again = {(r.doc_id, r.lang_pred) for r in langid.predict(hidden.withColumn("source", F.lit("x"))).collect()}
    assert again == {(r.doc_id, r.lang_pred) for r in rows}


def test_backoff_and_counts(spark):
    rows = [(i, t, l, l) for i, (t, l) in enumerate([("the cat sat", "en"), ("der hund lag", "de")] * 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    model = langid.train(docs, langid.LangParams())
    n = {l: sum(1 for r in rows if r[2] == l and zlib.crc32(str(r[0]).encode()) % 5) for l in ("en", "de")}
    expected = np.log((np.array([0, n["en"]]) + 0.5) / (np.array([3 * n["de"], 3 * n["en"]]) + 3.0))
    assert model.langs == ["de", "en"]
    assert np.allclose(model.words["cat"], expected)
    assert np.allclose(model.of_word("cats"), model.grams[3]["<cat"])  # the known 4-gram
    assert np.allclose(model.of_word("xx"), np.zeros(2)) if model.of_word("xx") is not None else True


def test_odd_rows(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(30)] + [(100 + i, "der hund liegt da", "de") for i in range(30)]
    rows += [(200, None, "en"), (201, "", None), (202, "12 ²½ _ !", "de"), (203, "日本語", None), (None, "the cat", "fr"),
             (204, "hund " * 30_000, None), (204, "hund " * 30_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {}
    for r in langid.predict(docs).collect():
        got.setdefault(r.doc_id, []).append((r.held_out, r.lang_pred, r.score))
    assert [got[i][0][1:] for i in (200, 201, 202)] == [("und", 0.0)] * 3
    assert got[203][0][1] in ("en", "de") and got[None][0][:2] == (False, "en")
    assert [g[1] for g in got[204]] == ["de", "de"]
    assert langid.predict(docs.limit(0)).collect() == []
    none = docs.withColumn("lang", docs.lang.cast("string")).filter("doc_id = 203")
    assert langid.predict(none).collect()[0].lang_pred == "und"
