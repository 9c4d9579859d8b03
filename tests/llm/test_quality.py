import numpy as np

from attesta.llm import quality

DATA = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    hidden = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = quality.score(docs, labels.filter(~hidden)).join(labels.filter(hidden), "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert len(bad) > 50
    kept, rejected = sum(r.keep for r in good) / len(good), sum(not r.keep for r in bad) / len(bad)
    print(kept, rejected)
    assert kept > 0.98 and rejected > 0.9
    assert all(0 <= s <= 1 for r in rows for s in (r.text_score, r.metadata_score, r.score))


def test_co_training_uses_both_views():
    rng = np.random.default_rng(1)
    truth = (rng.random(4000) < 0.7).astype(float)
    views = [np.column_stack([truth + rng.normal(0, 0.6, 4000), rng.normal(size=4000)]),
             np.column_stack([truth + rng.normal(0, 0.6, 4000), rng.normal(size=4000)])]
    labels = np.where(np.arange(4000) < 120, truth, np.nan)
    apart = np.arange(4000) % 3 == 0
    model = quality.co_train(views, labels, apart, quality.QualityParams())
    a, b = model.views(*views)
    right = lambda s: ((s > 0) == (truth == 1)).mean()
    both = ((model.score(a, b) > 0.5) == (truth == 1)).mean()
    assert both > 0.85 and both >= max(right(a), right(b)) - 0.02


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    rows = [(i, "good words in this text number one", "en", "a", 34, "x") for i in range(60)]
    rows += [(100 + i, "bad bad bad bad bad bad", "en", "b", 23, "x") for i in range(60)]
    rows += [(300, None, None, None, None, None), (301, "", "en", "a", 0, ""), (None, "bad " * 30_000, "en", "b", 1, ""),
             (302, "bad bad bad bad bad bad", "en", "b", 23, ""), (302, "bad bad bad bad bad bad", "en", "b", 23, "")]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, 1, "c") for i in range(60)] + [(100 + i, 0, "c") for i in range(60)] + [(1, 1, "c"), (None, 1, "c"), (2, None, "c")],
                                   "doc_id bigint, quality int, text string")
    got = quality.score(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(r.keep == (r.doc_id < 60) for r in got if r.doc_id is not None and r.doc_id < 300)
    assert [r.keep for r in got if r.doc_id == 302] == [False, False]
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.keep for r in got)
    assert all(r.keep and r.score == 0.5 for r in quality.score(docs, labels.limit(0)).collect())
    assert quality.score(docs.limit(0), labels).collect() == []
    assert quality.keep_good(docs.limit(0), labels).collect() == []


def plain_score(model, texts, metas):
    """The score restated with plain loops."""
    import math

    def odds(row, weights):
        return max(-30.0, min(30.0, sum(x * w for x, w in zip(row, weights)) + weights[-1]))

    out = []
    for text, meta in zip(texts, metas):
        a = odds([odds(text, model.text)], model.text_scale)
        b = odds([odds(meta, model.metadata)], model.metadata_scale)
        out.append((a, b, 1 / (1 + math.exp(-odds([a, b], model.combined)))))
    return out


def test_scores_equal_the_plain_formula(spark):
    params = quality.QualityParams()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels, params)
    rows = {r.doc_id: r for r in docs.collect()}
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    texts = [quality.text_features(r.text or "") for r in rows.values()]
    metas = [quality.metadata_features(r.source, r.lang, r.n_chars, params) for r in rows.values()]
    for doc_id, (a, b, score) in zip(rows, plain_score(model, texts, metas)):
        assert abs(got[doc_id].score - score) < 1e-9 and got[doc_id].keep == (got[doc_id].score >= 0.5)
        assert abs(got[doc_id].text_score - 1 / (1 + np.exp(-a))) < 1e-9
        assert abs(got[doc_id].metadata_score - 1 / (1 + np.exp(-b))) < 1e-9


def test_few_labels_among_many_documents(spark):
    """Labelled documents are sampled by themselves; a class lost in the sample is an error."""
    import pytest

    rows = [(i, "good words in this text number one" if i % 2 else "bad bad bad bad bad bad", "en", "a", 30) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    got = quality.score(docs, labels, quality.QualityParams(labelled_rows=40, sample_rows=40)).collect()
    assert all(r.keep == bool(r.doc_id % 2) for r in got)
    with pytest.raises(ValueError, match="labelled_rows"):
        quality.score(docs, labels, quality.QualityParams(labelled_rows=0))
    one = quality.score(docs, labels.filter("quality = 1")).collect()
    assert all(r.keep and r.score == 0.5 for r in one)


def test_ids_beyond_doubles(spark):
    big = 2**53 + 1
    docs = spark.createDataFrame([(big, "a", "en", "s", 1), (None, "b", "en", "s", 1)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.doc_id for r in quality.score(docs, labels).collect()} == {big, None}
