from types import SimpleNamespace

from pyspark.sql import functions as F

from attesta.plans.catalog import records


def test_strongest_items_keep_whole_texts(make_records):
    text = "long evidence " * 40
    scored = make_records({"a": dict(evidence_text=text, computed_strength="strong", computed_score=9)})
    tables = SimpleNamespace(scored=lambda: scored.withColumn("seq", F.lit(1)))
    [row] = records.findings_strongest_items(tables).collect()
    assert row.preview == text
