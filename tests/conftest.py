import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def records_schema():
    from pyspark.sql import types as T

    from attesta import schemas

    return T.StructType([T.StructField("case", T.StringType())] + list(schemas.EVIDENCE.fields))


@pytest.fixture(scope="session")
def make_records(spark, records_schema):
    """Frame of records: a complete valid record with overrides per case."""
    base = dict(
        evidence_id="e", company="acme", report_name="R", report_year=2020, page_number=1,
        section_heading="S", evidence_text="text", evidence_summary="sum",
        candidate_sdgs=["SDG 1"], evidence_tags=[], implementation_stage="mention_only",
        quantitative_support=False, oversight_support=False, confidence=0.5, rationale="r",
        validation_status="pending", validation_errors=[], computed_strength="", computed_score=0,
    )

    def build(cases: dict):
        rows = [
            tuple({"case": name, **base, **over}[f.name] for f in records_schema)
            for name, over in cases.items()
        ]
        return spark.createDataFrame(rows, records_schema)

    return build


def by_case(df, *columns):
    rows = df.select("case", *columns).collect()
    if len(columns) == 1:
        return {r["case"]: r[1] for r in rows}
    return {r["case"]: tuple(r)[1:] for r in rows}
