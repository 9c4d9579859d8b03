"""Registered queries: SQL comparison, no cross products in plans, empty tables."""

import os

import pytest
from oracle_check import TABLES, compare, duck

import __spark_entry__ as entry

DATA = os.environ.get("ATTESTA_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for table in TABLES:
        df = spark.read.parquet(f"{DATA}/{table}.parquet")
        spark.createDataFrame([], df.schema).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    status, n, _, note = compare(
        spark, con, DATA, name, entry.queries()[name], entry.oracle_sql().get(name)
    )
    assert status in ("ok", "rows-only"), note
    assert n > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_on_empty_tables(spark, empty_folder, name):
    entry.queries()[name](spark, empty_folder).collect()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_and_sql_belong_together():
    assert set(entry.oracle_sql()) <= set(entry.queries())
