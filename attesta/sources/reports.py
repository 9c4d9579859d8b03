"""Page, span and vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta import schemas


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per page; empty and unreadable pages stay, with empty text."""
    pages = spark.read.format(fmt).schema(schemas.PAGE).load(path)
    return pages.withColumn("text", F.coalesce("text", F.lit("")))


def read_spans(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(schemas.SPAN).load(path)


def read_vectors(spark: SparkSession, path: str, key: str, vector: str) -> DataFrame:
    return spark.read.parquet(path).select(key, F.col(vector).alias("vector"))
