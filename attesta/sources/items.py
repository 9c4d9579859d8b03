"""Labelled items in JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta import schemas
from attesta.functions.text import strip
from attesta.operators.evaluation import with_item_defaults


def parse_item_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add the parsed item and a status per line: item, skipped or malformed.

    Blank lines and lines starting with # are skipped.
    """
    text = strip(column)
    skipped = (text == "") | text.startswith("#")
    sound = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    single = F.size(F.try_variant_get(sound, "$", "array<variant>")) == 1
    status = (
        F.when(skipped, F.lit("skipped"))
        .when(F.coalesce(single, F.lit(False)), F.lit("item"))
        .otherwise(F.lit("malformed"))
    )
    return lines.withColumn("line_status", status).withColumn(
        "item",
        F.when(F.col("line_status") == "item", F.from_json(text, schemas.LABELLED_ITEM)),
    )


def items_of(parsed: DataFrame) -> DataFrame:
    return with_item_defaults(
        parsed.filter(F.col("line_status") == "item").select("item.*")
    )


def line_counts(parsed: DataFrame) -> DataFrame:
    """Number of lines by status, so that dropped lines are never silent."""
    return parsed.groupBy("line_status").agg(F.count(F.lit(1)).alias("n_lines"))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return items_of(parse_item_lines(spark.read.text(path)))
