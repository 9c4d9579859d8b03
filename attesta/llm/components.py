"""Connected components of an edge table by alternating star operations.

Every round rewrites edges towards the smallest neighbour; labels meet after a
logarithmic number of rounds. Only edges move, each round is written to the
shared folder, and nothing is collected. A node with very many edges is met in
partially aggregated minima and in sort-merge joins against one row per node,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import staged, unstage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter(F.col("v") > F.col("u"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge; the root is the smallest node.

    `edges` has columns u and v of one orderable type; loops and repeats are
    allowed, rows with a null are not edges. The result reads a staged table, which
    `unstage` of it deletes.
    """
    current = staged(
        edges.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    state = None
    for _ in range(max_rounds):
        after = staged(_small_star(_large_star(current)).distinct(), "edges")
        now = after.select(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        unstage(current)
        current = after
        if now == state:
            result = current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
            result.staged_paths = current.staged_paths
            return result
        state = now
    raise RuntimeError("components did not settle")
