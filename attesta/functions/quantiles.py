"""Exact quantiles of a column without gathering its values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, value: str, probs: list[float], cuts: int = 256) -> DataFrame:
    """Linearly interpolated quantiles: rows (prob, quantile).

    1. Equal values are counted together. 2. A fixed number of approximate
    cut points splits the values into ranges of similar weight. 3. Range
    totals, one short table, give each range its starting rank. 4. Values
    inside a range are ranked separately. Only the order statistics next to a
    wanted rank leave step 4.
    """
    data = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    points = [i / cuts for i in range(1, cuts)]
    cut_points = data.agg(
        F.array_distinct(F.percentile_approx("v", points, 20 * cuts)).alias("c")
    )
    counted = data.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    binned = counted.withColumn("c", cut_points.scalar()).select(
        "v", "n", F.size(F.filter("c", lambda x: x <= F.col("v"))).alias("bin")
    )
    totals = binned.groupBy("bin").agg(F.sum("n").alias("bin_n"))
    before = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "bin",
        F.coalesce(F.sum("bin_n").over(before), F.lit(0)).alias("start"),
        F.sum("bin_n").over(W.orderBy("bin").rowsBetween(
            W.unboundedPreceding, W.unboundedFollowing)).alias("total"),
    )
    inside = W.partitionBy("bin").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        binned.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(starts, "bin")
        .select("v", "total", (F.col("start") + F.col("inside")).alias("lo"), "n")
    )
    # Positions are counted from 0; a value covers positions lo .. lo + n - 1.
    # Only values next to a wanted position are repeated per probability.
    last = F.col("lo") + F.col("n") - 1
    near = F.filter(
        F.array(*[F.lit(float(p)) for p in probs]),
        lambda p: (F.ceil(p * (F.col("total") - 1)) >= F.col("lo"))
        & (F.floor(p * (F.col("total") - 1)) <= last),
    )
    wanted = ranked.select("*", F.explode(near).alias("prob")).withColumn(
        "pos", F.col("prob") * (F.col("total") - 1)
    )
    lower = F.when(F.floor("pos").between(F.col("lo"), last), F.col("v"))
    upper = F.when(F.ceil("pos").between(F.col("lo"), last), F.col("v"))
    return (
        wanted.withColumn("low", lower)
        .withColumn("high", upper)
        .groupBy("prob")
        .agg(F.max("low").alias("low"), F.max("high").alias("high"), F.max("pos").alias("pos"))
        .select(
            "prob",
            (F.col("low") + (F.col("high") - F.col("low")) * (F.col("pos") - F.floor("pos"))).alias(
                "quantile"
            ),
        )
    )
