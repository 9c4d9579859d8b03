"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments; an index row holds (segment, its value, code).
In round r every open query looks up all values at distance exactly r from each
of its segments. A code at distance d from the query differs in at most
floor(d / segments) bits in some segment, so after round r every code closer than
segments * (r + 1) has been seen. A query is closed once its kth best verified
distance is below that bound. Nothing is approximate and no candidate is cut.

Equal codes are one index row with the count of rows and the k + 1 smallest ids,
all that a result can need; equal queries are searched once.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import staged, unstage

BITS = 64


@dataclass(frozen=True)
class HammingParams:
    k: int = 10
    segments: int = 4


def code_of(vector: Column) -> Column:
    """Bit i is 1 if element i is positive; missing and null elements count as 0.

    Null for a null vector. A vector of more than 64 elements is an error.
    """
    one = F.lit(1).cast("bigint")
    checked = F.when(
        F.size(vector) > BITS, F.raise_error(F.lit(f"codes have {BITS} bits; the vector has more elements"))
    ).otherwise(vector)
    bits = F.transform(
        checked,
        lambda x, i: F.when(x > 0, F.call_function("shiftleft", one, i)).otherwise(F.lit(0).cast("bigint")),
    )
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segment(code: Column, number: int, width: int) -> Column:
    return F.shiftrightunsigned(code, number * width).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _nearest_segment(a: Column, b: Column, segments: int) -> Column:
    """(least segment distance, first segment that has it)."""
    width = BITS // segments
    apart = a.bitwiseXOR(b)
    return F.least(*[
        F.bit_count(_segment(apart, j, width)) * segments + j for j in range(segments)
    ])


def _masks(width: int, radius: int) -> Column:
    """Constant array of all words of `width` bits with `radius` ones."""
    masks = (sum(1 << b for b in bits) for bits in combinations(range(width), radius))
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best (distance, id) of each query code; limited before the shuffle."""
    order = Window.partitionBy("query").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def nearest(codes: DataFrame, queries: DataFrame, params: HammingParams | None = None) -> DataFrame:
    """The k nearest rows of every query row, nearest first, ties by id.

    Both frames have columns id and code; a query does not find its own id. Rows
    with a null id or code take no part. Repeated rows count once per distinct
    (id, code). Fewer than k other rows: all of them. Result: query_id, rank,
    neighbor_id, distance.
    """
    params = params or HammingParams()
    width, keep = BITS // params.segments, params.k + 1
    if width * params.segments != BITS:
        raise ValueError("segments must divide 64")
    present = F.col("id").isNotNull() & F.col("code").isNotNull()
    rows = codes.filter(present).select("id", "code").distinct()
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id")))
    index = staged(
        numbered.filter(F.col("n") <= keep).groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")),
        "codes",
    )
    asked = staged(queries.filter(present).select("id", "code").distinct(), "queries")
    open_queries = staged(asked.select(F.col("code").alias("query")).distinct(), "open")
    best, closed = None, []
    reachable = index.select(F.sum(F.size("ids"))).first()[0] or 0
    wanted = min(keep, reachable)  # with fewer rows than k, all of them close a query
    lookup = index.select(
        "code", "ids", F.posexplode(F.array(*[_segment(F.col("code"), j, width) for j in range(params.segments)]))
        .alias("segment", "value"),
    )
    for radius in range(width + 1):
        masks = _masks(width, radius)
        probes = open_queries.select(
            "query",
            F.posexplode(F.array(*[_segment(F.col("query"), j, width) for j in range(params.segments)]))
            .alias("segment", "own"),
        ).select("query", "segment", F.explode(masks).alias("mask"), "own").select(
            "query", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value")
        )
        # a pair counts in the round and segment that reach it first
        first = _nearest_segment(F.col("query"), F.col("code"), params.segments)
        # merged, not broadcast: a probe table grows with queries and radius
        hits = probes.hint("merge").join(lookup, ["segment", "value"]).filter(
            first == F.lit(radius * params.segments) + F.col("segment")
        )
        found = hits.select(
            "query", distance(F.col("query"), F.col("code")).alias("distance"), F.explode("ids").alias("id")
        )
        now = _best(found if best is None else found.unionByName(best), keep)
        best = staged(now, "best")
        bound = params.segments * (radius + 1)
        kth = best.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        state = open_queries.join(kth, "query", "left").withColumn(
            "done",
            F.coalesce((F.col("n") >= wanted) & ((F.col("far") < bound) | F.lit(wanted == reachable)), F.lit(False))
            | F.lit(radius == width),
        )
        state = staged(state, "state")
        closed.append(best.join(state.filter("done"), "query", "left_semi"))
        rest = staged(state.filter(~F.col("done")).select("query"), "open")
        unstage(open_queries)
        open_queries = rest
        best = best.join(rest, "query", "left_semi")
        if rest.isEmpty():
            break
    result = closed[0]
    for part in closed[1:]:
        result = result.unionByName(part)
    pairs = asked.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(result, "query")
    others = pairs.filter(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id", "query").orderBy("distance", "id")
    return others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= params.k).select(
        "query_id", "rank", F.col("id").alias("neighbor_id"), "distance"
    )
