"""Hybrid ranking of chunks: vector similarity, keyword hits, rhetoric penalty."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta.functions.blocks import first_n
from attesta.functions.numbers import round_binary
from attesta.functions.text import any_match, left_out, once, preview
from attesta.functions.vectors import blend, cosine, norm
from attesta.params import RetrievalParams
from attesta.staging import staged


CHUNK_KEY = ["report_id", "chunk_no"]


def _distinct_keywords(lexicon: dict) -> list[str]:
    return list(dict.fromkeys(word for group in lexicon.values() for word in group))


def _hits(lowered: Column, keywords: list[str]) -> Column:
    return F.array_compact(
        F.array(*[F.when(lowered.contains(word), F.lit(word)) for word in keywords])
    )


def keyword_hits(text, lexicon: dict) -> Column:
    """Distinct lexicon entries contained in the text, in lexicon order."""
    keywords = _distinct_keywords(lexicon)
    return once(F.lower(text), lambda lowered: _hits(lowered, keywords))


def keyword_score(hits, full: int = 8) -> Column:
    return F.least(F.size(hits) / F.lit(float(full)), F.lit(1.0))


def is_rhetoric(text, params: RetrievalParams = RetrievalParams()) -> Column:
    """Stock phrases without any figure, target or oversight wording."""
    return any_match(text, params.rhetoric) & ~any_match(text, params.action)


def keyword_profile(
    chunks: DataFrame, keys: list[str], params: RetrievalParams = RetrievalParams()
) -> DataFrame:
    """Number of distinct keywords per chunk and lexicon category, zeros left out."""

    def counts(lowered: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(category).alias("category"),
                    F.size(_hits(lowered, list(dict.fromkeys(group)))).alias("n_hits"),
                )
                for category, group in params.lexicon.items()
            ]
        )

    return chunks.select(*keys, F.inline(once(F.lower("text"), counts))).filter(
        F.col("n_hits") > 0
    )


def embed_texts(
    chunks: DataFrame,
    embed: Callable[[list[str]], list[list[float]]],
    params: RetrievalParams = RetrievalParams(),
    text: str = "text",
) -> DataFrame:
    """Add vectors from a user function that maps a batch of texts to vectors.

    With ``params.embed_chars`` set, ``chars_left_out`` tells what the limit cost.
    """

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([list(map(float, v)) for v in embed(batch.tolist())])

    embedded = chunks.withColumn("vector", vectors(preview(F.col(text), params.embed_chars)))
    if params.embed_chars is None:
        return embedded
    return embedded.withColumn("chars_left_out", left_out(text, params.embed_chars))


def attach_vectors(chunks: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Add vectors from a table with one row per key; a chunk without one keeps a
    null vector (see ``missing_vectors``)."""
    return chunks.join(vectors.select(*keys, "vector"), keys, "left")


def missing_vectors(chunks: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks that have no vector and so cannot be ranked."""
    known = vectors.filter(F.col("vector").isNotNull()).select(*keys)
    return chunks.join(known, keys, "left_anti")


def blend_queries(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Mix two query tables (query_id, vector) entry by entry."""
    return base.join(
        extra.select("query_id", F.col("vector").alias("extra_vector")), "query_id"
    ).select("query_id", blend(F.col("vector"), F.col("extra_vector")).alias("vector"))


def pair_with_queries(
    chunks: DataFrame,
    queries: DataFrame,
    spread: Column,
    group_size: int = 32,
    salts: int = 64,
) -> DataFrame:
    """Every chunk with every query, as an equi-join.

    Queries are packed into groups of ``group_size`` and repeated per salt;
    chunks carry a salt and the group numbers. A handful of queries makes a
    table Spark broadcasts by its size; a large set is shuffled by (group,
    salt), with no key larger than a share of the chunks.
    """
    n_groups = queries.agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(group_size))).cast("int").alias("n")
    )
    packed = (
        queries.withColumn("n_groups", n_groups.scalar())
        .withColumn("q_group", F.pmod(F.xxhash64("query_id"), F.col("n_groups")).cast("int"))
        .groupBy("q_group")
        .agg(
            F.collect_list(
                F.struct(
                    "query_id",
                    F.col("vector").alias("query_vector"),
                    norm(F.col("vector")).alias("query_norm"),
                )
            ).alias("queries")
        )
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    left = (
        chunks.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
        .withColumn("n_groups", n_groups.scalar())
        .withColumn("q_group", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)))
    )
    return (
        left.join(packed, ["q_group", "salt"])
        .drop("q_group", "salt", "n_groups")
        .select("*", F.inline("queries"))
        .drop("queries")
    )


def score_chunks(
    chunks: DataFrame,
    queries: DataFrame,
    params: RetrievalParams = RetrievalParams(),
    keys: list[str] = CHUNK_KEY,
) -> DataFrame:
    """Hybrid score of every chunk for every query.

    Chunks need the key, text and vector; queries need query_id and vector.
    Text work is done once per chunk, and texts stay behind: only keys, flags
    and vectors take part in the pairing.
    """
    prepared = chunks.select(
        *keys,
        "vector",
        keyword_hits("text", params.lexicon).alias("keyword_hits"),
        is_rhetoric(F.col("text"), params).alias("rhetoric"),
        norm(F.col("vector")).alias("chunk_norm"),
    )
    paired = pair_with_queries(prepared, queries, F.struct(*keys))
    similarity = cosine(
        F.col("query_vector"), F.col("vector"), F.col("query_norm"), F.col("chunk_norm")
    )
    mixed = params.vector_weight * F.col("similarity") + params.keyword_weight * F.col(
        "keyword_score"
    )
    return (
        paired.withColumn("similarity", similarity)
        .withColumn("keyword_score", keyword_score("keyword_hits", params.keywords_for_full_score))
        .withColumn(
            "raw_score",
            F.when(F.col("rhetoric"), mixed * params.rhetoric_factor).otherwise(mixed),
        )
        .drop("query_vector", "query_norm", "chunk_norm", "vector")
    )


def top_chunks(
    scored: DataFrame,
    keys: list[str] = ("report_id", "query_id"),
    params: RetrievalParams = RetrievalParams(),
) -> DataFrame:
    """Best chunks per key above the floor; ties keep chunk order."""
    best = first_n(
        scored.filter(F.col("raw_score") >= params.floor),
        list(keys),
        [F.col("raw_score").desc(), F.col("chunk_no")],
        params.top_k,
        "chunk_rank",
    )
    return best.withColumn("retrieval_score", round_binary(F.col("raw_score"), 4))


# --- top-k without all pairs ----------------------------------------------------------

SLACK = 1e-9  # rounding of the bounds


def _angle(a, b, norm_a, norm_b) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine(a, b, norm_a, norm_b))))


def pivot_vectors(chunks: DataFrame, keys: list[str], n: int) -> DataFrame:
    """One row with at most n vectors of positive length, drawn by a hash of the key."""
    drawn = (
        chunks.select(*keys, "vector", norm(F.col("vector")).alias("size"))
        .filter("size > 0").orderBy(F.xxhash64(*keys), *keys).limit(n)
    )
    return drawn.agg(F.collect_list(F.struct("vector", "size")).alias("pivots"))


def index_chunks(
    chunks: DataFrame,
    params: RetrievalParams = RetrievalParams(),
    keys: list[str] = CHUNK_KEY,
) -> tuple[DataFrame, DataFrame]:
    """Chunks with the text part of their score, the nearest pivot and the angle to it,
    and the row of pivots; both staged.

    Chunks without a vector cannot be ranked and are left out; a vector without length
    has pivot -1.
    """
    pivots = staged(pivot_vectors(chunks, keys, params.pivots))
    prepared = chunks.filter(F.col("vector").isNotNull()).select(
        *keys,
        "vector",
        keyword_hits("text", params.lexicon).alias("keyword_hits"),
        is_rhetoric(F.col("text"), params).alias("rhetoric"),
        norm(F.col("vector")).alias("chunk_norm"),
    ).withColumn("keyword_score", keyword_score("keyword_hits", params.keywords_for_full_score))
    near = F.array_min(
        F.transform(
            F.col("pivots"),
            lambda p, i: F.struct(
                _angle(F.col("vector"), p["vector"], F.col("chunk_norm"), p["size"]).alias("angle"),
                i.alias("pivot"),
            ),
        )
    )
    with_pivot = (
        prepared.withColumn("pivots", pivots.scalar())
        .withColumn("near", F.when(F.col("chunk_norm") > 0, near))
        .withColumn("pivot", F.coalesce("near.pivot", F.lit(-1)))
        .withColumn("angle", F.coalesce("near.angle", F.lit(0.0)))
        .drop("pivots", "near")
    )
    return staged(with_pivot), pivots


def block_bounds(
    index: DataFrame, pivots: DataFrame, queries: DataFrame, params: RetrievalParams, group: list[str]
) -> DataFrame:
    """(group, pivot, query_id, n, bound, seed): the highest score that a chunk of a
    block (the chunks of a group at one pivot) can reach for a query.

    An angle differs from the query's angle to the pivot by at least the gap between
    that and the block's range of angles. ``seed`` marks the blocks with the highest
    bounds that together hold ``top_k`` chunks.
    """
    factor = F.when(F.col("rhetoric"), F.lit(params.rhetoric_factor)).otherwise(F.lit(1.0))
    blocks = index.groupBy(*group, "pivot").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("angle").alias("low"),
        F.max("angle").alias("high"),
        F.max("keyword_score").alias("words"),
        F.min(factor).alias("least"),
        F.max(factor).alias("most"),
    )
    at = F.transform(
        F.col("pivots"),
        lambda p, i: F.struct(
            i.alias("pivot"), _angle(F.col("vector"), p["vector"], F.col("size"), p["size"]).alias("at")
        ),
    )
    none = F.array(F.struct(F.lit(-1).alias("pivot"), F.lit(0.0).alias("at")))
    angles = (
        queries.select("query_id", "vector", norm(F.col("vector")).alias("size"))
        .withColumn("pivots", pivots.scalar())
        .select("query_id", F.inline(F.concat(at, none)))
    )
    gap = F.greatest(F.lit(0.0), F.col("at") - F.col("high"), F.col("low") - F.col("at"))
    similar = F.when(F.col("pivot") == -1, F.lit(0.0)).otherwise(F.cos(gap) + SLACK)
    mixed = params.vector_weight * similar + params.keyword_weight * F.col("words")
    bound = F.greatest(F.col("most") * mixed, F.col("least") * mixed) + SLACK
    bounded = blocks.join(angles, "pivot").select(*group, "pivot", "query_id", "n", bound.alias("bound"))
    earlier = (
        W.partitionBy(*group, "query_id").orderBy(F.desc("bound"), "pivot").rowsBetween(W.unboundedPreceding, -1)
    )
    return bounded.withColumn("seed", F.coalesce(F.sum("n").over(earlier), F.lit(0)) < params.top_k)


def _scored_blocks(
    index: DataFrame, blocks: DataFrame, queries: DataFrame, params: RetrievalParams, group: list[str]
) -> DataFrame:
    """Exact scores of the chunks in the given blocks."""
    named = queries.select(
        "query_id", F.col("vector").alias("query_vector"), norm(F.col("vector")).alias("query_norm")
    )
    met = index.join(blocks.select(*group, "pivot", "query_id"), [*group, "pivot"]).join(named, "query_id")
    similarity = cosine(F.col("query_vector"), F.col("vector"), F.col("query_norm"), F.col("chunk_norm"))
    mixed = params.vector_weight * F.col("similarity") + params.keyword_weight * F.col("keyword_score")
    return (
        met.withColumn("similarity", similarity)
        .withColumn("raw_score", F.when(F.col("rhetoric"), mixed * params.rhetoric_factor).otherwise(mixed))
        .drop("query_vector", "query_norm", "chunk_norm", "vector", "pivot", "angle")
    )


def wanted_blocks(
    bounds: DataFrame, seeds: DataFrame, params: RetrievalParams, group: list[str]
) -> DataFrame:
    """The blocks beyond the seeds whose bound reaches the score that is already sure
    to be among the best, and the floor."""
    keys = [*group, "query_id"]
    best = first_n(seeds.select(*keys, "raw_score"), keys, [F.desc("raw_score")], params.top_k, "rn")
    sure = best.groupBy(*keys).agg(
        F.when(F.count(F.lit(1)) >= params.top_k, F.min("raw_score")).alias("sure")
    )
    least = F.greatest(F.col("sure"), F.lit(params.floor))  # greatest skips NULL
    return bounds.filter(~F.col("seed")).join(sure, keys, "left").filter(F.col("bound") >= least)


def best_chunks(
    chunks: DataFrame,
    queries: DataFrame,
    params: RetrievalParams = RetrievalParams(),
    keys: list[str] = CHUNK_KEY,
    group: list[str] = ("report_id",),
) -> DataFrame:
    """The best chunks per group and query, the same rows as ``top_chunks`` of
    ``score_chunks``, without scoring every chunk for every query.

    Chunks are blocked by their nearest pivot. The blocks with the highest bounds are
    scored first; their kth best score rules out every block with a lower bound.
    """
    group = list(group)
    index, pivots = index_chunks(chunks, params, keys)
    bounds = staged(block_bounds(index, pivots, queries, params, group))
    seeds = staged(_scored_blocks(index, bounds.filter("seed"), queries, params, group))
    rest = _scored_blocks(index, wanted_blocks(bounds, seeds, params, group), queries, params, group)
    return top_chunks(seeds.union(rest), [*group, "query_id"], params)


def retrieve(
    chunks: DataFrame, queries: DataFrame, params: RetrievalParams = RetrievalParams()
) -> DataFrame:
    """Best chunks per report and query, with all their columns but the vector.

    Texts are fetched for the winners only, by a join on the chunk key.
    """
    return best_chunks(chunks, queries, params).join(chunks.drop("vector"), CHUNK_KEY)
