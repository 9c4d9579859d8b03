"""Near-duplicate groups by SimHash fingerprints and Golay fuzzy hashing.

1. Fingerprint: majority bits of the 64-bit hashes of word shingles.
2. Equal fingerprints are one node, so thousands of copies cost one row.
3. Keys: the fingerprint is cut into segments of 23, 23 and 18 bits. With at
   most two differing bits one segment is equal (pigeonhole), and its neighbour
   segment differs in at most two, so the two share a Golay index. A key is
   (segment number, its bits, a Golay index of the next segment).
4. Fingerprints that share a key are compared exactly. A key with more than
   `bucket` fingerprints is not compared in pairs: its members are grouped by
   the 65 words within one bit of each. Members of such a group are within two
   bits of each other and any two linked members share a group, which holds 65
   fingerprints at most.
5. Components of the links; a component's id is its smallest document id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm import golay
from attesta.llm.common import id_text, ids_of, lean, small_batches, staged, text_of
from attesta.llm.components import components

SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, width
BLOCK = 100_000  # shingles hashed at a time


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 3
    seed: int = 42
    bucket: int = 64  # keys with more fingerprints are split by one-bit neighbours


def majority(hashes: np.ndarray) -> int:
    """SimHash of 64-bit hashes as a signed number; 0 without hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BLOCK):
        part = hashes[start : start + BLOCK].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """SimHash as a signed 64-bit number; 0 for a text without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    total, ones = len(words) - size + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, BLOCK):
        part = words[start : start + BLOCK + size - 1]
        hashes = np.array(
            [digest(b" ".join(s), seed) for s in zip(*(part[i:] for i in range(size)))], ">u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total).view(">i8")[0])


def fingerprints(docs: DataFrame, params: SimHashParams) -> DataFrame:
    """(doc_id, fp) per document, whole texts; a null text counts as empty."""
    shingle, seed = params.shingle, params.seed

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = [fingerprint(t, shingle, seed) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": ids_of(batch["doc_id"]), "fp": np.array(fps, np.int64)})

    rows = small_batches(docs).select(id_text("doc_id").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(run, "doc_id bigint, fp bigint")


def bucket_keys(nodes: DataFrame) -> DataFrame:
    """(key, fp): the keys of each distinct fingerprint."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = golay.tables()
        for batch in lean(batches):
            fp = batch["fp"].to_numpy(np.int64)
            cut = [(fp >> np.int64(a)) & np.int64((1 << w) - 1) for a, w in SEGMENTS]
            for number, (_, width) in enumerate(SEGMENTS):
                following = (number + 1) % len(SEGMENTS)
                index = golay.keys(cut[following], parts, SEGMENTS[following][1])
                row, column = np.nonzero(index >= 0)
                key = ((number << 23 | cut[number][row]) << 12) | index[row, column]
                yield pd.DataFrame({"key": key.astype(np.int64), "fp": fp[row]})

    return nodes.select("fp").mapInPandas(run, "key bigint, fp bigint")


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _bucket_links(buckets: DataFrame) -> DataFrame:
    """Spanning links of the verified pairs inside buckets of bounded size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in lean(batches):
            u, v = [], []
            for members in batch["fps"]:
                fp = np.sort(np.asarray(members, np.int64))
                apart = np.bitwise_count(fp[:, None] ^ fp[None, :])
                near, label = apart <= 2, np.arange(len(fp))
                while True:  # smallest reachable member
                    lower = np.where(near, label[None, :], len(fp)).min(axis=1)
                    if (lower == label).all():
                        break
                    label = lower
                moved = label != np.arange(len(fp))
                u.append(fp[moved])
                v.append(fp[label[moved]])
            if u:
                yield pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)})

    return buckets.select("fps").mapInPandas(run, "u bigint, v bigint")


def _neighbour_links(fps: DataFrame) -> DataFrame:
    """Links of fingerprints that share a word within one bit of both."""
    one = F.lit(1).cast("bigint")
    flips = [F.col("fp")] + [
        F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, F.lit(i))) for i in range(64)
    ]
    near = fps.select("fp", F.explode(F.array(*flips)).alias("word"))
    groups = near.groupBy("word").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return groups.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).filter("u <> v")


def links(nodes: DataFrame, params: SimHashParams) -> DataFrame:
    """Links (u, v) that connect all fingerprints within two bits of each other."""
    keys = bucket_keys(nodes)
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = staged(keys.join(sizes, "key"), "buckets")
    small = (
        shared.filter(F.col("n") <= params.bucket)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("fps"))
    )
    large = shared.filter(F.col("n") > params.bucket).select("fp").distinct()
    found = _bucket_links(small).union(_neighbour_links(large))
    found.staged_paths = shared.staged_paths
    return found


def near_duplicates(docs: DataFrame, params: SimHashParams | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id, group_fp): the group of every document.

    A null or blank text has the fingerprint zero and is linked like any other.
    Rows with a null id take part and get the smallest id of their group, null
    if it has none. Repeated rows give repeated results; other columns are not
    read; an empty table gives no rows.
    """
    params = params or SimHashParams()
    found = staged(fingerprints(docs, params), "fingerprints")
    nodes = staged(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes, params))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    names = staged(rooted.join(least, "root").select("fp", "component_id", "root"), "names")
    return found.join(names, "fp").select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id",
        hex_digits(F.col("root")).alias("group_fp"),
    )


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, params: SimHashParams | None = None) -> DataFrame:
    """One row of `docs`, all columns, per group: the one with the smallest id.

    A null id is the last; of equal ids the smaller fingerprint stays, of equal
    rows one.
    """
    params = params or SimHashParams()
    shingle, seed = params.shingle, params.seed

    @F.pandas_udf("bigint")
    def marked(text: pd.Series) -> pd.Series:
        return text.map(lambda t: fingerprint(t, shingle, seed))

    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fingerprint")
    kept = near_duplicates(docs, params).groupBy("group_fp").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias("_kept_id"), F.col("k.fingerprint").alias("_kept_fp")
    )
    rows = docs.withColumn("_fp", hex_digits(marked(text_of())))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_kept_id")) & (F.col("_fp") == F.col("_kept_fp"))
    one = Window.partitionBy("doc_id", "_fp").orderBy(F.col("text").asc_nulls_first())
    first = rows.join(kept, same, "left_semi").withColumn("_row", F.row_number().over(one))
    return first.filter("_row = 1").select(*docs.columns)
