"""Near-duplicate groups by the exact Jaccard similarity of word shingles.

1. Equal word sequences are one node, so thousands of copies cost one row. Nodes are
   numbered once; everything after that moves numbers.
2. SimHash fingerprints of the shingle sets meet by their Golay keys (`simhash.py`); nodes
   with equal fingerprints, or linked within two bits, are compared first. Edited copies at
   the wanted similarity are mostly further apart, so these keys alone lose links.
3. Keys for the rest: MinHash values of the shingle sets, in bands. Two texts at the wanted
   similarity share no band with probability (1 - similarity ** rows) ** bands,
   5e-6 with the defaults.
4. Every member of a band bucket is compared with the smallest number it shares a
   bucket with. The components of these links settle most buckets.
5. Buckets whose members are still in several components are compared in cells: the
   largest component's members in blocks, the others in blocks, and every block of the
   others with every block. A member travels once per cell, not once per pair. Inside a
   cell only pairs of different components are looked at, in the first band that both
   share, unless their sizes or their one-bit MinHash sketches rule the similarity out
   (five standard deviations).
6. A link is kept only if the exact similarity of the two shingle sets is at least
   the wanted one. Sets are built only for nodes that share a bucket.
   With more than one block of others, members are first compared with one that is drawn
   per bucket and round, which settles large groups of near copies. With more than
   `many` blocks, buckets are split by every further band, which parts texts that only
   share a common passage (at similarity 0.5 one pair in seventy stays together); a pair
   at the wanted similarity agrees in fewer than four bands, and may then be missed in
   such a bucket, with probability 3e-4 (at 0.85: 1e-7).
7. Components of the links; the smallest document id of each stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm import simhash
from attesta.llm.common import id_text, ids_of, lean, small_batches, staged, text_of, unstage
from attesta.llm.components import components

BLOCK = 2048  # shingles per step of the MinHash
SLOT_BITS = 22  # bitmap that skips texts without a shared bucket


@dataclass(frozen=True)
class NearParams:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 50  # 63 at most
    rows: int = 6  # MinHash values per band
    block: int = 2048  # members of a block
    block_shingles: int = 4_000_000  # and their shingles
    rounds: int = 2  # comparisons of crowded buckets with a drawn member
    many: int = 16  # blocks of others above which a bucket is split
    splits: int = 3  # further bands that split it
    seed: int = 42


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def node_of(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def shingles(words: list[bytes], params: NearParams) -> np.ndarray:
    """Sorted distinct 64-bit hashes; a shorter text is one shingle."""
    size = min(params.shingle, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    digest, seed = xxhash.xxh64_intdigest, params.seed
    found = {digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(size)))}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted, distinct, non-empty arrays."""
    both = np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b)
    return both / (len(a) + len(b) - both)


class Signer:
    """Band keys and sketch of a shingle set."""

    def __init__(self, params: NearParams):
        self.params, n = params, params.bands * params.rows
        rng = np.random.default_rng(params.seed)
        self.factor = rng.integers(0, 1 << 64, (n, 1), np.uint64) | np.uint64(1)
        self.shift = rng.integers(0, 1 << 64, (n, 1), np.uint64)

    def sign(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = np.full(len(self.factor), (1 << 64) - 1, np.uint64)
        for start in range(0, len(hashes), BLOCK):
            part = self.factor * hashes[None, start : start + BLOCK] + self.shift
            least = np.minimum(least, part.min(axis=1))
        bands = least.reshape(self.params.bands, self.params.rows)
        keys = [xxhash.xxh64_intdigest(band.tobytes(), number) for number, band in enumerate(bands)]
        bits = np.zeros(-(-len(least) // 64) * 64, np.uint8)
        bits[: len(least)] = (least >> np.uint64(20)) & np.uint64(1)
        return np.array(keys, np.uint64).view(np.int64), np.packbits(bits).view(np.int64)


def nodes_of(docs: DataFrame, params: NearParams) -> DataFrame:
    """(number, node, first, size, fp, keys, sketch) per distinct word sequence, staged.

    No keys without words; `first` is the smallest document id, null ids last.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signer = Signer(params)
        for batch in lean(batches):
            rows = []
            for text in batch["text"]:
                words = words_of(text)
                found = shingles(words, params)
                keys, sketch = signer.sign(found)
                rows.append((node_of(words), len(found), simhash.majority(found), keys if words else keys[:0], sketch))
            out = pd.DataFrame(rows, columns=["node", "size", "fp", "keys", "sketch"])
            yield out.assign(doc_id=ids_of(batch["doc_id"]))

    rows = small_batches(docs).select(id_text("doc_id").alias("doc_id"), text_of().alias("text"))
    signed = rows.mapInPandas(
        run, "node binary, size int, fp bigint, keys array<bigint>, sketch array<bigint>, doc_id bigint"
    )
    nodes = signed.groupBy("node").agg(
        F.min("doc_id").alias("first"), F.any_value("size").alias("size"), F.any_value("fp").alias("fp"),
        F.any_value("keys").alias("keys"),
        F.any_value("sketch").alias("sketch"),
    )
    return staged(nodes.withColumn("number", F.monotonically_increasing_id()), "nodes")


def _sets(docs: DataFrame, members: DataFrame, params: NearParams) -> DataFrame:
    """(number, hashes) of the nodes in `members`, staged."""
    slot = F.conv(F.hex(F.substring("node", 1, 3)), 16, 10).cast("int")
    taken = members.select(F.shiftright(slot, 24 - SLOT_BITS).alias("slot")).distinct().toPandas()
    wanted = np.zeros(1 << SLOT_BITS, bool)
    wanted[taken["slot"].to_numpy(np.int64)] = True
    packed = np.packbits(wanted).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unpackbits(np.frombuffer(packed, np.uint8))
        for batch in lean(batches):
            rows, seen = [], set()
            for text in batch["text"]:
                words = words_of(text)
                node = node_of(words)
                if node not in seen and known[int.from_bytes(node[:3], "big") >> (24 - SLOT_BITS)]:
                    seen.add(node)
                    rows.append((node, shingles(words, params).view(np.int64)))
            if rows:
                yield pd.DataFrame(rows, columns=["node", "hashes"])

    found = small_batches(docs).select(text_of().alias("text")).mapInPandas(
        run, "node binary, hashes array<bigint>"
    )
    met = found.join(members.select("node", "number"), "node")
    return staged(met.groupBy("number").agg(F.any_value("hashes").alias("hashes")), "sets")


def _limit(params: NearParams) -> int:
    """Sketch bits in which two texts at the wanted similarity may differ."""
    n, differ = params.bands * params.rows, (1 - params.similarity) / 2
    return int(n * differ + 5 * (n * differ * (1 - differ)) ** 0.5)


def _verified(pairs: DataFrame, sets: DataFrame, params: NearParams) -> DataFrame:
    """The pairs (u, v) whose exact similarity is at least the wanted one, staged."""
    u = sets.select(F.col("number").alias("u"), F.col("hashes").alias("a"))
    v = sets.select(F.col("number").alias("v"), F.col("hashes").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    similar = both / (F.size("a") + F.size("b") - both) >= params.similarity
    return staged(pairs.join(u, "u").join(v, "v").filter(similar).select("u", "v"), "links")


def _mixed(rows: DataFrame, params: NearParams) -> DataFrame:
    """The rows of buckets with several roots, staged, with the bucket's largest root.

    `blocks` and `others` are the blocks that the members of that root, and all other
    members, are dealt to.
    """

    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / params.block), F.ceil(size / params.block_shingles)).cast("int")

    sizes = rows.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    most = {name: F.max_by(name, F.struct("n", "root")).alias(f"most_{name}") for name in ("root", "n", "size")}
    mixed = sizes.groupBy("key").agg(
        F.count("*").alias("roots"), F.sum("n").alias("n"), F.sum("size").alias("size"), *most.values()
    ).filter("roots > 1")
    return staged(
        rows.join(
            mixed.select(
                "key", F.col("most_root").alias("most"), blocks(F.col("most_n"), F.col("most_size")).alias("blocks"),
                blocks(F.col("n") - F.col("most_n"), F.col("size") - F.col("most_size")).alias("others"),
            ),
            "key",
        ),
        "open",
    )


def _drawn(rows: DataFrame, number: int) -> DataFrame:
    """(u, v): members of crowded buckets with one member, drawn anew in every round."""
    crowded = rows.filter("others > 1")
    order = F.xxhash64("number", "key", F.lit(number))
    center = crowded.groupBy("key").agg(
        F.min_by("number", order).alias("center"), F.min_by("root", order).alias("of")
    )
    met = crowded.join(center, "key").filter(F.col("root") != F.col("of"))
    return met.select(
        F.greatest("number", "center").alias("u"), F.least("number", "center").alias("v")
    ).distinct()


def _cells(rows: DataFrame) -> DataFrame:
    """(key, x, y, block, bands, number, root): every row in each of its bucket's cells.

    Blocks of the largest root are negative; they meet the blocks of the others only.
    """

    def place(count: str) -> Column:
        return F.pmod(F.xxhash64("number"), F.col(count)).cast("int")

    each = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    cell = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    block = F.when(F.col("root") == F.col("most"), -1 - place("blocks")).otherwise(place("others"))
    dealt = rows.withColumn("block", block)
    own = F.col("block")
    of_most = F.transform(each("others"), lambda k: cell(own, k))
    of_others = F.concat(
        F.transform(each("blocks"), lambda k: cell(-1 - k, own)),
        F.transform(each("others"), lambda k: cell(F.least(own, k), F.greatest(own, k))),
    )
    cells = F.explode(F.when(own < 0, of_most).otherwise(of_others))
    return dealt.select("key", cells.alias("cell"), "block", "bands", "number", "root").select(
        "key", "cell.x", "cell.y", "block", "bands", "number", "root"
    )


class Cell:
    """Members of two blocks of a bucket; finds links that connect all similar members."""

    def __init__(self, rows: list, params: NearParams):
        self.params, self.limit = params, _limit(params)
        self.block, bands, self.number, root, size, sketch, keys, hashes = zip(*rows)
        self.root = list(root)
        self.size, self.sketch = np.array(size), np.stack(sketch).view(np.uint64)
        self.hashes = [np.asarray(h).view(np.uint64) for h in hashes]
        # A pair is compared in the first band that both share.
        first = bands[0].bit_length() - 1 if bands[0].bit_count() == 1 else 0
        self.keys = np.stack([k[:first] for k in keys])
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    def links(self) -> Iterator[tuple[int, int]]:
        low, high = min(self.block), max(self.block)
        left = [i for i, b in enumerate(self.block) if b == low]
        right = np.array([i for i, b in enumerate(self.block) if b == high])
        for i in left if low < high else right.tolist():
            other = right if low < high else right[right > i]
            wanted = self.params.similarity
            near = np.minimum(self.size[other], self.size[i]) >= wanted * np.maximum(self.size[other], self.size[i]) - 1e-6
            other = other[near & ~(self.keys[other] == self.keys[i]).any(axis=1)]
            apart = np.bitwise_count(self.sketch[other] ^ self.sketch[i]).sum(axis=1)
            order = np.argsort(apart, kind="stable")
            for j in other[order[apart[order] <= self.limit]].tolist():
                x, y = self.find(self.root[i]), self.find(self.root[j])
                if x != y and jaccard(self.hashes[i], self.hashes[j]) >= wanted:
                    self.parent[max(x, y)] = min(x, y)
                    yield self.number[i], self.number[j]


def _cell_links(rows: DataFrame, members: DataFrame, sets: DataFrame, params: NearParams) -> DataFrame:
    """(u, v): links that connect the members of every bucket, staged."""
    cell = ["key", "x", "y"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for batch in lean(batches):
            found = []
            for *at, block, bands, number, root, size, sketch, keys, hashes in batch.itertuples(index=False):
                if at != now:
                    found += Cell(held, params).links() if len(held) > 1 else []
                    now, held = at, []
                held.append((block, bands, number, root, size, sketch, keys, hashes))
            yield pd.DataFrame(found, columns=["u", "v"], dtype="int64")
        if len(held) > 1:
            yield pd.DataFrame(list(Cell(held, params).links()), columns=["u", "v"], dtype="int64")

    dealt = _cells(rows).join(members.select("number", "size", "sketch", "keys"), "number").join(sets, "number")
    whole = dealt.select(*cell, "block", "bands", "number", "root", "size", "sketch", "keys", "hashes")
    return staged(
        whole.repartition(*cell).sortWithinPartitions(*cell).mapInPandas(run, "u bigint, v bigint"), "links"
    )


def _split(large: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of large buckets in buckets that share one further band."""
    met = large.join(members.select("number", "keys"), "number").select(
        "key", "bands", "number", "size", "root", F.posexplode("keys").alias("band", "other")
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("band"))
    # The same bands in another order give the same key.
    return met.filter(F.col("bands").bitwiseAND(bit) == 0).select(
        F.col("key").bitwiseXOR(F.col("other")).alias("key"), F.col("bands").bitwiseOR(bit).alias("bands"),
        "number", "size", "root",
    ).distinct()


def _rooted(shared: DataFrame, roots: DataFrame) -> DataFrame:
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("band"))
    return shared.join(roots, F.col("number") == F.col("node"), "left").select(
        "key", bit.alias("bands"), "number", "size", F.coalesce("root", "number").alias("root")
    )


def _all_cell_links(rows: DataFrame, members: DataFrame, sets: DataFrame, params: NearParams) -> list[DataFrame]:
    """Links of all buckets, very large ones split by further bands first."""
    parts = []
    for _ in range(params.splits):
        large = rows.filter(F.col("others") > params.many)
        if large.isEmpty():
            break
        parts.append(_cell_links(rows.filter(F.col("others") <= params.many), members, sets, params))
        finer = _mixed(_split(large, members), params)
        unstage(rows)
        rows = finer
    parts.append(_cell_links(rows, members, sets, params))
    unstage(rows)
    return parts


def _golay_pairs(nodes: DataFrame) -> DataFrame:
    """(u, v): nodes whose fingerprints are equal or linked by Golay keys, staged."""
    marked = nodes.filter("size > 0").select("number", "fp")
    fps = staged(marked.groupBy("fp").agg(F.min("number").alias("number")), "fingerprints")
    near = simhash.links(fps, simhash.SimHashParams())
    u = fps.select(F.col("fp").alias("u"), F.col("number").alias("a"))
    v = fps.select(F.col("fp").alias("v"), F.col("number").alias("b"))
    same = marked.join(fps.withColumnRenamed("number", "b"), "fp").select(F.col("number").alias("a"), "b")
    pairs = near.join(u, "u").join(v, "v").select("a", "b").union(same).filter("a <> b")
    found = staged(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "golay")
    unstage(near)
    unstage(fps)
    return found


def links(docs: DataFrame, nodes: DataFrame, params: NearParams) -> DataFrame:
    """Verified links (u, v) that connect all nodes at the wanted similarity."""
    keys = nodes.select("number", "size", F.posexplode("keys").alias("band", "key"))
    least = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("number").alias("least")).filter("n > 1")
    shared = staged(keys.join(least.drop("n"), "key"), "bands")
    star = shared.groupBy("number").agg(F.min("least").alias("least")).filter("number <> least")
    close = _golay_pairs(nodes)
    ends = shared.select("number").union(close.select("u")).union(close.select("v")).distinct()
    members = staged(nodes.drop("first", "fp").join(ends, "number"), "members")
    sets = _sets(docs, members, params)
    parts = [_verified(close, sets, params), _verified(star.select(F.col("number").alias("u"), F.col("least").alias("v")), sets, params)]
    for number in range(params.rounds + 1):
        roots = components(_union(parts))
        rows = _mixed(_rooted(shared, roots), params)
        unstage(roots)
        if number == params.rounds or rows.filter("others > 1").isEmpty():
            break
        parts.append(_verified(_drawn(rows, number), sets, params))
        unstage(rows)
    parts += _all_cell_links(rows, members, sets, params)
    for done in (shared, close, members, sets):
        unstage(done)
    found = _union(parts)
    found.staged_paths = [path for part in parts for path in part.staged_paths]
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def keep_first(docs: DataFrame, params: NearParams | None = None) -> DataFrame:
    """One row of `docs`, all columns, per group: the one with the smallest id.

    A null id is the last; of equal ids the smaller node stays, of equal rows one.
    Null, blank and empty texts are one group. Texts have any length; an empty table
    gives no rows; other columns, whatever their names, are only passed on.
    """
    params = params or NearParams()
    nodes = nodes_of(docs, params)
    found = links(docs, nodes, params)
    roots = components(found)
    rooted = nodes.join(roots, nodes["number"] == roots["node"], "left").select(
        F.coalesce("root", "number").alias("root"), F.col("first").isNull().alias("last"), "first", nodes["node"]
    )
    kept = staged(
        rooted.groupBy("root").agg(F.min(F.struct("last", "first", "node")).alias("k")).select(
            F.coalesce("k.first", F.lit(0)).alias("_id"), F.col("k.last").alias("_last"), F.col("k.node").alias("_node")
        ),
        "kept",
    )
    for done in (nodes, found, roots):
        unstage(done)

    @F.pandas_udf("binary")
    def marked(text: pd.Series) -> pd.Series:
        return text.map(lambda t: node_of(words_of(t)))

    number = docs["doc_id"].cast("bigint")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    # The rows move as one column, so no name clashes, and once: join and window share their keys.
    rows = small_batches(docs).select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.coalesce(number, F.lit(0)).alias("_id"),
        number.isNull().alias("_last"), marked(text).alias("_node"),
    )
    place = ["_id", "_last", "_node"]
    one = Window.partitionBy(*place).orderBy(F.col("doc.text").asc_nulls_first())
    first = rows.join(kept, place, "left_semi").withColumn("_row", F.row_number().over(one))
    return first.filter("_row = 1").select("doc.*")
