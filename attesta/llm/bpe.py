"""BPE encoding and decoding through a table of distinct words.

1. Split: documents are taken in blocks of consecutive documents, keyed by a hash of
   their content. A block's words become numbers by position; its distinct words leave
   as one list per word bucket (a hash of the word). The two are made apart, since
   storing the split texts in between would take more disk than reading them again.
2. Word table: the lists of a bucket meet in one partition, bucket after bucket,
   where every distinct word is encoded once; each list goes back as ids in the
   order of its words.
3. Decode: the distinct ids of every block are joined with the table of pieces
   (id, bytes), which has the vocabulary's size.
4. Join by position: a block's word numbers, the ids of its words and the pieces of
   its ids meet by block; ids and decoded bytes of a document follow by position.

Only word numbers and distinct words of blocks are shuffled. A frequent word occurs
once per block, so no word is a hot key; the number of buckets follows the shuffle
partitions, so a bucket's table fits into a task.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import words
from attesta.llm.common import give_back, id_text, ids_of, lean, small_batches, staged, text_of


@dataclass(frozen=True)
class BpeParams:
    tokenizer: str | None = None  # file; by default the public byte-level BPE
    block_chars: int = 16_000_000  # texts of a block
    buckets: int = 64  # least number of word buckets


def tokenizer_path(params: BpeParams) -> str:
    import public_tokenizers

    return params.tokenizer or public_tokenizers.path("byte_bpe_50k.json")


def _text_list(values: list[str]) -> bytes:
    """Length-prefixed UTF-8 texts, compressed."""
    coded = [v.encode("utf-8", "replace") for v in values]
    sizes = np.array([len(coded), *map(len, coded)], "<u4").tobytes()
    return zstandard.compress(sizes + b"".join(coded), 3)


def _from_text_list(payload: bytes) -> list[str]:
    raw = zstandard.decompress(payload)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)
    starts = np.concatenate([[4 + 4 * n], ends[:-1]]) if n else ends
    return [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]


def _numbers(values: np.ndarray) -> bytes:
    """Numbers below 2^32 compressed byte plane by byte plane, as small ones are frequent."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _from_numbers(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(payload), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _blocks(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[tuple[int, list, list[str]]]:
    """(block key, ids, texts): consecutive documents up to `limit` characters.

    The key is a hash of the content, so any repetition of the work that forms the same
    block gives the same key; equal blocks are told apart by nothing and need not be.
    """
    ids: list = []
    texts: list[str] = []
    size = 0

    def block() -> tuple[int, list, list[str]]:
        digest = hashlib.blake2b(repr(ids).encode(), digest_size=8)
        for text in texts:
            digest.update(f"{len(text)}:".encode() + text.encode("utf-8", "replace"))
        return int.from_bytes(digest.digest(), "little", signed=True), ids, texts

    for batch in batches:
        for doc_id, text in zip(ids_of(batch["doc_id"]), batch["text"].tolist()):
            if size and size + len(text) > limit:
                yield block()
                ids, texts, size = [], [], 0
            ids.append(None if doc_id is pd.NA else int(doc_id))
            texts.append(text)
            size += len(text)
    if ids:
        yield block()


def _bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % buckets


def block_places(docs: DataFrame, buckets: int, params: BpeParams) -> DataFrame:
    """One row per block: the words of its documents as numbers, by position.

    `n_words` counts the words of each document; `places` holds the numbers of all
    words, in order of first appearance; `of_bucket` the bucket of each number.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, ids, texts in _blocks(lean(batches), params.block_chars):
            number: dict[str, int] = {}
            places, n_words = array("I"), []
            for text in texts:
                split = words.spaced(text) if text else []
                for word in split:
                    if word not in number:
                        number[word] = len(number)
                places.extend(map(number.__getitem__, split))
                n_words.append(len(split))
            of_bucket = np.array([_bucket(w, buckets) for w in number], np.int64)
            row = {
                "block": key, "doc_ids": ids, "n_words": n_words, "places": _numbers(np.array(places, np.int64)),
                "of_bucket": _numbers(of_bucket),
            }
            yield pd.DataFrame({name: [value] for name, value in row.items()})

    return docs.mapInPandas(
        run, "block bigint, doc_ids array<bigint>, n_words array<int>, places binary, of_bucket binary"
    )


def block_words(docs: DataFrame, buckets: int, params: BpeParams) -> DataFrame:
    """(block, bucket, words): the distinct words of a block by bucket, in order of first appearance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, _, texts in _blocks(lean(batches), params.block_chars):
            seen: dict[str, None] = {}
            for text in texts:
                seen.update(dict.fromkeys(words.spaced(text) if text else ()))
            lists: dict[int, list[str]] = {}
            for word in seen:
                lists.setdefault(_bucket(word, buckets), []).append(word)
            yield pd.DataFrame({
                "block": key, "bucket": list(lists), "words": [_text_list(part) for part in lists.values()],
            })

    return docs.mapInPandas(run, "block bigint, bucket int, words binary")


def encode_words(lists: DataFrame, params: BpeParams) -> DataFrame:
    """(block, bucket, ids, used) of lists sorted by bucket: each distinct word is encoded once.

    `ids` holds the number of ids of each word, then all ids; `used` the distinct ids.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = words.worker_tokenizer(tokenizer_path(params))
        bucket, known = None, {}
        for batch in lean(batches):
            coded, used = [], []
            for number, payload in zip(batch["bucket"].tolist(), batch["words"]):
                if number != bucket:
                    bucket, known = number, {}
                wanted = _from_text_list(payload)
                new = [w for w in wanted if w not in known]
                for word, found in zip(new, tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                    known[word] = array("I", found.ids)
                ids = [known[w] for w in wanted]
                sizes, flat = np.array([len(i) for i in ids]), np.array(array("I", chain.from_iterable(ids)))
                coded.append(_numbers(np.concatenate([sizes, flat])))
                used.append(np.unique(flat).astype(np.int32))
            yield pd.DataFrame({"block": batch["block"], "bucket": batch["bucket"], "ids": coded, "used": used})

    return lists.mapInPandas(run, "block bigint, bucket int, ids binary, used array<int>")


def pieces(tokenizer) -> list[bytes]:
    """Bytes of each id: the piece's characters stand for bytes, or for themselves."""
    byte = {c: b for b, c in enumerate(words.byte_characters())}
    table = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for piece, number in tokenizer.get_vocab(with_added_tokens=True).items():
        mapped = [byte.get(c) for c in piece]
        table[number] = piece.encode() if None in mapped else bytes(mapped)
    return table


def piece_table(spark, params: BpeParams) -> DataFrame:
    """(id, piece): as many rows as the vocabulary."""
    table = pieces(words.load_tokenizer(tokenizer_path(params)))
    return spark.createDataFrame(pd.DataFrame({"id": range(len(table)), "piece": table}), "id int, piece binary")


def block_pieces(found: DataFrame, table: DataFrame) -> DataFrame:
    """(block, piece_ids, pieces): the pieces of the distinct ids of every block."""
    used = found.select("block", F.explode("used").alias("id")).distinct()
    joined = used.join(F.broadcast(table), "id")  # the vocabulary bounds the table
    each = F.array_sort(F.collect_list(F.struct("id", "piece")))
    return joined.groupBy("block").agg(each.alias("all")).select(
        "block", F.col("all.id").alias("piece_ids"), F.col("all.piece").alias("pieces")
    )


def _by_position(block: pd.Series, found: pd.DataFrame) -> Iterator[tuple]:
    """(doc_id, ids, decoded bytes) of a block's documents."""
    lists = found[found["bucket"].notna()].drop_duplicates("bucket").sort_values("bucket")
    of_bucket, n_words = _from_numbers(block["of_bucket"]), np.asarray(block["n_words"], np.int64)
    sizes, flat = [], []
    counts = np.bincount(of_bucket)[lists["bucket"].astype(np.int64)] if len(lists) else []
    for payload, n in zip(lists["ids"], counts):
        raw = _from_numbers(payload)
        sizes.append(raw[:n])
        flat.append(raw[n:])
    none = np.zeros(0, np.int64)
    sizes, flat = np.concatenate([none, *sizes]), np.concatenate([none, *flat])
    ends = np.cumsum(sizes)
    # Lists hold the words of a bucket in the order of their numbers.
    order = np.argsort(of_bucket, kind="stable")
    start, size = np.empty_like(order), np.empty_like(order)
    start[order], size[order] = ends - sizes, sizes
    joined = found[found["bucket"].isna()]
    names, table = (joined["piece_ids"].iloc[0], joined["pieces"].iloc[0]) if len(joined) else (none, [])
    spelled = [table[i] for i in np.searchsorted(names, flat).tolist()]
    decoded = [b"".join(spelled[a : a + n]) for a, n in zip(start.tolist(), size.tolist())]
    places, first = _from_numbers(block["places"]), 0
    for doc_id, n in zip(block["doc_ids"], n_words.tolist()):
        at = places[first : first + n]
        first += n
        count = size[at]
        ids = flat[np.arange(count.sum()) + np.repeat(start[at] - (np.cumsum(count) - count), count)]
        yield doc_id, ids.astype("<u4"), b"".join(map(decoded.__getitem__, at.tolist()))


def encode_documents(docs: DataFrame, params: BpeParams | None = None, keep_ids: bool = False) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests.

    Columns doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit numbers),
    decoded_sha256 (UTF-8); with `keep_ids` also ids and decoded. A null text
    counts as empty; texts have any length; repeated rows keep a row each; ids may be
    null; other columns are not read; an empty table gives no rows.
    """
    params = params or BpeParams()
    spark = docs.sparkSession
    buckets = max(params.buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = small_batches(docs).select(id_text("doc_id").alias("doc_id"), text_of().alias("text"))
    blocks, lists = block_places(rows, buckets, params), block_words(rows, buckets, params)
    found = staged(encode_words(lists.repartition("bucket").sortWithinPartitions("bucket"), params), "bpe-ids")
    met = found.drop("used").withColumnRenamed("block", "of_block").unionByName(
        block_pieces(found, piece_table(spark, params)).withColumnRenamed("block", "of_block"),
        allowMissingColumns=True,
    )
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep_ids else ""
    names = [part.split()[0] for part in schema.split(", ")]

    def join(block: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        out = []
        # Equal blocks of different tasks have one key and meet here together.
        documents = chain.from_iterable(_by_position(row, parts) for _, row in block.iterrows())
        for doc_id, ids, raw in documents:
            decoded = raw.decode("utf-8", "replace")
            row = (
                None if pd.isna(doc_id) else str(int(doc_id)), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
            out.append(row + ((ids.astype(np.int32).tolist(), decoded) if keep_ids else ()))
        result = pd.DataFrame(out, columns=names)
        result["doc_id"] = ids_of(result["doc_id"])
        give_back()
        return result

    kept = blocks.select("block", F.col("doc_ids").cast("array<string>").alias("doc_ids"), "n_words", "places", "of_bucket")
    return kept.groupBy("block").cogroup(met.groupBy("of_block")).applyInPandas(join, schema)
