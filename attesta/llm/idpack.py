"""Token ids in a fixed-width binary format, written and read with Spark.

The format is a table of blocks, one row each, in files written by Spark (so a
lost executor or a repeated task leaves no partial data):

    part, block   place: blocks of a part follow each other, parts are ascending
    start         ids before the block within its part
    doc_ids       documents of the block, ascending
    offsets       first id of each document in the block, and the block's length
    width         bits per id: the fewest that hold the largest id
    payload       the ids, `width` bits each, most significant bit first

A block holds whole documents up to about `block_ids` ids. Id i of a block is
bits i*width to (i+1)*width of the payload, so any id or document is read without
the ones before it; a block is unpacked with numpy operations.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import words
from attesta.llm.common import id_text, ids_of, small_batches, staged, text_of


@dataclass(frozen=True)
class PackParams:
    tokenizer: str | None = None  # file; by default the public word BPE
    end_id: int = 1
    block_ids: int = 1 << 16
    cached_words: int = 1_000_000  # bound of a worker's table of encoded words
    batch_chars: int = 4_000_000  # characters split at a time


BLOCK_SCHEMA = (
    "part int, block int, start bigint, n_ids bigint, doc_ids array<bigint>, "
    "offsets array<int>, width int, payload binary"
)


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f">u{width // 8}").tobytes()
    bits = (ids[:, None].astype(np.int64) >> np.arange(width - 1, -1, -1)) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def unpack(payload: bytes, width: int, first: int, last: int) -> np.ndarray:
    """Ids first..last-1 of a payload; reads only the bytes that hold them."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(payload, f">u{size}", last - first, first * size).astype(np.uint32)
    start, stop = first * width, last * width
    piece = np.frombuffer(payload, np.uint8, (stop + 7) // 8 - start // 8, start // 8)
    bits = np.unpackbits(piece)[start % 8 :][: stop - start].reshape(-1, width)
    return (bits.astype(np.int64) << np.arange(width - 1, -1, -1)).sum(axis=1).astype(np.uint32)


PLAIN = re.compile("[a-zàâäéèêëíîïóôöúûüçñß]+", re.I | re.A)


def drops_spaces(tokenizer) -> bool:
    """Whether words can be encoded apart: the settings of the public word BPE.

    Lower-casing and white space are settled by the normaliser, words are cut by one
    pattern with the matches kept and bytes as characters, and a word ends in a mark.
    """
    about = json.loads(tokenizer.to_str())
    steps = [step["type"] for step in (about["normalizer"] or {}).get("normalizers", [])]
    cuts = [step["type"] for step in (about["pre_tokenizer"] or {}).get("pretokenizers", [])]
    return steps == ["NFC", "Replace", "Lowercase"] and cuts == ["Split", "ByteLevel"] and bool(
        about["model"].get("end_of_word_suffix")
    )


class _Encoder:
    """Encodes whole texts through a bounded table of already encoded words.

    A word of plain letters is one unit for the tokenizer, so it goes straight to
    the tokenizer's BPE model in lower case; other words take the whole tokenizer.
    That holds for tokenizers that lower-case and drop white space; any other
    tokenizer gets whole texts.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        state = words.worker_state("idpack")
        if state.get("path") != path:
            tokenizer = words.load_tokenizer(path)
            state.update(path=path, tokenizer=tokenizer, model=Tokenizer(tokenizer.model), known={"": b""})
            state["by_word"] = drops_spaces(tokenizer)
        self.tokenizer, self.model, self.known = state["tokenizer"], state["model"], state["known"]
        self.limit = limit
        coded = words.byte_characters()
        self.bytes = {c: "".join(coded[b] for b in chr(c).encode()) for c in range(128, 256)}
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_word = state["by_word"]

    def learn(self, unknown: set[str]) -> None:
        known, tails = self.known, []
        bare = set()
        for word in unknown:
            if len(word) > 1 and word[-1] in ".," and word[-2] in words.LETTERS:
                tails.append(word)
                bare.add(word[:-1])
            else:
                bare.add(word)
        bare.update(".,")
        new = [w for w in bare if w not in known]
        plain = [w for w in new if PLAIN.fullmatch(w)]
        other = [w for w in new if not PLAIN.fullmatch(w)]
        lower = [w.lower() for w in plain]
        lower = [w if w.isascii() else w.translate(self.bytes) for w in lower]
        for source, own, shown in ((self.model, plain, lower), (self.tokenizer, other, other)):
            for word, found in zip(own, source.encode_batch_fast(shown, add_special_tokens=False)):
                known[word] = array("I", found.ids).tobytes()
        for word in tails:
            known[word] = known[word[:-1]] + known[word[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if not self.by_word:
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(found.ids, "<u4").tobytes() for found in coded]
        split = [words.unspaced(t) for t in texts]
        if len(self.known) > self.limit:
            self.known.clear()
            self.known[""] = b""
        known = self.known
        self.learn({w for w in set().union(*split) if w not in known})
        get = known.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]


def _grouped(texts: list[str], most: int) -> Iterator[slice]:
    """Slices of consecutive texts of at most about `most` characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def pack_documents(docs: DataFrame, params: PackParams | None = None) -> DataFrame:
    """Encode every document and write its ids; the returned frame reads the files.

    Documents are ordered by id (null first), equal ids by text. A null text
    counts as empty; every document gets the end id; repeated rows are documents of
    their own; texts have any length; other columns are not read; an empty table
    gives no blocks.
    """
    params = params or PackParams()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        encoder = _Encoder(
            params.tokenizer or public_tokenizers.path("word_bpe_49k.json"), params.cached_words
        )
        width = max(encoder.vocabulary - 1, params.end_id, 1).bit_length()
        part, end = TaskContext.get().partitionId(), np.array([params.end_id], "<u4").tobytes()
        block, start, doc_ids, pending, size = 0, 0, [], [], 0

        def flush() -> pd.DataFrame:
            nonlocal block, start, doc_ids, pending, size
            ids = np.frombuffer(b"".join(pending), "<u4")
            offsets = [0, *accumulate(len(p) // 4 for p in pending)]
            row = (part, block, start, len(ids), doc_ids, offsets, width, pack(ids, width))
            block, start, doc_ids, pending, size = block + 1, start + len(ids), [], [], 0
            return pd.DataFrame([row], columns=names)

        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for piece in _grouped(texts, params.batch_chars):
                for doc_id, found in zip(ids[piece], encoder.encode(texts[piece])):
                    if size and size + len(found) // 4 + 1 > params.block_ids:
                        yield flush()
                    doc_ids.append(None if doc_id is None else int(doc_id))
                    pending.append(found + end)
                    size += len(found) // 4 + 1
        if doc_ids:
            yield flush()

    names = [part.split()[0] for part in BLOCK_SCHEMA.split(", ")]
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    named = ordered.select(id_text("doc_id").alias("doc_id"), "text")
    return staged(named.mapInPandas(run, BLOCK_SCHEMA), "token-ids")


def part_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each part; as many entries as the writing job had tasks."""
    sizes = dict(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    order = sorted(sizes)
    return dict(zip(order, accumulate((sizes[p] for p in order), initial=0)))


def read_documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    One row per packed document, repeated and null ids included; `start` counts the
    ids of all documents before it. No blocks give no rows.
    """
    starts = part_starts(blocks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = unpack(row.payload, row.width, 0, row.n_ids).astype("<u4")
                offsets = np.asarray(row.offsets, np.int64)
                view = memoryview(ids.tobytes())
                yield pd.DataFrame({
                    "doc_id": ids_of(pd.Series(row.doc_ids, dtype=object)),
                    "start": starts[row.part] + row.start + offsets[:-1],
                    "n_tokens": np.diff(offsets),
                    "ids_crc32": [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])],
                })

    named = blocks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>"))
    return named.mapInPandas(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(blocks: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """(doc_id, ids) of the wanted documents: only their bits are unpacked."""
    wanted = doc_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    places = blocks.select(
        "width", "payload", F.posexplode("doc_ids").alias("at", "doc_id"), "offsets"
    ).select(
        "doc_id", "width", "payload",
        F.get("offsets", F.col("at")).alias("first"), F.get("offsets", F.col("at") + 1).alias("last"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [
                unpack(r.payload, r.width, r.first, r.last).tolist()
                for r in batch.itertuples(index=False)
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids})

    return places.join(wanted, "doc_id", "left_semi").mapInPandas(run, "doc_id bigint, ids array<bigint>")
