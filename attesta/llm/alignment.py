"""Alignment of two tokenizers' tokens over the same bytes.

1. Every text is encoded by tokenizer A (byte-level BPE) and B (pieces with byte
   fallback), through tables of already encoded words. The byte offsets at which tokens end are two ascending lists.
2. Galloping intersection: each end of the shorter list is searched in the longer
   one by doubling steps from a place known to lie before it, then by bisection in
   the bracket. Offsets in both lists cut the tokens into groups; the difference of
   the ranks of two neighbouring ends is the range of tokens that one token overlaps.
   All documents of a batch are searched together, since offsets run on from one
   document to the next.
3. A batch is stored as one row: its documents, its distinct id pairs with the number
   of documents that hold them, and per document the places of its pairs in that list.
4. Pair counts are summed over all batches; the highest count per A id is a table of
   at most A's vocabulary. Counts return to the batches by a join on the pair, and
   every batch adds them up for its documents.

A frequent pair occurs once per batch in the shuffles, whatever the number of its
documents, and texts are not shuffled.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import words
from attesta.llm.bpe import pieces
from attesta.llm.common import id_text, ids_of, lean, small_batches, staged, text_of


@dataclass(frozen=True)
class AlignParams:
    byte_level: str | None = None  # tokenizer file A; by default the public byte-level BPE
    piece_model: str | None = None  # model file B; by default the public piece model
    cached_chars: int = 16_000_000  # bound of a worker's tables of encoded words
    anchors: tuple[int, ...] = (1024, 64, 8)  # strides of the ends that are searched first
    batch_mb: int = 2  # texts of a batch


class WordIds:
    """Ids of the words met so far, as one flat array, and whether they spell the word."""

    def __init__(self, space: str, table: list[bytes]):
        self.space, self.table = space, table  # what the tokenizer puts before a word; bytes of the ids
        self.place: dict[str, int] = {}
        self.chars = 0
        self.ids, self.ends, self.spelled = array("i"), array("q", [0]), bytearray()

    def unknown(self, split: list[list[str]]) -> list[str]:
        return [w for w in set().union(*split) if w not in self.place]

    def learn(self, new: list[str], coded: list[list[int]]) -> None:
        first = self.ends[-1]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.chars += sum(map(len, new))
        self.ids.extend(chain.from_iterable(coded))
        self.ends.extend(accumulate(map(len, coded), initial=first))
        self.ends.pop(len(self.ends) - len(new) - 1)  # the initial value is there already
        self.spelled.extend(
            b"".join(map(self.table.__getitem__, ids)) == (self.space + word).encode("utf-8", "replace")
            for word, ids in zip(new, coded)
        )

    def look_up(self, split: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids per text, and whether all its words are spelled."""
        n = np.array([len(part) for part in split], np.int64)
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
        ends = np.array(self.ends, np.int64)
        size = (ends[1:] - ends[:-1])[at]
        stop = np.cumsum(size)
        flat = np.array(self.ids, np.int64)[np.arange(size.sum()) + np.repeat(ends[at] - (stop - size), size)]
        wrong = np.concatenate([[0], np.cumsum(np.frombuffer(bytes(self.spelled), np.uint8)[at] == 0)])
        last = np.cumsum(n)
        cuts = np.concatenate([[0], stop])[last]
        return np.split(flat, cuts[:-1]), wrong[last] == wrong[last - n]


class Encoders:
    """Both tokenizers with the bytes of their ids; every word is encoded once per table.

    A never joins letters across a cut of `words.spaced`. B has no piece with a space
    after its first character, but for runs of spaces, so it cuts before every single
    space; its first space is its own.
    """

    def __init__(self, params: AlignParams):
        import public_tokenizers
        import sentencepiece

        self.a = words.load_tokenizer(params.byte_level or public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(
            model_file=params.piece_model or public_tokenizers.path("piece_bpe_32k.model")
        )
        self.a_bytes = pieces(self.a)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        numbers = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        # Rows: an id followed by a comma, by the mark after A's ids, by the mark after a group.
        self.written = np.array([[f"{n}{mark}".encode() for n in numbers] for mark in ",|;"])
        self.limit = params.cached_chars
        self._forget()

    def _forget(self) -> None:
        self.a_words, self.b_words = WordIds("", self.a_bytes), WordIds(" ", self.b_bytes)

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    @staticmethod
    def _cut_a(text: str) -> list[str]:
        if not text or text[0].isspace():
            return words.BEFORE_SPACE.split(" " + text)
        first, *rest = words.spaced(text)
        return [" " + first, *rest]

    @staticmethod
    def _cut_b(text: str) -> list[str]:
        parts = text.split(" ")
        if "" in parts:
            first, *rest = words.BEFORE_SPACE.split(text)
            parts = [first, *(part[1:] for part in rest)]
        return parts

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B per text; none if the tokens do not spell the text."""
        split_a, split_b = [self._cut_a(t) for t in texts], [self._cut_b(t) for t in texts]
        if self.a_words.chars + self.b_words.chars > self.limit:
            self._forget()
        new = self.a_words.unknown(split_a)
        self.a_words.learn(new, [found.ids for found in self.a.encode_batch_fast(new, add_special_tokens=False)])
        new = self.b_words.unknown(split_b)
        self.b_words.learn(new, self.b.encode(new, num_threads=1))
        (a, a_same), (b, b_same) = self.a_words.look_up(split_a), self.b_words.look_up(split_b)
        none = np.zeros(0, np.int64)
        same = a_same & b_same & np.array([t != "" for t in texts])
        return [(x, y) if ok else (none, none) for x, y, ok in zip(a, b, same.tolist())]


def gallop(ends: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each wanted offset the first place in `ends` that is not below it.

    `start` is a place at or before the result; no wanted offset is above the last end.
    """
    low, high = start.copy(), np.zeros_like(start)
    looking, step, last = np.arange(len(wanted)), 1, len(ends) - 1
    while len(looking):
        at = np.minimum(low[looking] + step - 1, last)
        below = ends[at] < wanted[looking]
        high[looking[~below]] = at[~below]
        looking = looking[below]
        low[looking] = at[below] + 1
        step *= 2
    looking = np.flatnonzero(low < high)
    while len(looking):
        middle = (low[looking] + high[looking]) >> 1
        below = ends[middle] < wanted[looking]
        low[looking[below]] = middle[below] + 1
        high[looking[~below]] = middle[~below]
        looking = looking[low[looking] < high[looking]]
    return low


@dataclass
class Aligned:
    """Tokens of a batch: `short` is the shorter list of each document, `long` the other."""

    short_doc: np.ndarray  # document of each short token
    shared: np.ndarray  # short tokens that end a group
    long_shared: np.ndarray
    link_short: np.ndarray  # token places of every overlap
    link_long: np.ndarray


def intersect(
    short: np.ndarray, long: np.ndarray, n_short: np.ndarray, n_long: np.ndarray, anchors: tuple[int, ...]
) -> Aligned:
    """Shared ends and overlaps of token sizes `short` and `long`, document by document.

    Every `anchors[0]`-th end is searched from its document's start, the ends of the
    next stride from the one found before them, and so on down to every end.
    """
    ends, wanted = np.cumsum(long), np.cumsum(short)
    doc = np.repeat(np.arange(len(n_short)), n_short)
    place = (np.cumsum(n_long) - n_long)[doc]
    for stride, above in zip((*anchors, 1), (0, *anchors)):
        at = np.arange(0, len(wanted), stride)
        if above:
            at = at[at % above != 0]
            place[at] = np.maximum(place[at], place[at - at % above])
        place[at] = gallop(ends, wanted[at], place[at])
    shared = ends[place] == wanted if len(wanted) else np.zeros(0, bool)
    long_shared = np.zeros(len(ends), bool)
    long_shared[place[shared]] = True
    after = place + shared  # ends at or below this one
    first = np.concatenate([[0], after[:-1]]) if len(after) else after
    n = place - first + 1
    link_short = np.repeat(np.arange(len(wanted)), n)
    link_long = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return Aligned(doc, shared, long_shared, link_short, link_long)


def _written(found: Aligned, ids: list[np.ndarray], swapped: np.ndarray, long_doc: np.ndarray, e: Encoders) -> np.ndarray:
    """Ids with their marks: in every group A's tokens, then B's."""
    short_end, long_end = np.flatnonzero(found.shared) + 1, np.flatnonzero(found.long_shared) + 1
    out = np.empty(sum(map(len, ids)), e.written.dtype)
    sides = (
        (found.shared, ids[0], swapped[found.short_doc], long_end),  # swapped: the short tokens are B's
        (found.long_shared, ids[1], ~swapped[long_doc], short_end),
    )
    for ends_group, tokens, is_b, other_end in sides:
        group = np.cumsum(ends_group) - ends_group
        before = np.concatenate([[0], other_end])  # the other list's tokens in earlier groups
        place = np.arange(len(tokens)) + np.where(is_b, before[group + 1], before[group])
        out[place] = e.written[np.where(ends_group, np.where(is_b, 2, 1), 0), tokens]
    return out


BLOCK_SCHEMA = (
    "doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, groups array<string>, pairs array<bigint>, pair_docs array<int>, links binary"
)


def align(texts: list[str], encoders: Encoders, anchors: tuple[int, ...], keep_groups: bool) -> dict:
    """One block: counts and groups per document, distinct pairs, places of each document's pairs."""
    coded = encoders.encode(texts)
    n_a = np.array([len(a) for a, _ in coded], np.int64)
    n_b = np.array([len(b) for _, b in coded], np.int64)
    swapped = n_a > n_b
    none = np.zeros(0, np.int64)
    short = np.concatenate([none, *[b if s else a for (a, b), s in zip(coded, swapped)]])
    long = np.concatenate([none, *[a if s else b for (a, b), s in zip(coded, swapped)]])
    n_short, n_long = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    flip = np.repeat(swapped, n_short)
    long_doc = np.repeat(np.arange(len(texts)), n_long)
    short_size = np.where(flip, encoders.b_size[np.where(flip, short, 0)], encoders.a_size[np.where(flip, 0, short)])
    flipped = swapped[long_doc]
    long_size = np.where(
        flipped, encoders.a_size[np.where(flipped, long, 0)], encoders.b_size[np.where(flipped, 0, long)]
    )
    found = intersect(short_size, long_size, n_short, n_long, anchors)

    written = _written(found, [short, long], swapped, long_doc, encoders)
    bounds = np.concatenate([[0], np.cumsum(n_a + n_b)])
    groups = [
        written[a:b].tobytes().replace(b"\0", b"")[:-1] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
    ]

    link_doc = found.short_doc[found.link_short]
    s, t, crossed = short[found.link_short], long[found.link_long], swapped[link_doc]
    keys = (np.where(crossed, t, s) << 32) | np.where(crossed, s, t)
    pairs, place = np.unique(keys, return_inverse=True)
    held, times = np.unique(link_doc * max(1, len(pairs)) + place, return_counts=True)
    held_doc, held_pair = np.divmod(held, max(1, len(pairs)))
    per_doc = np.bincount(held_doc, minlength=len(texts))
    links = np.concatenate([per_doc, held_pair, times]).astype("<u4").tobytes()
    return {
        "n_a": n_a, "n_b": n_b,
        "n_groups": np.bincount(found.short_doc[found.shared], minlength=len(texts)),
        "n_links": np.bincount(link_doc, minlength=len(texts)),
        "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in groups],
        "groups": [g.decode() for g in groups] if keep_groups else [],
        "pairs": pairs, "pair_docs": np.bincount(held_pair, minlength=len(pairs)).astype(np.int32),
        "links": zstandard.compress(links, 3),
    }


def aligned_blocks(docs: DataFrame, params: AlignParams, keep_groups: bool) -> DataFrame:
    """One row per batch of documents, staged, with a number that is fixed from then on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = words.worker_state("alignment")
        if state.get("params") != params:
            state.update(params=params, encoders=Encoders(params))
        encoders = state["encoders"]
        for batch in lean(batches):
            if len(batch):
                block = align(batch["text"].tolist(), encoders, params.anchors, keep_groups)
                row = {"doc_ids": list(ids_of(batch["doc_id"])), **block}
                yield pd.DataFrame({name: [value] for name, value in row.items()})

    rows = small_batches(docs, params.batch_mb).select(id_text("doc_id").alias("doc_id"), text_of().alias("text"))
    blocks = rows.mapInPandas(run, BLOCK_SCHEMA)
    return staged(blocks.withColumn("block", F.monotonically_increasing_id()), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): documents per id pair, and whether no pair of its A id has more."""
    each = blocks.select(F.inline(F.arrays_zip("pairs", "pair_docs"))).groupBy(F.col("pairs").alias("pair"))
    counts = staged(each.agg(F.sum("pair_docs").alias("n")), "pairs")
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))  # at most A's vocabulary
    return counts.join(F.broadcast(highest), a == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("best")
    )


def align_documents(docs: DataFrame, params: AlignParams | None = None, keep_groups: bool = False) -> DataFrame:
    """Token groups and links of every document, one row each.

    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and with
    `keep_groups` the groups themselves. A text that is null or empty, or that the
    tokens of A or B do not spell, has no tokens: zeros and an empty digest. Of pairs
    with equal counts all are the best of their A id. Repeated rows are documents of
    their own; ids may be null; texts have any length; other columns are not read; an
    empty table gives no rows.
    """
    params = params or AlignParams()
    blocks = aligned_blocks(docs, params, keep_groups)
    returned = (
        blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair"))
        .join(pair_counts(blocks), "pair").select("of_block", "place", "n", "best")
    )
    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "n_best bigint, count_sum bigint, groups_sha256 string"
    )
    schema += ", groups string" if keep_groups else ""
    plain = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * keep_groups
    names = [part.split()[0] for part in schema.split(", ")]

    def run(block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        raw = np.frombuffer(zstandard.decompress(row["links"]), "<u4").astype(np.int64)
        n_docs = len(row["n_a"])
        per_doc, held = raw[:n_docs], raw[n_docs:]
        pair, times = held[: len(held) // 2], held[len(held) // 2 :]
        n, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        n[counts["place"]], best[counts["place"]] = counts["n"], counts["best"]
        ends = np.cumsum(per_doc)
        sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * best[pair], times * n[pair])]
        out = {name: list(row[name]) for name in plain}
        out["doc_id"] = pd.array([None if pd.isna(i) else int(i) for i in row["doc_ids"]], "Int64")
        out["n_best"], out["count_sum"] = [s[ends] - s[ends - per_doc] for s in sums]
        return pd.DataFrame(out)[names]

    kept = blocks.select("block", F.col("doc_ids").cast("array<string>").alias("doc_ids"), *plain, "links")
    return kept.groupBy("block").cogroup(returned.groupBy("of_block")).applyInPandas(run, schema)
