"""Benchmark decontamination: items found in documents despite edited words.

A document holds an item of n words if some part of its text is within
floor(rate * n) word edits of it (words in lower case, without punctuation).

1. Windows: only item-sized windows that share a run of words with the item are
   looked at. By pigeonhole a text within the allowed edits shares such a run, so
   nothing is lost.
2. Embedding: the CGK random walk reads a window word by word; a random bit of the
   current word decides whether to move on. Words output by the walk of two texts
   differ in few places if the texts have a small edit distance.
3. LSH: every table samples a few positions of a walk. A window and an item are
   candidates if they agree on all samples of at least one table; walks and tables
   are repeated until the wanted recall is reached (see the tests).
4. Candidates are verified by their exact edit distance.

Items are read in blocks of bounded size. Each block is sent to the tasks, matched
against every document and released before the next one is read; a worker builds the
index of the block it is at. Documents are never shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import words as shared
from attesta.llm.common import give_back, id_text, ids_of, small_batches, staged, text_of, unstage

WORD = re.compile(r"\w+")
MIXING = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))  # fixed values: shift, factor


@dataclass(frozen=True)
class LeakParams:
    rate: float = 0.2  # allowed word edits per item word
    walks: int = 12
    tables: int = 4  # per walk
    samples: int = 3  # positions per table
    seed: int = 7
    run: int = 3  # longest shared run that is asked for
    block_chars: int = 4_000_000  # item texts sent to the tasks at a time
    batch_words: int = 2_000_000  # document words held at a time


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def allowed(n: int, rate: float) -> int:
    return int(rate * n + 1e-9)


def shared_run(n: int, rate: float, most: int) -> int:
    """Words in a row that survive in any text within the allowed edits."""
    k = allowed(n, rate)
    return min(most, math.ceil((n - k) / (k + 1)))


def edit_distance_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits that turn the item into a part of the text, and that part's end."""
    reach = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for number, word in enumerate(item, 1):
        step = np.empty_like(row)
        step[0] = number
        step[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(step - reach) + reach
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """Index of a block of items: shared runs, and LSH keys of their walks."""

    def __init__(self, rows: list[tuple[int | None, str]], params: LeakParams):
        self.params = p = params
        split = [(item_id, words_of(text)) for item_id, text in rows]
        split = [(item_id, words) for item_id, words in split if words]
        self.ids = [i for i, _ in split]
        self.vocabulary: dict[str, int] = {}
        for _, words in split:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.words = [np.array([self.vocabulary[w] for w in words], np.int64) for _, words in split]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.edits = np.array([allowed(n, p.rate) for n in self.sizes], np.int64)
        self.longest = int(self.sizes.max(initial=0))
        rng = np.random.default_rng(p.seed)
        self.salts = rng.integers(0, 1 << 64, p.walks, np.uint64)
        self.places = rng.random((p.walks, p.tables, p.samples))
        self.mix = rng.integers(1, 1 << 62, (p.walks, p.tables, p.samples + 1), np.int64) | 1
        self._index_runs()
        self._index_walks()

    def _index_runs(self) -> None:
        self.runs: dict[int, tuple[np.ndarray, ...]] = {}
        lengths = [shared_run(int(n), self.params.rate, self.params.run) for n in self.sizes]
        for length in sorted(set(lengths)):
            keys, items, offsets = [], [], []
            for item, words in enumerate(self.words):
                if lengths[item] == length:
                    found = self.run_keys(words, length)
                    keys.append(found)
                    items.append(np.full(len(found), item))
                    offsets.append(np.arange(len(found)))
            keys, items, offsets = map(np.concatenate, (keys, items, offsets))
            order = np.argsort(keys, kind="stable")
            maybe = np.zeros(1 << 20, bool)
            maybe[self._slot(keys)] = True
            self.runs[length] = (keys[order], items[order], offsets[order], maybe)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def run_keys(self, words: np.ndarray, length: int) -> np.ndarray:
        """Number of each run of `length` words; runs of other words are not told apart."""
        base = len(self.vocabulary) + 1
        keys = np.zeros(max(0, len(words) - length + 1), np.int64)
        for i in range(length):
            keys = keys * base + words[i : i + len(keys)]
        return keys

    def walk_bits(self, walk: int, lane: int) -> np.ndarray:
        """64 random bits per word of the vocabulary, for the steps of one lane of a walk."""
        x = np.arange(len(self.vocabulary) + 1, dtype=np.uint64)
        x += np.uint64((int(self.salts[walk]) + lane * 0x9E3779B97F4A7C15) % (1 << 64))
        for shift, factor in MIXING:
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))

    def walk_keys(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """LSH keys (walk * table, window) of the windows of `words`."""
        p = self.params
        out = np.empty((p.walks * p.tables, len(starts)), np.int64)
        last = 2 * int(sizes.max(initial=0))
        ends = starts + sizes
        for walk in range(p.walks):
            at = starts.copy()
            keys = np.empty((p.tables, len(starts)), np.int64)
            for table in range(p.tables):
                keys[table] = sizes * self.mix[walk, table, -1]
            wanted = (self.places[walk][:, :, None] * (2 * sizes)).astype(np.int64)
            for step in range(last):
                if step % 64 == 0:
                    bits = self.walk_bits(walk, step // 64)
                word = np.where(at < ends, words[np.minimum(at, len(words) - 1)], 0)
                for table in range(p.tables):
                    for sample in range(p.samples):
                        hit = np.flatnonzero(wanted[table, sample] == step)
                        keys[table, hit] += (word[hit] + 1) * self.mix[walk, table, sample]
                at += ((bits[word] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
            out[walk * p.tables : (walk + 1) * p.tables] = keys
        return out

    def _index_walks(self) -> None:
        if not len(self.ids):
            self.keys = None
            return
        flat = np.concatenate(self.words)
        starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        keys = self.walk_keys(flat, starts, self.sizes)
        order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, order, axis=1), order

    def windows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (start, size) of item-sized windows that share a run with an item."""
        found = []
        for length, (keys, items, offsets, maybe) in self.runs.items():
            seen = self.run_keys(words, length)
            at = np.flatnonzero(maybe[self._slot(seen)])
            low, high = np.searchsorted(keys, seen[at], "left"), np.searchsorted(keys, seen[at], "right")
            at, low, n = at[high > low], low[high > low], (high - low)[high > low]
            which = np.repeat(low, n) + _within(n)
            start = np.repeat(at, n) - offsets[which]
            found.append(start * (self.longest + 1) + self.sizes[items[which]])
        code = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        size = code % (self.longest + 1)
        return (code - size) // (self.longest + 1), size

    def candidates(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window number, item) pairs that agree in at least one table."""
        pairs = []
        keys = self.walk_keys(words, starts, sizes)
        for table, (known, order) in enumerate(zip(*self.keys)):
            low, high = np.searchsorted(known, keys[table], "left"), np.searchsorted(known, keys[table], "right")
            at = np.flatnonzero(high > low)
            n = (high - low)[at]
            pairs.append(np.repeat(at, n) * len(self.ids) + order[np.repeat(low[at], n) + _within(n)])
        code = np.unique(np.concatenate(pairs))
        window, item = code // len(self.ids), code % len(self.ids)
        same = self.sizes[item] == sizes[window]
        return window[same], item[same]

    @property
    def gap(self) -> int:
        """Words between two texts that no window can bridge."""
        return self.longest + int(self.edits.max(initial=0))

    def find(self, texts: list[list[str]]) -> list[tuple[int, int, int, int]]:
        """(text number, item number, edits, last word) of the items in the texts."""
        if not len(self.ids):
            return []
        gap = self.gap
        get = self.vocabulary.get
        parts, starts, at = [np.zeros(gap, np.int64)], [], gap
        for words in texts:
            starts.append(at)
            parts += [np.array([get(w, 0) for w in words], np.int64), np.zeros(gap, np.int64)]
            at += len(words) + gap
        flat = np.concatenate(parts)
        begin, size = self.windows(flat)
        inside = (begin >= 0) & (begin < len(flat))
        begin, size = begin[inside], size[inside]
        found: dict[tuple[int, int], tuple[int, int]] = {}
        checked: set[tuple[int, int]] = set()
        text_starts = np.array(starts, np.int64)
        for first in range(0, len(begin), 200_000):
            part = slice(first, first + 200_000)
            window, item = self.candidates(flat, begin[part], size[part])
            for start, i in zip(begin[part][window].tolist(), item.tolist()):
                k, n = int(self.edits[i]), int(self.sizes[i])
                cell = start // (k + 1)
                if (cell, i) in checked:
                    continue
                checked.add((cell, i))
                low = max(0, cell * (k + 1) - k)
                edits, end = edit_distance_within(self.words[i], flat[low : (cell + 1) * (k + 1) + n + k])
                if edits > k:
                    continue
                number = max(0, int(np.searchsorted(text_starts, low + max(0, end - 1), "right")) - 1)
                best = (edits, low + end - 1 - starts[number])
                found[number, i] = min(found.get((number, i), best), best)
        return [(t, i, *best) for (t, i), best in sorted(found.items())]


def _within(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each count n, joined."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def item_blocks(items: DataFrame, params: LeakParams) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of bounded text, streamed through the driver by id, null ids first."""
    rows, size = [], 0
    wanted = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text"))
    for row in wanted.filter("text <> ''").distinct().orderBy("item_id", "text").toLocalIterator():
        if rows and size + len(row["text"]) > params.block_chars:
            yield rows
            rows, size = [], 0
        rows.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if rows:
        yield rows


def _index(block, params: LeakParams) -> Items:
    """The index of a broadcast block, built once per worker and replaced by the next block's."""
    state = shared.worker_state("decontam")
    key = hash((tuple(block.value), params))
    if state.get("key") != key:
        state.update(key=key, index=Items(block.value, params))
    return state["index"]


def _search(texts: list[str], index: Items, params: LeakParams) -> Iterator[tuple[int, str | None, int, int]]:
    """(text number, item id, edits, last word), texts taken in groups of bounded size."""
    split: list[list[str]] = []
    first = size = 0
    for number, text in enumerate([*texts, None]):
        words = words_of(text) if text is not None else []
        if split and (text is None or size + len(words) + index.gap > params.batch_words):
            for t, i, edits, last in index.find(split):
                found = index.ids[i]
                yield first + t, None if found is None else str(found), edits, last
            split, first, size = [], number, 0
        split.append(words)
        size += len(words) + index.gap


def find_leaks(docs: DataFrame, items: DataFrame, params: LeakParams | None = None) -> DataFrame:
    """(doc_id, item_id, edits, last_word): every item that a document holds.

    One row per document and item, with the fewest edits and the number of the
    part's last word; equal rows are one. Null texts hold nothing; items without a word
    are in no document; null ids of documents and items stay null; texts and items have
    any length; other columns are not read; an empty table gives no rows.
    """
    params = params or LeakParams()
    rows = small_batches(docs).select(id_text("doc_id").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id bigint, item_id bigint, edits int, last_word int"

    def search(block):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = _index(block, params)
            for batch in batches:
                ids = batch["doc_id"].tolist()
                found = [(ids[t], *rest) for t, *rest in _search(batch["text"].tolist(), index, params)]
                if found:
                    out = pd.DataFrame(found, columns=["doc_id", "item_id", "edits", "last_word"])
                    yield out.assign(doc_id=ids_of(out["doc_id"]), item_id=ids_of(out["item_id"]))

        return run

    every = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items, params):
        # Plain values: workers need not have the package to read them.
        sent = docs.sparkSession.sparkContext.broadcast(block)
        every = every.union(staged(rows.mapInPandas(search(sent), schema).distinct(), "leaks"))
        sent.destroy()
    return every


def drop_leaks(docs: DataFrame, items: DataFrame, params: LeakParams | None = None) -> DataFrame:
    """The rows of `docs`, all columns, that hold no item.

    Null and empty texts hold nothing and stay; repeated rows keep a row each; a null
    item id is an item like any other; texts have any length; columns that the caller
    adds are passed on, whatever their names; without items all rows stay.
    """
    params = params or LeakParams()

    def search(block):
        @F.pandas_udf("boolean")
        def clean(text: pd.Series) -> pd.Series:
            keep = np.ones(len(text), bool)
            for number, *_ in _search(text.tolist(), _index(block, params), params):
                keep[number] = False
            give_back()
            return pd.Series(keep)

        return clean

    rest, blocks = docs, item_blocks(items, params)
    block = next(blocks, None)
    while block is not None:
        following = next(blocks, None)
        sent = docs.sparkSession.sparkContext.broadcast(block)
        kept = small_batches(rest).filter(search(sent)(text_of()))
        if following is not None:  # the last block's rows are read by the caller
            kept = staged(kept, "clean")
            sent.destroy()
            if rest is not docs:
                unstage(rest)
        rest, block = kept, following
    return rest
