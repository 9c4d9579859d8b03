"""Runs of repeated words in texts, by longest common extensions over a difference cover.

A run is a longest stretch of consecutive words with smallest period q (words q apart
are identical) of at least `min_repeats` periods and `min_words` words.

All texts of an Arrow batch are one sequence of word numbers with a separator of its
own after every text, so no equality reaches across texts and every step below works
on all texts at once.

1. Harmonic grid: for every period q only the words 0, q, 2q, ... are compared with
   the next on the grid. A run of four periods meets four grid words in a row, all
   equal; two further words inside it are compared before anything is extended.
2. Difference cover: of every 31 neighbouring positions six are sampled, such that any
   two positions reach samples together within 31 words. Only the sampled suffixes are
   sorted: by their first 31 words, then by doubling over ranks of later samples.
3. Longest common extension of two positions: the few words up to the next pair of
   samples are compared directly, the rest is a range minimum over the common prefixes
   of neighbouring sampled suffixes, read from a sparse table.
4. Extension: the end of a run follows from one extension at its first grid word, its
   start from a bisection over extensions of the q words before it.

A text's work is n log n; texts are not shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import id_text, ids_of, small_batches, text_of

# A perfect difference set, every distance modulo 31 occurs once.
COVER_PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)


@dataclass(frozen=True)
class RunParams:
    min_words: int = 6
    min_repeats: int = 4  # at least 4: the grid needs four equal words in a row
    batch_mb: int = 4  # texts of a batch
    chunk: int = 1 << 20  # grid points extended at a time

    def __post_init__(self):
        if self.min_repeats < 4:
            raise ValueError("min_repeats must be at least 4")


def shifts() -> np.ndarray:
    """Steps after which two residues are in the cover together."""
    inside = np.zeros(2 * COVER_PERIOD, bool)
    inside[list(COVER)] = inside[[c + COVER_PERIOD for c in COVER]] = True
    table = np.full((COVER_PERIOD, COVER_PERIOD), -1)
    for step in range(COVER_PERIOD - 1, -1, -1):
        shifted = inside[step : step + COVER_PERIOD]
        table[np.outer(shifted, shifted)] = step
    return table


def refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order the tied entries of equal rank by `key` in place; the entries still tied.

    A rank is the number of entries that are certainly smaller.
    """
    order = np.lexsort((key, rank[tied]))
    members, key = tied[order], key[order]
    old = rank[members]
    group = np.concatenate([[True], old[1:] != old[:-1]])
    part = group | np.concatenate([[True], key[1:] != key[:-1]])
    place = np.arange(len(members))
    first = np.maximum.accumulate(np.where(group, place, 0))
    rank[members] = old + np.maximum.accumulate(np.where(part, place, 0)) - first
    sizes = np.diff(np.append(np.flatnonzero(part), len(members)))
    return members[np.repeat(sizes > 1, sizes)]


class Extensions:
    """Longest common extensions of a sequence of positive numbers.

    The last number of the sequence, and at least one number between any two texts
    in it, must be unique.
    """

    def __init__(self, sequence: np.ndarray):
        period, width = COVER_PERIOD, len(COVER)
        self.words = np.concatenate([sequence, np.zeros(2 * period, sequence.dtype)])
        at = (np.arange(-(-len(sequence) // period))[:, None] * period + np.array(COVER)).ravel()
        self.at = at[at < len(sequence)]
        self.slot = np.zeros(period, np.int64)
        self.slot[list(COVER)] = np.arange(width)
        self.shift = shifts()
        levels = self._sort(width)
        self.rank = levels[-1]
        self.table = self._minima(self._prefixes(levels, width))

    def _sort(self, width: int) -> list[np.ndarray]:
        """Ranks of the samples by their first 31, 62, 124, ... words, until all differ."""
        n, period = len(self.at), COVER_PERIOD
        rank, tied = np.zeros(n, np.int64), np.arange(n if n > 1 else 0)
        bits = int(self.words.max(initial=1)).bit_length()
        packed = max(1, 62 // bits)  # words per comparison
        for start in range(0, period, packed):
            if not len(tied):
                break
            key = np.zeros(len(tied), np.int64)
            for step in range(start, min(period, start + packed)):
                key = (key << bits) | self.words[self.at[tied] + step]
            tied = refine(rank, tied, key)
        levels, ahead = [rank.copy()], width
        while len(tied):
            later = tied + ahead
            tied = refine(rank, tied, np.where(later < n, levels[-1][np.minimum(later, n - 1)], -1))
            levels.append(rank.copy())
            ahead *= 2
        return levels

    def _prefixes(self, levels: list[np.ndarray], width: int) -> np.ndarray:
        """Common words of each sampled suffix and the next one in order."""
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = levels[level][a] == levels[level][b]
            common[same] += COVER_PERIOD << level
            a[same] += width << level
            b[same] += width << level
        rest = np.full(len(a), COVER_PERIOD)
        return common + self.match(self.at[a], self.at[b], rest)

    @staticmethod
    def _minima(common: np.ndarray) -> np.ndarray:
        n = len(common)
        table = np.zeros((max(1, n.bit_length()), n), np.int32)
        table[0] = common
        for k in range(1, len(table)):
            half = 1 << (k - 1)
            table[k, : n - 2 * half + 1] = np.minimum(
                table[k - 1, : n - 2 * half + 1], table[k - 1, half : n - half + 1]
            )
        return table

    def match(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Equal words at a and b, compared one by one up to `limit`."""
        found, step = np.zeros(len(a), np.int64), 0
        left = np.flatnonzero(limit > 0)
        while len(left):
            left = left[self.words[a[left] + step] == self.words[b[left] + step]]
            step += 1
            found[left] = step
            left = left[limit[left] > step]
        return found

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from positions a and b on; a and b differ everywhere."""
        shift = self.shift[a % COVER_PERIOD, b % COVER_PERIOD]
        found = self.match(a, b, shift)
        met = np.flatnonzero(found == shift)
        x, y = (
            self.rank[(p // COVER_PERIOD) * len(COVER) + self.slot[p % COVER_PERIOD]]
            for p in (a[met] + shift[met], b[met] + shift[met])
        )
        low, high = np.minimum(x, y), np.maximum(x, y)
        k = np.frexp((high - low).astype(float))[1] - 1
        found[met] += np.minimum(self.table[k, low], self.table[k, high - (1 << k)])
        return found


def grid_points(sequence: np.ndarray, longest: int, params: RunParams) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of grid words that may be the first of a run."""
    places, periods = [], []
    for q in range(1, longest // params.min_repeats + 1):
        same = sequence[q::q] == sequence[: len(sequence) - q : q]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        for probe in (1, q // 2):
            at = at[sequence[at + probe] == sequence[at + probe + q]]
        if len(at):
            places.append(at.astype(np.int64))
            periods.append(np.full(len(at), q, np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *periods])


def extended(lce: Extensions, at: np.ndarray, q: np.ndarray, params: RunParams) -> np.ndarray:
    """Rows (start, end, period) of the runs whose first grid word is one of `at`."""
    inner = np.zeros(len(at), bool)
    back = np.flatnonzero(at >= q)
    inner[back] = lce.common(at[back] - q[back], at[back]) >= q[back]
    at, q = at[~inner], q[~inner]
    end = at + q + lce.common(at, at + q)
    low, high = np.maximum(at - q + 1, 0), at.copy()
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        reaches = lce.common(middle, middle + q[left]) >= at[left] - middle
        high[left[reaches]] = middle[reaches]
        low[left[~reaches]] = middle[~reaches] + 1
        left = left[low[left] < high[left]]
    long = end - low >= np.maximum(params.min_words, params.min_repeats * q)
    return np.column_stack([low[long], end[long], q[long]])


def runs_of(sequence: np.ndarray, starts: np.ndarray, sizes: np.ndarray, params: RunParams) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    `sequence` holds every text's words followed by a separator of its own.
    """
    none = np.zeros((0, 4), np.int64)
    at, q = grid_points(sequence, int(sizes.max(initial=0)), params)
    if not len(at):
        return none
    text = np.searchsorted(starts, at, "right") - 1
    wanted = np.unique(text)
    spans = [sequence[starts[t] : starts[t] + sizes[t] + 1] for t in wanted]
    short = np.concatenate(spans)
    begin = np.cumsum(sizes[wanted] + 1) - sizes[wanted] - 1
    place = np.searchsorted(wanted, text)
    at += begin[place] - starts[text]
    lce = Extensions(short)
    found = np.concatenate([
        extended(lce, at[i : i + params.chunk], q[i : i + params.chunk], params)
        for i in range(0, len(at), params.chunk)
    ])
    # A stretch met with a multiple of its smallest period is the same stretch.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):
        new = np.any(found[1:, :2] != found[:-1, :2], axis=1)
        found = found[np.concatenate([[True], new])]
    of = np.searchsorted(begin, found[:, 0], "right") - 1
    rows = np.column_stack([wanted[of], found[:, 0] - begin[of], found[:, 1] - found[:, 0], found[:, 2]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those of a run after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def batch_runs(texts: list[str], params: RunParams) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Words and runs (start, length, period) of every text."""
    words = [text.encode("utf-8", "replace").split() for text in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [w for part in words for w in part]
    numbers = pd.factorize(flat)[0]
    total = int(numbers.max(initial=-1)) + 2
    sequence = np.empty(len(flat) + len(texts), np.int64)
    ends = starts + sizes
    inside = np.ones(len(sequence), bool)
    inside[ends] = False
    sequence[inside] = numbers + 1
    sequence[ends] = total + np.arange(len(texts))
    rows = runs_of(sequence, starts, sizes, params)
    cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return words, [rows[a:b, 1:] for a, b in zip(cuts[:-1], cuts[1:])]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, exact; then smallest start and period."""
    rows = (tuple(map(int, r)) for r in runs)
    return max(rows, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def find_runs(docs: DataFrame, params: RunParams | None = None) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) per document, over whole texts.

    Words are what lies between ASCII white space. `runs` lists (start, length, period)
    by start, then period; `best` is the one with the most repeats, null without runs;
    `collapsed` joins by one space the words that no run contains after its first
    period. A null text has no words. Repeated rows keep a row each; ids may be null;
    other columns are not read; an empty table gives no rows.
    """
    params = params or RunParams()
    names = ["starts", "lengths", "periods"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, runs = batch_runs(batch["text"].tolist(), params)
            best = [strongest(r) for r in runs]
            out = {"doc_id": ids_of(batch["doc_id"]), "n_words": [len(w) for w in words]}
            out |= {name: [r[:, i] for r in runs] for i, name in enumerate(names)}
            out |= {
                f"best_{name}": pd.array([b and b[i] for b in best], "Int64") for i, name in enumerate(names)
            }
            out["collapsed"] = [b" ".join(collapsed(w, r)).decode() for w, r in zip(words, runs)]
            yield pd.DataFrame(out)

    schema = "doc_id bigint, n_words bigint, " + ", ".join(f"{n} array<bigint>" for n in names)
    schema += ", " + ", ".join(f"best_{n} bigint" for n in names) + ", collapsed string"
    rows = small_batches(docs, params.batch_mb).select(id_text("doc_id").alias("doc_id"), text_of().alias("text"))
    found = rows.mapInPandas(run, schema)
    each = F.arrays_zip(*[F.col(n).alias(n[:-1]) for n in names]).cast(
        "array<struct<start:bigint,length:bigint,period:bigint>>"
    )
    best = F.struct(*[F.col(f"best_{n}").alias(n[:-1]) for n in names])
    return found.select(
        "doc_id", "n_words", each.alias("runs"), F.when(F.col("best_starts").isNotNull(), best).alias("best"), "collapsed"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by a hash of its id ends in a repeated part.

    With h = crc32 of the decimal id: where h % 10 is 0, the words from a = (h / 10) % n
    on repeat the p = 1 + (n - a) / (3 + (h / 10) % 8) words that start there. A null id
    leaves the text as it is.
    """

    @F.pandas_udf("string")
    def planted(doc_id: pd.Series, text: pd.Series) -> pd.Series:
        out = []
        for number, value in zip(doc_id.tolist(), text.tolist()):
            h = zlib.crc32(number.encode()) if number is not None else 1
            if h % 10 == 0 and (words := value.encode("utf-8", "replace").split()):
                n, g = len(words), h // 10
                a = g % n
                part = words[a : a + 1 + (n - a) // (3 + g % 8)]
                tail = part * (-(-(n - a) // len(part)))
                value = b" ".join(words[:a] + tail[: n - a]).decode()
            out.append(value)
        return pd.Series(out, dtype=object)

    rows = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.select("doc_id", planted(id_text("doc_id"), "text").alias("text"))
