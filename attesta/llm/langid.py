"""Language of a text by words first, character n-grams for unseen words.

A known word adds its log frequency in every language. An unseen word falls back
to its longest known n-grams: the mean log frequency of those of four characters
(with word ends marked), else of three, two, one. The language with the largest
sum, prior included, wins.

The counts come from a bounded, hashed sample of the labelled rows that may be
learnt from; they are summed in Spark, and rare words and n-grams are left out,
so the model that travels to the tasks is bounded by the sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import id_text, ids_of, small_batches, text_of

WORD = re.compile(r"[^\W\d_]+")
NONE = "und"


@dataclass(frozen=True)
class LangParams:
    train_rows: int = 20_000  # bound of the labelled sample
    min_count: int = 3  # of a known word or n-gram
    longest: int = 4  # n-gram characters
    smoothing: float = 0.5
    cached_words: int = 500_000  # unseen words that a task remembers
    folds: int = 5  # fold 0 is held out


def held_out(doc_id: Column, params: LangParams) -> Column:
    """True for ids of fold 0; a null id is in no fold and never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % params.folds == 0, F.lit(False))


def grams(word: str, size: int) -> list[str]:
    marked = f"<{word}>" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _counts(sample: DataFrame, params: LangParams) -> DataFrame:
    """(lang, kind, term, n): kind 0 for words, else the n-gram size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"], batch["text"]):
                seen.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            rows = []
            for lang, found in seen.items():
                parts: Counter = Counter()
                for word, n in found.items():
                    parts[0, word] += n
                    for size in range(1, params.longest + 1):
                        for gram in grams(word, size):
                            parts[size, gram] += n
                rows += [(lang, kind, term, n) for (kind, term), n in parts.items()]
            yield pd.DataFrame(rows, columns=["lang", "kind", "term", "n"])

    found = sample.mapInPandas(run, "lang string, kind int, term string, n bigint")
    return found.groupBy("lang", "kind", "term").agg(F.sum("n").alias("n"))


@dataclass
class LangModel:
    langs: list[str]
    prior: np.ndarray
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]  # by size, from 1

    def of_word(self, word: str) -> np.ndarray | None:
        """Log frequencies by language; None if nothing about the word is known."""
        found = self.words.get(word)
        if found is not None:
            return found
        for size in range(len(self.grams), 0, -1):
            table = self.grams[size - 1]
            known = [table[g] for g in grams(word, size) if g in table]
            if known:
                return np.mean(known, axis=0)
        return None


def train(docs: DataFrame, params: LangParams) -> LangModel:
    """Model of the labelled rows outside fold 0. No such rows: no languages."""
    usable = docs.filter(
        ~held_out(F.col("doc_id"), params) & F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select("doc_id", "lang", "text")
    sizes = dict(usable.groupBy("lang").count().collect())
    langs = sorted(sizes)
    total = sum(sizes.values())
    if not total:
        return LangModel([], np.zeros(0), {}, [])
    share = min(1.0, params.train_rows / total)
    key = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1_000_000))
    sample = usable.filter(key < F.lit(math.ceil(share * 1_000_000))).select("lang", "text")
    counts = _counts(sample, params)
    pivot = counts.groupBy("kind", "term").agg(
        F.sum("n").alias("all"), *[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"l{i}")
                                   for i, lang in enumerate(langs)]
    )
    sums = pivot.groupBy("kind").agg(F.count("*").alias("v"), *[F.sum(f"l{i}") for i in range(len(langs))])
    totals = {r[0]: (r[1], np.array(r[2:], float)) for r in sums.collect()}
    kept = pivot.filter(F.col("all") >= params.min_count).toPandas()
    tables: dict[int, dict[str, np.ndarray]] = {k: {} for k in range(params.longest + 1)}
    for kind, part in kept.groupby("kind"):
        terms, sum_by_lang = totals[kind]
        n = part[[f"l{i}" for i in range(len(langs))]].to_numpy(float)
        logs = np.log((n + params.smoothing) / (sum_by_lang + params.smoothing * terms))
        tables[kind] = dict(zip(part["term"], logs))
    prior = np.log(np.array([sizes[lang] for lang in langs], float) / total)
    return LangModel(langs, prior, tables[0], [tables[k] for k in range(1, params.longest + 1)])


class Scorer:
    """Sums of word scores; every word seen has a row in one growing matrix."""

    def __init__(self, model: LangModel, limit: int):
        self.model, self.limit = model, limit
        self._reset()

    def _reset(self) -> None:
        n = len(self.model.langs)
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, n))
        self.used = 2  # row 0: no letter, row 1: letters without any evidence

    def _learn(self, words: set[str]) -> None:
        for word in words:
            found = self.model.of_word(word)
            if found is None or not any(map(str.isalpha, word)):
                self.place[word] = 1 if any(map(str.isalpha, word)) else 0
                continue
            if self.used == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[self.used] = found
            self.place[word] = self.used
            self.used += 1

    def predict(self, text: str) -> tuple[str, float]:
        words = WORD.findall(text.lower())
        if self.used > self.limit:
            self._reset()
        place = self.place
        self._learn({w for w in set(words) if w not in place})
        places = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        if not places.any() or not self.model.langs:
            return NONE, 0.0
        total = self.model.prior + self.rows[places].sum(axis=0)
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, params: LangParams | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document, from its text alone.

    A null text or one without a letter is `und` with score 0, and so is every
    text if there is nothing to learn from. The score is the language's share of
    the posterior. Ties go to the first language by name. Repeated rows keep a
    row each.
    """
    params, docs = params or LangParams(), small_batches(docs)
    # Plain values: workers need not have the package to read them.
    model = docs.sparkSession.sparkContext.broadcast(vars(train(docs, params)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(LangModel(**model.value), params.cached_words)
        for batch in batches:
            found = [scorer.predict(text) for text in batch["text"]]
            yield pd.DataFrame({
                "doc_id": ids_of(batch["doc_id"]), "held_out": batch["held_out"],
                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
            })

    rows = docs.select(
        id_text("doc_id").alias("doc_id"), held_out(F.col("doc_id"), params).alias("held_out"),
        text_of().alias("text"),
    )
    return rows.mapInPandas(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
