"""Quality of documents by co-training a text view and a metadata view.

Text view: shares of character classes, repeated words and lines, word lengths.
Metadata view: source, language and stored length, without looking at the text.
Each view has a logistic classifier. In every round a view labels the unlabelled
rows it is surest of, in the proportion of the classes, and hands them to the
other view. Afterwards both views are calibrated on labelled rows kept apart, and
a logistic combination of the calibrated log-odds scores every document.

The classifiers are fitted on bounded samples, chosen by a hash of the id: about
`labelled_rows` of the documents with a label and `sample_rows` of all documents.
Scoring covers all documents and whole texts and shuffles nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import give_back, id_text, ids_of, lean, small_batches, text_of

MARKS = re.compile(r"[#$%&*^~<>=@\\{}\[\]]")
SLICES = 1 << 40  # of the hash that chooses the samples
LETTERS = re.compile(r"[^\W\d_]")
UPPER_WORD = re.compile(r"\b[^\W\d_a-zà-öø-ÿ]{2,}\b")


@dataclass(frozen=True)
class QualityParams:
    labelled_rows: int = 20_000  # bound of the labelled documents that the views are fitted on
    sample_rows: int = 20_000  # bound of the documents that are labelled by the views
    rounds: int = 4
    share: float = 0.05  # of the unlabelled sample handed over per round and view
    least_sure: float = 0.9  # confidence of a pseudo-label
    threshold: float = 0.5  # documents below are rejected
    sources: int = 32  # hashed indicator columns of the metadata view
    lengths: int = 12
    ridge: float = 1e-2


def text_features(text: str) -> list[float]:
    n, tokens = max(1, len(text)), text.split()
    k, lines = max(1, len(tokens)), text.split("\n")
    distinct = len(set(tokens))
    repeats = sum(map(str.__eq__, tokens, tokens[1:])) / k
    return [
        math.log1p(len(tokens)),
        distinct / k,
        distinct / math.sqrt(k),
        repeats,
        sum(map(len, tokens)) / k / 10,
        len(UPPER_WORD.findall(text)) / k,
        len(MARKS.findall(text)) / k,
        text.count("!") / k,
        text.count("|") / k,
        (text.count(".") + text.count(",") + text.count(";")) / k,
        sum(map(text.count, "0123456789")) / n,
        len(LETTERS.findall(text)) / n,
        len(set(lines)) / len(lines),
        1.0 if not tokens else 0.0,
    ]


def metadata_features(source: str | None, lang: str | None, n_chars: float | None, p: QualityParams) -> list[float]:
    row = [0.0] * (p.sources + 8 + p.lengths + 1)
    row[zlib.crc32(f"s{source}".encode()) % p.sources] = 1.0
    row[p.sources + zlib.crc32(f"l{lang}".encode()) % 8] = 1.0
    if n_chars is None or n_chars != n_chars:
        row[-1] = 1.0
    else:
        row[p.sources + 8 + min(p.lengths - 1, int(math.log1p(max(0.0, n_chars))))] = 1.0
    return row


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights by Newton steps on standardised columns; the last is the intercept."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    penalty = np.full(z.shape[1], ridge * len(x) / 100 + ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    plain = w[:-1] / scale
    return np.append(plain, w[-1] - plain @ mean)


def log_odds(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip(x @ weights[:-1] + weights[-1], -30, 30)


@dataclass
class QualityModel:
    text: np.ndarray
    metadata: np.ndarray
    text_scale: np.ndarray  # calibration of each view
    metadata_scale: np.ndarray
    combined: np.ndarray

    def views(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log-odds of both views."""
        a = log_odds(log_odds(text, self.text)[:, None], self.text_scale)
        b = log_odds(log_odds(metadata, self.metadata)[:, None], self.metadata_scale)
        return a, b

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-log_odds(np.column_stack([a, b]), self.combined)))


def co_train(views: list[np.ndarray], labels: np.ndarray, apart: np.ndarray, p: QualityParams) -> QualityModel | None:
    """Model of two feature matrices; labels are 1, 0 or nan, `apart` calibrates.

    None if the labelled rows do not have both classes in both parts.
    """
    known = ~np.isnan(labels)
    fit, held = known & ~apart, known & apart
    if any(len(np.unique(labels[part])) < 2 for part in (fit, held)):
        return None
    taught = [labels.copy(), labels.copy()]  # what each view learns from
    for target in taught:
        target[~fit] = np.nan
    positive = labels[fit].mean()
    free = np.flatnonzero(~known)
    weights = [None, None]
    for round_number in range(p.rounds + 1):
        for v in (0, 1):
            rows = ~np.isnan(taught[v])
            weights[v] = fit_logistic(views[v][rows], taught[v][rows], p.ridge)
        if round_number == p.rounds:
            break
        for v in (0, 1):
            other = taught[1 - v]
            open_rows = free[np.isnan(other[free])]
            odds = log_odds(views[v][open_rows], weights[v])
            sure = math.log(p.least_sure / (1 - p.least_sure))
            order = np.argsort(odds, kind="stable")
            quota = p.share * len(free)
            low = order[: round(quota * (1 - positive))]
            high = order[::-1][: round(quota * positive)]
            other[open_rows[low[odds[low] < -sure]]] = 0.0
            other[open_rows[high[odds[high] > sure]]] = 1.0
    odds = [log_odds(views[v], weights[v]) for v in (0, 1)]
    scales = [fit_logistic(o[held][:, None], labels[held], p.ridge) for o in odds]
    both = np.column_stack([log_odds(o[:, None], s) for o, s in zip(odds, scales)])
    return QualityModel(*weights, *scales, fit_logistic(both[held], labels[held], p.ridge))


def _features(batch: pd.DataFrame, p: QualityParams) -> list[np.ndarray]:
    text = np.array([text_features(t) for t in batch["text"]], float)
    meta = [metadata_features(*r, p) for r in zip(batch["source"], batch["lang"], batch["n_chars"].tolist())]
    return [text.reshape(len(batch), -1), np.array(meta, float).reshape(len(batch), -1)]


def _inputs(docs: DataFrame):
    return [
        text_of().alias("text"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("double").alias("n_chars"),
    ]


def _share(wanted: int, rows: int) -> int:
    """Slices of the hash that hold about `wanted` of the rows, rounded up."""
    return math.ceil(min(1.0, wanted / max(1, rows)) * SLICES)


def set_apart(ids: list[int], labels: np.ndarray) -> np.ndarray:
    """Every fourth labelled row of each class, in the order of a hash, calibrates."""
    apart = np.zeros(len(ids), bool)
    for label in (0.0, 1.0):
        rows = sorted(np.flatnonzero(labels == label), key=lambda i: (zlib.crc32(f"apart{ids[i]}".encode()), ids[i]))
        apart[rows[::4]] = True
    return apart


def train(docs: DataFrame, labels: DataFrame, params: QualityParams) -> QualityModel | None:
    """Co-trained model of hashed samples; the features are computed in Spark.

    A document with several labels counts as good if most of them are 1. None if fewer
    than two documents have one of the labels. It is an error if the sample has fewer
    than two of a label that more documents have.
    """
    key = F.pmod(F.xxhash64(F.lit("quality"), F.col("doc_id")), F.lit(SLICES))
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), *_inputs(docs))
    judged = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg((F.avg("quality") > 0.5).cast("double").alias("label"))
        .join(rows.select("doc_id"), "doc_id", "left_semi")
    )
    found = dict(judged.groupBy("label").count().collect())
    if min(found.get(0.0, 0), found.get(1.0, 0)) < 2:
        return None
    labelled = _share(params.labelled_rows, sum(found.values()))
    # No larger than the labelled share, so every labelled row among them has its label.
    share = min(labelled, _share(params.sample_rows, rows.count()))
    known = judged.filter(key < F.lit(labelled))
    sample = rows.join(F.broadcast(known), "doc_id", "left").filter(F.col("label").isNotNull() | (key < F.lit(share)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in lean(batches):
            text, meta = _features(batch, params)
            yield pd.DataFrame({
                "doc_id": ids_of(batch["doc_id"]), "label": batch["label"], "text": list(text), "meta": list(meta),
            })

    named = sample.select(id_text("doc_id").alias("doc_id"), "text", "source", "lang", "n_chars", "label")
    made = named.mapInPandas(run, "doc_id bigint, label double, text array<double>, meta array<double>")
    taken = made.filter("doc_id is not null").toPandas().sort_values("doc_id", kind="stable")
    known_labels = taken["label"].to_numpy(float)
    if any((known_labels == label).sum() < 2 for label in (0.0, 1.0)):
        raise ValueError(f"labels {found} exist, but the sample lacks one of them: raise labelled_rows")
    views = [np.stack(taken[name].to_list()) for name in ("text", "meta")]
    return co_train(views, known_labels, set_apart(taken["doc_id"].tolist(), known_labels), params)


def _decided(batch: pd.DataFrame, model: QualityModel | None, params: QualityParams) -> pd.DataFrame:
    n = len(batch)
    if model is None or not n:
        half = np.full(n, 0.5)
        return pd.DataFrame({"text_score": half, "metadata_score": half, "score": half, "keep": np.full(n, True)})
    a, b = model.views(*_features(batch, params))
    score = model.score(a, b)
    return pd.DataFrame({
        "text_score": 1 / (1 + np.exp(-a)), "metadata_score": 1 / (1 + np.exp(-b)),
        "score": score, "keep": score >= params.threshold,
    })


def score(docs: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """(doc_id, text_score, metadata_score, score, keep) per document.

    A null text counts as empty; null metadata have values of their own. With fewer
    than two labelled documents of either kind every score is 0.5 and every document
    is kept. Repeated rows keep a row each, null ids stay null; texts have any length;
    columns other than text, source, lang, n_chars and doc_id are not read; an empty
    table gives no rows.
    """
    params = params or QualityParams()
    model = train(docs, labels, params)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _decided(batch, model, params)
            found.insert(0, "doc_id", ids_of(batch["doc_id"]))
            yield found

    rows = docs.select(id_text("doc_id").alias("doc_id"), *_inputs(docs))
    return rows.mapInPandas(
        run, "doc_id bigint, text_score double, metadata_score double, score double, keep boolean"
    )


def keep_good(docs: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """The rows of `docs`, all columns, whose score reaches the threshold.

    The cases of `score` hold: null texts are judged as empty ones, repeated rows stay
    or go together, columns of any name are passed on.
    """
    params = params or QualityParams()
    model = train(docs, labels, params)

    @F.pandas_udf("boolean")
    def keep(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.Series:
        batch = pd.DataFrame({"text": text, "source": source, "lang": lang, "n_chars": n_chars})
        found = _decided(batch, model, params)["keep"]
        give_back()
        return found

    return docs.filter(keep(*_inputs(docs)))
