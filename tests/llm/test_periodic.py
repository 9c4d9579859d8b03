"""Runs of repeated words against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from attesta.llm import catalog
from attesta.llm.periodic import COVER, COVER_PERIOD, Extensions, RunParams, batch_runs, find_runs, shifts

SCHEMA = "doc_id bigint, text string"
BIG = 2**53 + 1


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, min_words=6, min_repeats=4):
    n, seen = len(words), {}
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_words, min_repeats * q):
                seen.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in seen.items())


def plain_collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_text(rng):
    letters = "abcdef"[: rng.randrange(1, 7)]
    parts = []
    for _ in range(rng.randrange(0, 6)):
        unit = [rng.choice(letters) for _ in range(rng.randrange(1, 9))]
        parts += unit * rng.randrange(1, 9)
        parts += unit[: rng.randrange(len(unit))]
    return " ".join(parts)


def test_cover_reaches_every_pair():
    table = shifts()
    for i in range(COVER_PERIOD):
        for j in range(COVER_PERIOD):
            step = table[i, j]
            assert 0 <= step < COVER_PERIOD
            assert (i + step) % COVER_PERIOD in COVER and (j + step) % COVER_PERIOD in COVER


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_extensions(letters):
    rng = np.random.default_rng(letters)
    parts = []
    for i in range(6):
        unit = rng.integers(1, letters + 1, rng.integers(1, 40))
        parts += [np.tile(unit, rng.integers(1, 12)), [100 + i]]
    sequence = np.concatenate(parts)
    lce = Extensions(sequence)
    a, b = rng.integers(0, len(sequence), (2, 4000))
    a, b = a[a != b], b[a != b]
    for x, y, found in zip(a, b, lce.common(a, b)):
        n = 0
        while max(x, y) + n < len(sequence) and sequence[x + n] == sequence[y + n]:
            n += 1
        assert n == found


def test_random_texts():
    rng = random.Random(3)
    texts = [random_text(rng) for _ in range(1500)]
    for start in range(0, len(texts), 250):
        part = texts[start : start + 250]
        words, runs = batch_runs(part, RunParams(chunk=1 + start))
        for text, found in zip(part, runs):
            assert [tuple(r) for r in found.tolist()] == plain_runs(words_of(text)), text


def test_long_texts():
    """All words equal, a long period, two periods, and a text of one word, with a small chunk."""
    rng = random.Random(9)
    unit = [f"w{rng.randrange(50)}" for _ in range(700)]
    texts = ["x " * 1200, " ".join(unit * 5 + unit[:33]), " ".join((unit[:9] * 5 + ["-"]) * 6), "x", ""]
    _, runs = batch_runs(texts, RunParams(chunk=500))
    for text, found in zip(texts, runs):
        assert [tuple(r) for r in found.tolist()] == plain_runs(words_of(text))


def test_settings():
    text = "a b a b a b a b a b c c c c c c c"
    for words, repeats in ((2, 4), (6, 4), (6, 5), (11, 4), (6, 7)):
        found = batch_runs([text], RunParams(min_words=words, min_repeats=repeats))[1][0]
        assert [tuple(r) for r in found.tolist()] == plain_runs(words_of(text), words, repeats)
    with pytest.raises(ValueError):
        RunParams(min_repeats=3)


CASES = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a a a a a"), (5, "a a a a a a"), (6, "é é é é " * 9),
    (7, "a\x1ca a\x1ca " * 5), (BIG, "x y " * 8), (None, "x y " * 8), (BIG, "x y " * 8), (-5, "z " * 5000),
    (8, "a b c d e f g h"), (9, "\U0001f642 " * 7),
]


def test_query_rows(spark):
    rng = random.Random(4)
    rows = CASES + [(1000 + i, random_text(rng)) for i in range(300)]
    rows += [(5000 + i, " ".join(rng.choice("abcdefghij") for _ in range(200))) for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(
        folder := spark.sparkContext._jsc.sc().getCheckpointDir().get() + "/periodic/documents.parquet"
    )
    found = catalog.QUERIES["op11_periodic_runs"](spark, folder.rsplit("/", 1)[0])
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert rows_of(found) == sorted((plain_row(*r) for r in rows), key=repr)


def test_operator_columns(spark):
    docs = spark.createDataFrame(
        [(1, "go go go go go go stop", 7, "q"), (2, None, None, None)], "doc_id int, text string, runs int, best string"
    )
    first, second = sorted(find_runs(docs).collect(), key=lambda r: r.doc_id)
    assert first.n_words == 7 and [tuple(r) for r in first.runs] == [(0, 6, 1)] and tuple(first.best) == (0, 6, 1)
    assert first.collapsed == "go stop"
    assert (second.n_words, second.runs, second.best, second.collapsed) == (0, [], None, "")
    assert find_runs(docs.filter("doc_id > 5")).count() == 0


def test_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(words_of(r[1])) < 3000]  # the plain search is quadratic
    ids = {r[0] for r in rows}
    found = [r for r in rows_of(catalog.QUERIES["op11_periodic_runs"](spark, folder)) if r[0] in ids]
    assert found == sorted((plain_row(*r) for r in rows), key=repr)
