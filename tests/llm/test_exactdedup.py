"""Exact duplicates against plain Python, with and without frequent digests."""

import hashlib
import random

import pandas as pd
import pytest

from attesta.llm import catalog
from attesta.llm.exactdedup import ExactParams, candidates, digests, drop_copies, find_copies, frequent, merged
from attesta.llm.common import staged

SCHEMA = "doc_id bigint, text string"
BIG = 2**53 + 1


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(lower(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, digest))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CASES = {
    "mixed": [(1, "Ab c"), (2, "aB C"), (3, "ÀB"), (4, "àb"), (5, None), (6, ""), (7, " "), (8, "x" * 200_000)],
    "ids": [(BIG, "a"), (BIG - 1, "A"), (None, "a"), (None, "z"), (None, "Z"), (BIG, "q"), (BIG, "q"), (-3, "q")],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("heavy", [1, 2, 1024])
def test_equals_plain(spark, name, heavy):
    docs = spark.createDataFrame(CASES[name], SCHEMA)
    found = find_copies(docs, ExactParams(heavy=heavy))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(found) == plain(CASES[name])


@pytest.mark.parametrize("heavy", [1, 3, 50])
def test_skewed_groups(spark, heavy):
    rng = random.Random(heavy)
    rows = [(i, rng.choice(["Hot", "hot", f"t{rng.randrange(40)}", f"T{rng.randrange(400)}"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert rows_of(find_copies(docs, ExactParams(heavy=heavy))) == plain(rows)


def test_frequent_digests_are_candidates(spark):
    """Every digest above n / (heavy + 1) is found, however its rows are spread."""
    rng = random.Random(5)
    rows = [(i, "abcdef"[min(5, int(rng.expovariate(0.7)))]) for i in range(900)]
    rows += [(1000 + i, f"only {i}") for i in range(600)]
    rng.shuffle(rows)
    params = ExactParams(heavy=4)
    narrow = staged(digests(spark.createDataFrame(rows, SCHEMA).repartition(5)), "t")
    counts = pd.Series([hashlib.sha256(t.encode()).digest() for _, t in rows]).value_counts()
    wanted = {d for d, n in counts.items() if n * (params.heavy + 1) > len(rows)}
    maybe = {bytes(r.digest) for r in candidates(narrow, params).collect()}
    assert wanted and wanted <= maybe and len(maybe) <= params.heavy
    sure = {bytes(r.digest): r.group_size for r in frequent(narrow, params).collect()}
    assert sure == {d: counts[d] for d in wanted}


def test_merging_keeps_the_error_bound():
    rng = random.Random(2)
    stream = [f"k{min(30, int(rng.expovariate(0.3)))}" for _ in range(5000)]
    counters = pd.Series(dtype="int64")
    for start in range(0, len(stream), 97):
        part = pd.Series(stream[start : start + 97]).value_counts()
        counters = merged(counters.add(part, fill_value=0).astype("int64"), 6)
    assert len(counters) <= 6
    for key, n in pd.Series(stream).value_counts().items():
        assert n - len(stream) / 7 <= counters.get(key, 0) <= n


def test_frequent_rows_are_not_shuffled(spark):
    """Frequent digests are decided by broadcast joins alone."""
    docs = spark.createDataFrame([(i, "same") for i in range(100)], SCHEMA)
    plan = find_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "CartesianProduct" not in plan


@pytest.mark.parametrize("heavy", [1, 1024])
def test_drop_copies(spark, heavy):
    rows = [(1, "a", 9, None), (2, "A", 8, "u"), (2, "A", 8, "u"), (None, "a", 7, "v"), (4, None, 1, "w"), (3, "", 2, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int, digest string")
    kept = drop_copies(docs, ExactParams(heavy=heavy))
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted([(2, "A", 8, "u"), (4, None, 1, "w")], key=repr)


def test_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(catalog.QUERIES["op13_exact_copies"](spark, folder)) == expected
