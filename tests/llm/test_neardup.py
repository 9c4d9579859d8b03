import os
import random

import numpy as np
import pytest

import corpus_pipeline
from attesta.llm import neardup
from attesta.llm.common import shared_folder

DATA = "/root/testdata/sf0.001"


def plain_set(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain_kept(rows):
    """Smallest id of each group of pairwise links at Jaccard 0.8 or more."""
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            either = len(sets[i] | sets[j])
            if not either or len(sets[i] & sets[j]) / either >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(least.values())


def planted():
    """Texts with edited copies on both sides of the threshold, chains and a hot line."""
    rng, rows = random.Random(8), []
    line = [f"line{i}" for i in range(60)]
    for _ in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((60, 200, 500)))]
        rows.append(words)
        for share in (0.005, 0.01, 0.02, 0.03, 0.04, 0.06):
            copy = list(words)
            for _ in range(max(1, int(share * len(words)))):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(5000)}"
            rows.append(copy)
        rows.append(words + words[: len(words) // 3])  # a part repeated
        rows.append(words * 3)
    for n in (8, 20, 30):
        rows += [line + [f"own{i}x{j}" for j in range(n)] for i in range(12)]
    chain = [f"c{i}" for i in range(300)]
    rows += [chain[i * 20 :] + [f"d{j}" for j in range(i * 20)] for i in range(8)]
    texts = [" ".join(words) for words in rows] + ["", " ", "one", "One", "two words"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_stage_equals_brute_force_on_edited_copies(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, DATA)
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept(rows)


@pytest.mark.parametrize("changed", [{"block": 3}, {"block": 2, "many": 1, "rounds": 0}, {"block_shingles": 300, "many": 2}])
def test_crowded_buckets_lose_nothing(spark, changed):
    """Many cells per bucket, drawn members, buckets split by further bands."""
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = neardup.keep_first(docs, neardup.NearParams(**changed))
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept(rows)


def test_ids_rows_and_names(spark):
    """Ids beyond the doubles next to null ids, repeated rows, clashing names."""
    big = 2**53 + 1
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(big, "other words here", 1, "a"), (None, "without id", 2, "b"), (5, text, 3, "c"), (5, text, 3, "c"),
            (7, text + " end", 4, "d"), (None, text, 5, "e"), (big + 1, "Other  words here", 6, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _id int, node string")
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(["5", "None", str(big)])


def test_tables_are_deleted(spark, tmp_path):
    folder = shared_folder(spark).replace("file:", "")
    before = set(os.listdir(folder))
    neardup.keep_first(spark.createDataFrame(planted(), "doc_id bigint, text string")).count()
    left = {name.split("-")[1] for name in set(os.listdir(folder)) - before}
    assert left == {"kept"}  # read by the result


def test_stage_equals_brute_force_on_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, DATA)
    assert kept.columns == docs.columns
    expected = plain_kept([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in kept.collect()) == expected


@pytest.mark.parametrize("n", [40, 400])
def test_bands_find_pairs_at_the_threshold(n):
    params, rng = neardup.NearParams(), np.random.default_rng(3)
    signer, missed = neardup.Signer(params), 0
    for _ in range(300):
        both = rng.integers(0, 1 << 64, 8 * n // 10, np.uint64)
        a, b = (signer.sign(np.concatenate([both, rng.integers(0, 1 << 64, n // 10, np.uint64)]))[0] for _ in "ab")
        missed += not (a == b).any()
    assert missed == 0


def test_golay_keys_find_close_copies(spark, monkeypatch):
    """The fingerprints' keys meet close copies by themselves; links are verified all the same."""
    rng = random.Random(4)
    words = [f"w{rng.randrange(9000)}" for _ in range(2000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "other " + " ".join(reversed(words)))]
    # Without any MinHash band in common, only the fingerprints link texts.
    sign = neardup.Signer.sign

    def apart(self, hashes):
        keys, sketch = sign(self, hashes)
        return keys + np.int64(len(hashes) % 1000), sketch

    monkeypatch.setattr(neardup.Signer, "sign", apart)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = neardup.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
