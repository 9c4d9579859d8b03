import random

import numpy as np

from attesta.llm import decontam


def plain(item, text):
    """Least edits between the item's words and any part of the text's words."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (word != other)))
        row = new
    return min(row)


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        kind, at = rng.randrange(3), rng.randrange(max(1, len(words)))
        if kind == 0:
            words[at:at + 1] = [f"new{rng.randrange(9)}"]
        elif kind == 1:
            del words[at:at + 1]
        else:
            words.insert(at, rng.choice(words) if words else "w")
    return words


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.randrange(1, 45))]) for i in range(40)]
    texts = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        if i % 2:
            item = rng.choice(items)[1]
            at = rng.randrange(len(words) + 1)
            words[at:at] = edited(item, rng.randrange(0, len(item) // 4 + 1), rng)
        texts.append(" ".join(words))
    return [(i, " ".join(w)) for i, w in items], texts


def test_equals_brute_force_with_high_recall(spark):
    rng = random.Random(12)
    items, texts = corpus(rng)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {(r.doc_id, r.item_id): r.edits for r in decontam.find_leaks(
        docs, spark.createDataFrame(items, "item_id bigint, text string"),
        decontam.LeakParams(block_chars=1500, batch_words=700)).collect()}
    expected = {}
    for d, text in enumerate(texts):
        for i, item in items:
            words = item.split()
            edits = plain(words, text.split())
            if edits <= len(words) // 5:
                expected[d, i] = edits
    assert set(found) <= set(expected)
    assert all(found[pair] >= expected[pair] for pair in found)
    assert len(found) >= 0.97 * len(expected) and len(expected) > 60
    clear = [p for p in expected if expected[p] == 0]
    assert all(p in found for p in clear)


def test_recall_at_the_threshold():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(10, 60)))) for i in range(200)]
    index = decontam.Items(items, decontam.LeakParams())
    texts = [edited(t.split(), len(t.split()) // 5, rng) for _, t in items]
    found = {(t, i) for t, i, *_ in index.find([["x"] * 8 + t + ["y"] * 8 for t in texts])}
    assert np.mean([(i, i) in found for i in range(200)]) >= 0.95


def test_odd_rows(spark):
    items = [(1, "The quick brown fox jumps over the lazy dog"), (None, "another item of seven words is here"),
             (2, None), (3, ""), (4, "?!"), (1, "The quick brown fox jumps over the lazy dog")]
    rows = [(1, "x THE quick, brown fox -- jumps over the lazy dog! y", 1), (2, None, 2), (3, "", 2), (4, "fox jumps over", 2),
            (None, "so another item of seven words is here now", 2), (5, "word " * 60_000 + "the quick brown cat jumps over the lazy dog", 3),
            (5, "word " * 60_000 + "the quick brown cat jumps over the lazy dog", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == {(1, 1, 0, 9), (None, None, 0, 7), (5, 1, 1, 60_008)}
    kept = decontam.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert decontam.find_leaks(docs.limit(0), bench).collect() == []
    assert decontam.find_leaks(docs, bench.limit(0)).collect() == []
    assert decontam.drop_leaks(docs, bench.limit(0)).count() == len(rows)


def test_null_item_is_not_item_minus_one(spark):
    bench = spark.createDataFrame([(None, "some item of six words here"), (-1, "some item of six words here")],
                                  "item_id bigint, text string")
    big = 2**53 + 1
    docs = spark.createDataFrame([(big, "x some item of six words here"), (None, "y some item of six words here")],
                                 "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == {(d, i) for d in (big, None) for i in (None, -1)}


def test_long_items_stay_small():
    """The bits of a walk are computed, not stored; the gap between texts counts as words."""
    rng = random.Random(3)
    item = [f"w{rng.randrange(3000)}" for _ in range(20_000)]
    params = decontam.LeakParams(batch_words=60_000)
    index = decontam.Items([(1, " ".join(item))], params)
    assert not any(isinstance(v, np.ndarray) and v.nbytes > 10_000_000 for v in vars(index).values())
    grouped = []
    index.find = lambda texts: grouped.append(len(texts)) or []
    list(decontam._search(["three short words"] * 10, index, params))
    assert sum(grouped) == 10 and max(grouped) * index.gap <= 60_000 + index.gap
