import random

import numpy as np
import pytest
import xxhash

from attesta.llm import golay, simhash


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    n = min(3, len(words))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_golay_words_within_two_bits_share_a_key():
    parts, rng = golay.tables(), np.random.default_rng(5)
    words = rng.integers(0, 1 << 23, 400)
    decoded = golay.decode(words, parts)
    assert len(np.unique(golay.decode(np.arange(1 << 12) << 11, parts))) <= 1 << 12
    assert decoded.min() >= 0 and decoded.max() < 1 << 12
    for width in (23, 18):
        short = words & ((1 << width) - 1)
        mine = golay.keys(short, parts, width)
        assert {len(set(r) - {-1}) for r in golay.keys(words, parts)} <= {1, 6}
        for i, j in [(0, 0), (0, 3), (2, 9), (16, 17)]:
            other = golay.keys(short ^ (1 << i) ^ (1 << j if i != j else 0), parts, width)
            for a, b in zip(mine, other):
                assert (set(a) & set(b)) - {-1}


def test_golay_code_is_perfect():
    low, high, errors = golay.tables()
    assert len(np.unique(errors)) == 1 << golay.CHECKS
    assert max(bin(int(e)).count("1") for e in errors) == 3


@pytest.mark.parametrize("bucket", [64, 3])
def test_links_equal_brute_force(spark, bucket):
    rng, fps = random.Random(3), set()
    for _ in range(12):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(15):
            fps.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
            base ^= 1 << rng.randrange(64)
    for a, b in ((0, 1), (5, 6)):  # a dense ball
        for i in range(20):
            fps.add((1 << a) ^ (1 << b) ^ (1 << i))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    found = simhash.links(nodes, simhash.SimHashParams(bucket=bucket)).collect()
    roots = {r.node: r.root for r in simhash.components(
        spark.createDataFrame([(r.u, r.v) for r in found], "u bigint, v bigint")).collect()}
    labels = [roots.get(s, s) for s in signed]
    expected = plain_groups(fps)
    assert len(set(zip(labels, expected))) == len(set(labels)) == len(set(expected))


def test_query_equals_brute_force(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(900)}" for _ in range(400)]
    texts = [None, "", " \t\n", "One", "one", "A b", "a B", "Ä ä x", "\x1cz y", "x" * 50_000]
    for i in range(30):
        words = list(base)
        for _ in range(i // 6):
            words[rng.randrange(400)] = "zz"
        texts.append(" ".join(words) + ("\n" if i % 2 else ""))
    rows = [(1000 - i, t, 7, "clash") for i, t in enumerate(texts)] + [(None, "lonely text", 7, "")]
    rows.append(rows[12])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int, component_id string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    fps = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_groups(fps)
    least = {}
    for g, r in zip(groups, rows):
        ids = [x for x in (least.get(g), r[0]) if x is not None]
        least[g] = min(ids) if ids else None
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    firsts = {}
    for g, f, r in zip(groups, fps, rows):
        best = (r[0] is None, r[0] or 0, f)
        firsts[g] = min(firsts.get(g, best), best)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(f[1] for f in firsts.values())
    expected = sorted(
        (str(r[0]), f"{f:016x}", str(least[g])) for r, f, g in zip(rows, fps, groups)
    )
    assert expected == sorted((str(r[0]), r[1], str(r[2])) for r in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).collect() == []
