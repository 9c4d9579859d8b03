import random

import pytest

from attesta.llm import hamming


def plain(rows, queries, k):
    rows = {(i, c) for i, c in rows if i is not None and c is not None}
    out = []
    for q, code in {(i, c) for i, c in queries if i is not None and c is not None}:
        near = sorted((bin((c ^ code) & (1 << 64) - 1).count("1"), i) for i, c in rows if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("segments", [4, 8, 16])
def test_equals_brute_force(spark, segments):
    rng = random.Random(segments)
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    codes = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(150):
        c = rng.choice(codes)
        for _ in range(rng.randrange(4)):
            c ^= 1 << rng.randrange(64)
        codes.append(c)
    codes += [codes[0]] * 60 + [0, (1 << 64) - 1]
    rows = [(i, signed(c)) for i, c in enumerate(codes)] + [(None, 5), (900, None), (3, signed(codes[3]))]
    df = spark.createDataFrame(rows, "id bigint, code bigint")
    queries = df.filter("id % 9 = 0 or id is null or id >= 300")
    got = hamming.nearest(df, queries, hamming.HammingParams(k=5, segments=segments))
    assert sorted(tuple(r) for r in got.collect()) == plain(
        rows, [r for r in rows if r[0] is None or r[0] % 9 == 0 or r[0] >= 300], 5
    )


def test_few_rows_and_empty(spark):
    df = spark.createDataFrame([(1, 7), (2, 6)], "id bigint, code bigint")
    assert sorted(tuple(r) for r in hamming.nearest(df, df).collect()) == [(1, 1, 2, 1), (2, 1, 1, 1)]
    assert hamming.nearest(df.limit(0), df.limit(0)).collect() == []


def test_codes(spark):
    rows = [(1, [0.5, -1.0, None, 2.0]), (2, None), (3, []), (4, [1.0] * 64), (5, [float("nan")])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    got = {r.id: r.c for r in df.select("id", hamming.code_of(df.v).alias("c")).collect()}
    assert got == {1: 9, 2: None, 3: 0, 4: -1, 5: 1}
