import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.functions import text
from attesta.functions.blocks import attach_by_key, attach_by_key_left, first_n, running_before
from attesta.functions.numbers import percent_half_even, round_binary
from attesta.functions.quantiles import exact_quantiles
from attesta.functions.vectors import blend, cosine, jaccard


def test_round_binary_agrees_with_python(spark):
    rng = random.Random(3)
    values = [2.675, 4.125, 0.125, 1.005, 2.5, 3.5, 0.0, 11.995, 4.0, -2.675, -0.5]
    values += [rng.randint(1, 4000) / rng.randint(1, 400) for _ in range(4000)]
    values += [n / 200 for n in range(0, 2400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3, 4):
        rows = df.select("v", round_binary(F.col("v"), digits).alias("r")).collect()
        wrong = [(r.v, r.r, round(r.v, digits)) for r in rows if r.r != round(r.v, digits)]
        assert not wrong, wrong[:5]


def test_percent_goes_to_the_even_number(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (1, 3), (0, 5), (5, 5)], "n int, t int")
    got = [r.p for r in df.select(percent_half_even(F.col("n"), F.col("t")).alias("p")).collect()]
    assert got == [round(100 * n / t) for n, t in ((1, 8), (3, 8), (1, 3), (0, 5), (5, 5))]


def test_words_and_tidy_page(spark):
    texts = ["", "  ", "a b", "\ta b\n c ", "\x1ca\x1db", "x　y z", None]
    rows = (
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        .select("i", text.word_count("t").alias("n"), text.words("t").alias("w"), text.strip("t").alias("s"))
        .orderBy("i")
        .collect()
    )
    for row, value in zip(rows, texts):
        assert row.w == (value or "").split() and row.n == len((value or "").split())
        assert row.s == (None if value is None else value.strip())
    raw = "\n\n a\t\tb   c\n\n\n\nd   "
    tidy = spark.createDataFrame([(raw,)], "t string").select(text.tidy_page(F.col("t"))).first()[0]
    assert tidy == "a b c\n\nd"


def test_running_before_with_blocks(spark):
    rng = random.Random(5)
    rows = [("hot", i, rng.randint(0, 9)) for i in range(500)] + [("x", 7, 3), ("x", 900, 4)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    got = running_before(df, ["k"], F.floor(F.col("i") / 16), "i", F.col("v"), "before").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.before == sum(v for k, i, v in rows if k == r.k and i < r.i)


def test_salted_joins_keep_every_row(spark):
    big = spark.createDataFrame([("hot", i) for i in range(300)] + [("z", -1)], "k string, i int")
    small = spark.createDataFrame([("hot", "H"), ("unused", "U")], "k string, v string")
    inner = attach_by_key(big, small, ["k"], F.col("i"), salts=4).collect()
    left = attach_by_key_left(big, small, ["k"], F.col("i"), salts=4).collect()
    assert len(inner) == 300 and {r.v for r in inner} == {"H"}
    assert len(left) == 301 and sum(r.v is None for r in left) == 1


def test_first_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = first_n(df, ["k"], [F.col("id").desc()], 2, "rn")
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(r.id for r in best.collect()) == [994, 995, 996, 997, 998, 999]


@pytest.mark.parametrize("kind", ["uniform", "heavy", "constant", "single", "two"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(1)
    values = {
        "uniform": rng.uniform(0, 100, 3000),
        "heavy": np.concatenate([np.full(1500, 7.0), rng.lognormal(0, 3, 1500)]),
        "constant": np.full(50, 2.5),
        "single": np.array([4.0]),
        "two": np.array([1.0, 2.0]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
    probs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = {r.prob: r.quantile for r in exact_quantiles(df, "v", probs).collect()}
    assert len(got) == len(probs)
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).collect() == []


def test_vectors(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [-1.0, 0.0])],
        "a array<double>, b array<double>",
    )
    a, b = F.col("a"), F.col("b")
    got = df.select(cosine(a, b).alias("c"), blend(a, b).alias("m")).collect()
    assert [round(r.c, 12) for r in got] == [1.0, 0.0, -1.0]
    assert np.allclose(got[0].m, np.array([1.5, 3.0]) / np.linalg.norm([1.5, 3.0]))
    assert got[2].m == [0.0, 0.0]


def test_jaccard(spark):
    rows = [([], []), (["a"], []), (["a", "a", "b"], ["b", "c"]), (None, ["a"]), (["a"], ["a"])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = [r[0] for r in df.select(jaccard(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, 1 / 3, 0.0, 1.0]


def test_exact_tie_is_really_a_tie():
    assert Decimal(4.125) == Decimal("4.125") and round(4.125, 2) == 4.12
