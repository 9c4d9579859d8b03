"""Stored sums and sketches against full recomputation."""

import random

import numpy as np
import pytest

from attesta.operators import increments

SCHEMA = "company string, report_year int, confidence double, computed_score int"


def rows(n, seed):
    rng = random.Random(seed)
    return [(rng.choice("ab"), 2000 + rng.randrange(6), rng.random(), rng.randrange(13)) for _ in range(n)]


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "sums")


def plain_fit(records, company):
    x = np.array([r[2] for r in records if r[0] == company and r[2] is not None and r[3] is not None])
    y = np.array([r[3] for r in records if r[0] == company and r[2] is not None and r[3] is not None], float)
    slope, intercept = np.polyfit(x, y, 1)
    left = ((y - intercept - slope * x) ** 2).sum()
    return len(x), slope, intercept, np.corrcoef(x, y)[0, 1], np.sqrt(left / (len(x) - 2))


def test_appended_years_equal_a_full_fit(spark, path):
    records = rows(900, 1) + [("a", 2001, None, 4), ("b", 2002, 0.4, None)]
    for years in ({2000, 2001, 2002, 2003}, {2004}, {2005}, {2005}):  # the last run is repeated
        new = spark.createDataFrame([r for r in records if r[1] in years], SCHEMA)
        increments.store_years(increments.year_sums(new), path)
    stored = increments.stored_years(spark, path)
    assert stored.count() == 12
    for r in increments.fit_from_sums(stored).collect():
        n, slope, intercept, correlation, se = plain_fit(records, r.company)
        assert r.n == n
        assert np.allclose([r.slope, r.intercept, r.correlation, r.residual_se], [slope, intercept, correlation, se])


def test_a_corrected_year_replaces_itself_only(spark, path):
    records = rows(600, 2)
    increments.store_years(increments.year_sums(spark.createDataFrame(records, SCHEMA)), path)
    corrected = [(c, y, x, 12 - s) if y == 2003 else (c, y, x, s) for c, y, x, s in records]
    new = spark.createDataFrame([r for r in corrected if r[1] == 2003], SCHEMA)
    increments.store_years(increments.year_sums(new), path)
    for r in increments.fit_from_sums(increments.stored_years(spark, path)).collect():
        assert np.allclose(r.slope, plain_fit(corrected, r.company)[1])


def test_degenerate_fits(spark, path):
    records = [("one", 2000, 0.5, 3), ("flat", 2000, 0.5, 3), ("flat", 2001, 0.5, 4), ("flat", 2002, 0.5, 5)]
    increments.store_years(increments.year_sums(spark.createDataFrame(records, SCHEMA)), path)
    fits = {r.company: r for r in increments.fit_from_sums(increments.stored_years(spark, path)).collect()}
    assert fits["one"].slope is None and fits["one"].n == 1 and fits["flat"].slope is None
    empty = spark.createDataFrame([], SCHEMA)
    assert increments.fit_from_sums(increments.year_sums(empty)).collect() == []


@pytest.mark.parametrize("size, bound", [(64, 0.06), (1024, 0.01)])
def test_merged_sketches_keep_their_rank_error(spark, path, size, bound):
    rng = random.Random(3)
    records = [("a", 2000 + i % 6, 0.5, int(rng.gauss(0, 1) * 10_000)) for i in range(20_000)]
    frame = spark.createDataFrame(records, SCHEMA)
    increments.store_years(increments.year_sums(frame, size=size), path)
    found = increments.quantiles_from_sketches(increments.stored_years(spark, path), [0.01, 0.25, 0.5, 0.9], size=size)
    errors = increments.rank_error(frame, found, "computed_score").collect()
    assert len(errors) == 4 and all(r.error <= bound and r.n == 20_000 for r in errors)


def test_equal_values_meet_the_quantiles_once(spark):
    values = spark.createDataFrame([("a", 1)] * 6 + [("a", 2)] * 3 + [("a", None), ("b", 5)], "company string, v int")
    asked = spark.createDataFrame(
        [("a", 0.25, 1.0), ("a", 0.5, 2.0), ("a", 0.9, 3.0)], "company string, prob double, quantile double"
    )
    errors = {r.prob: (r.n, round(r.error, 6)) for r in increments.rank_error(values, asked, "v").collect()}
    assert errors == {0.25: (10, 0.0), 0.5: (10, 0.1), 0.9: (10, 0.0)}


def test_stored_runs_and_ranks_read_the_scores_once(spark, monkeypatch):
    """Four readers of the scores (three runs, the ranks) share one stored copy."""
    from attesta.plans.catalog import QUERIES, files

    made, first = [], files.stored_scores
    monkeypatch.setattr(files, "stored_scores", lambda t: made.append(first(t)) or made[-1])
    sketches = QUERIES["table_score_sketches"](spark, "/root/testdata/sf0.001")
    assert len(made) == 1
    assert "lineitem" not in sketches._jdf.queryExecution().executedPlan().toString()
