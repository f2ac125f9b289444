import numpy as np
import pytest

from martworks.operators.trim import exact_quantiles, quantile_trim


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_exact_quantiles_match_numpy_through_narrowing(spark, seed):
    rng = np.random.default_rng(seed)
    vals = list(rng.normal(size=3000).round(3))
    vals += [0.25] * 1500  # a heavy hitter: a third of the rows
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "v double")
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, "v", probs)
    want = np.quantile(np.array(vals), probs)
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_quantile_trim_bounds_and_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)] + [(None,)], "t double")
    out = [r["t"] for r in quantile_trim(df, "t", 0.05, 0.95).collect()]
    lo, hi = np.quantile(np.arange(1, 101), [0.05, 0.95])
    assert min(out) >= lo and max(out) <= hi
    assert len(out) == sum(1 for i in range(1, 101) if lo <= i <= hi)


def test_quantile_trim_empty(spark):
    df = spark.createDataFrame([(None,)], "t double")
    assert quantile_trim(df, "t").count() == 0


def test_exact_quantiles_with_infinities(spark):
    vals = [1.0, 2.0, 3.0, float("inf"), float("-inf"), 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.25, 0.5, 0.75]
    # sorted: -inf 1 2 2 3 inf; positions 0, 1.25, 2.5, 3.75 (numpy's interpolation
    # formula turns the exact order statistic -inf at q=0 into nan)
    want = ["-inf", "1.25", "2.0", "2.75"]
    got = exact_quantiles(df, "v", probs)
    assert [str(x) for x in got] == want


def test_exact_quantiles_of_unevenly_spaced_values(spark):
    rng = np.random.default_rng(4)
    vals = np.concatenate([10 ** rng.uniform(-12, 12, 4000), -(10 ** rng.uniform(-3, 9, 2000))])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(4)
    probs = [0.0, 0.01, 0.333, 0.5, 0.95, 1.0]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles", "")
    got = exact_quantiles(df, "v", probs)
    n = len(jobs.getJobIdsForGroup("quantiles"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert np.allclose(got, np.quantile(vals, probs), rtol=1e-12, atol=0)
    assert n <= 10
