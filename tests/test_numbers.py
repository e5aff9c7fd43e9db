"""Exact quantiles at any size: the bounded search against numpy."""

import numpy as np
import pytest

from cohort.operators.numbers import exact_quantiles, summarize_numbers

LEVELS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]

rng = np.random.default_rng(11)
CASES = {
    "spread": rng.normal(size=3_000),
    "heavy": np.concatenate([np.full(1_500, 4.0), rng.normal(4, 1, 1_500)]),
    "few values": rng.integers(0, 3, 2_000).astype(float),
    "outliers": np.concatenate([rng.random(2_000), [1e300, -1e300]]),
    "constant": np.full(300, 2.5),
    "single": np.array([7.0]),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("fetch_rows", [5, 400])
def test_search_finds_exact_quantiles(spark, name, fetch_rows):
    values = CASES[name]
    rows = [(float(v),) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double").repartition(5)
    got = exact_quantiles(df, "x", LEVELS, fetch_rows=fetch_rows, accuracy=20)
    assert np.allclose(got, np.quantile(values, LEVELS), rtol=1e-12, atol=0)
    assert exact_quantiles(df, "x", LEVELS) == pytest.approx(got, rel=1e-12)


def test_summary_of_several_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5), (3.0, None, 5), (None, None, 8)], "a double, b double, c int")
    for fetch_rows in (1, 100):
        found = summarize_numbers(df, ["a", "b", "c"], [0.5], fetch_rows=fetch_rows)
        assert (found["a"].present, found["a"].missing, found["a"].mean, found["a"].quantiles[0.5]) == (2, 1, 2.0, 2.0)
        assert found["a"].std_samp == pytest.approx(2**0.5)
        assert (found["b"].present, found["b"].quantiles[0.5], found["b"].std_samp) == (0, None, None)
        assert found["c"].quantiles[0.5] == 5.0


def test_approximate_mode_and_bad_mode(spark):
    df = spark.range(1_000).selectExpr("cast(id as double) as x")
    assert abs(summarize_numbers(df, ["x"], [0.5], method="approx")["x"].quantiles[0.5] - 500) <= 2
    with pytest.raises(ValueError):
        summarize_numbers(df, ["x"], [0.5], method="guess")


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]


def test_tied_edges_stay_exact(spark):
    df = spark.range(1237).selectExpr("IF(id % 2 = 0, 7.7, id * 1.0) AS x").selectExpr("CAST(x AS double) x")
    steps = [k / 10 for k in range(11)]
    expected = df.selectExpr(f"percentile(x, array({','.join(map(str, steps))}))").first()[0]
    assert exact_quantiles(df, "x", steps, fetch_rows=10) == exact_quantiles(df, "x", steps) == expected
