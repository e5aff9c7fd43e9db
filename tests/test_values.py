"""Column expressions, with pandas as the second opinion."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import NULL_MARKERS, band, log1p, quantile_bin, ratio, square_root, to_number, to_token
from cohort.operators.clean import (
    basic_cleanup,
    coerce_numeric,
    count_copies,
    ensure_id,
    normalize_names,
    number_rows,
    standardize_strings,
)
from cohort.operators.features import REGISTRY, IncomeFeatures, build_features, drop_target_columns
from cohort.operators.groups import GroupFill, global_mode, group_modes
from cohort.operators.profile import assert_no_nulls, corr_matrix, histogram, schema_profile, value_counts


def one(spark, value, expression, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


def test_numbers_like_pandas(spark):
    texts = [
        "12", " 12 ", "1e3", "1E-2", ".5", "5.", "+7", "-3.25", "inf", "-inf", "Infinity",
        "1d", "5f", "1,000", "0x10", "", " ", "abc", "1_000", "--1", "1e", "nan", None, "\t8\n",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = {r["i"]: r["v"] for r in df.select("i", to_number(F.col("x"), T.StringType()).alias("v")).collect()}
    expected = pd.to_numeric(pd.Series(texts), errors="coerce")
    for i, e in enumerate(expected):
        assert got[i] == e if not math.isnan(e) else got[i] is None, texts[i]


def test_tokens_strip_all_whitespace(spark):
    for text, want in [("  Female ", "female"), ("\t A b　", "a b"), ("  ", None), (None, None)]:
        assert one(spark, text, to_token, "string") == want


@pytest.mark.parametrize("lowest", [True, False])
def test_bands_like_pandas(spark, lowest):
    edges, labels = [0, 1, 5, 10, 20, math.inf], ["none", "ultra", "light", "med", "heavy"]
    values = [-1.0, 0.0, 0.5, 1.0, 1.5, 5.0, 5.1, 10.0, 20.0, 20.5, 1e9, math.inf, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(band(F.col("x"), edges, labels, include_lowest=lowest)).collect()]
    cut = pd.cut(pd.Series(values, dtype=float), edges, labels=labels, include_lowest=lowest)
    assert got == [None if v is np.nan or v != v else v for v in cut.astype(object)]


def test_math_is_total(spark):
    assert one(spark, -1.0, log1p) == -math.inf
    assert one(spark, -2.0, log1p) is None
    assert one(spark, -1.0, square_root) is None
    assert one(spark, 0.0, lambda x: ratio(F.lit(2.0), x)) == math.inf
    assert one(spark, 0.0, lambda x: ratio(F.lit(-2.0), x)) == -math.inf
    assert one(spark, 0.0, lambda x: ratio(x, x)) is None
    assert one(spark, None, lambda x: ratio(F.lit(1.0), x)) is None


def test_deciles_like_pandas(spark):
    rng = np.random.default_rng(7)
    for values in (rng.integers(0, 12, 500).astype(float), rng.normal(size=501), np.ones(20)):
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, annual_income_usd double")
        fitted = IncomeFeatures.fit(df)
        got = df.select("i", quantile_bin(F.col("annual_income_usd"), fitted.edges).alias("b")).orderBy("i")
        got = [r["b"] for r in got.collect()]
        try:
            want = pd.qcut(pd.Series(values), 10, labels=False, duplicates="drop").tolist()
        except ValueError:
            want = [None] * len(values)
        assert got == [None if w is None or w != w else w for w in want]


def income_row(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "annual_income_usd double")


def test_income_edges(spark):
    single = REGISTRY.get("income_features").apply(income_row(spark, 40_000.0)).first()
    assert (single["income_z"], single["income_decile"], single["income_band"]) == (0.0, None, "25–50k")
    flat = REGISTRY.get("income_features").apply(income_row(spark, 5.0, 5.0, 5.0)).collect()
    assert all(r["income_decile"] is None and r["income_z"] == 0.0 for r in flat)
    empty = REGISTRY.get("income_features").apply(income_row(spark, None, None)).collect()
    assert all(v is None for r in empty for v in r)
    low = REGISTRY.get("income_features").apply(income_row(spark, -1.0, -2.0, float("nan"))).collect()
    assert [r["log_income"] for r in low] == [-math.inf, None, None]


def test_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["  Annual  Income USD ", "Gender"])
    assert normalize_names(df).columns == ["annual_income_usd", "gender"]
    with pytest.raises(ValueError, match="a_b"):
        normalize_names(spark.createDataFrame([(1, 2)], ["A b", "a_b"]))


def test_cleanup_keeps_columns_it_does_not_know(spark):
    df = spark.createDataFrame([("7", " X "), ("7", " X ")], ["BMI", "Other"])
    out = basic_cleanup(df)
    assert out.columns == ["id", "bmi", "other"]
    assert [tuple(r) for r in out.collect()] == [(1, 7.0, " X ")]
    assert coerce_numeric(df).columns == standardize_strings(df).columns == df.columns


def test_copies_count_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "x int, y string")
    assert tuple(count_copies(df).first()) == (3, 2, 1)
    assert tuple(count_copies(df.limit(0)).first()) == (0, 0, 0)


@pytest.mark.parametrize("order_by", [None, ["x"], []])
def test_row_numbers_are_dense(spark, order_by):
    # One value holds most rows: the order key alone cannot split it.
    df = spark.range(5_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("x"), "id")
    out = number_rows(df.repartition(7), "n", order_by=order_by, start=1).toPandas()
    assert sorted(out["n"]) == list(range(1, 5_001))
    if order_by is None:
        assert out.sort_values(["x", "id"])["n"].tolist() == list(range(1, 5_001))
    assert ensure_id(df).columns == ["x", "id"]


def test_target_prefix_rule(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["smokes", "smokes_per_day", "smokesx", "bmi"])
    assert drop_target_columns(df, "smokes").columns == ["smokesx", "bmi"]
    assert drop_target_columns(df, None).columns == df.columns


def test_mode_ties_and_missing_keys(spark):
    rows = [("a", "z"), ("a", "b"), ("a", None), (None, "q"), (None, "q"), (None, "q"), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    assert {tuple(r) for r in group_modes(df, "v", ["k"]).collect()} == {("a", "b"), ("c", None)}
    assert global_mode(df, "v").first()[0] == "q"
    assert global_mode(df.limit(0), "v").first()[0] is None
    filled = GroupFill.fit(df, "v", ["k"]).transform(df)
    assert sorted(tuple(map(str, r)) for r in filled.collect()) == sorted(
        [("a", "z"), ("a", "b"), ("a", "b"), ("None", "q"), ("None", "q"), ("None", "q"), ("c", "q")]
    )


@pytest.mark.parametrize("hot_share", [1e-4, 0.05, 1.0])
def test_fill_without_broadcast_is_the_same(spark, monkeypatch, hot_share):
    from cohort.operators import groups

    monkeypatch.setattr(groups, "HOT_SHARE", hot_share)
    rng = np.random.default_rng(3)
    n = 4_000
    frame = pd.DataFrame(
        {
            "i": np.arange(n),
            # A third of the rows share one key.
            "k1": [None if r < 0.05 else "hot" if r < 0.4 else f"g{int(r * 400)}" for r in rng.random(n)],
            "k2": rng.integers(0, 3, n).astype(float),
            "v": [None if r < 0.3 else float(int(r * 10)) for r in rng.random(n)],
        }
    )
    frame.loc[frame["i"] % 17 == 0, "k2"] = np.nan
    df = spark.createDataFrame(frame, "i long, k1 string, k2 double, v double")
    by_broadcast = GroupFill.fit(df, "v", ["k1", "k2"])
    by_shuffle = GroupFill.fit(df, "v", ["k1", "k2"], broadcast_bytes=0)
    assert by_broadcast.small and not by_shuffle.small
    a = {r["i"]: r["v"] for r in by_broadcast.transform(df).collect()}
    b = {r["i"]: r["v"] for r in by_shuffle.transform(df).collect()}

    def mode(s):
        m = s.mode()
        return m.iloc[0] if len(m) else np.nan

    want = frame["v"].fillna(frame.groupby(["k1", "k2"])["v"].transform(mode)).fillna(mode(frame["v"]))
    assert a == b == dict(zip(frame["i"], want))


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = schema_profile(df).collect()
    assert [(r["column"], r["non_null"], r["nulls"], r["null_pct"]) for r in rows] == [
        ("a", 0, 0, None), ("b", 0, 0, None),
    ]
    assert histogram(df, "a").count() == 0


def test_null_percentage_rounds_half_even(spark):
    df = spark.range(800).select(F.when(F.col("id") > 0, F.col("id")).alias("x"))
    assert schema_profile(df).first()["null_pct"] == 0.12  # 0.125


def test_no_null_assertion(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    with pytest.raises(AssertionError, match="b"):
        assert_no_nulls(df)
    assert assert_no_nulls(df.select("a")).count() == 2


def test_value_counts_include_missing(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "x string")
    assert [tuple(r) for r in value_counts(df, "x").collect()] == [("a", 2), (None, 1)]


def test_histogram_like_numpy(spark):
    values = np.random.default_rng(1).normal(size=1_000)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert [r["count"] for r in histogram(df, "x", 7).orderBy("bin").collect()] == np.histogram(values, 7)[0].tolist()


def test_marker_list_is_what_pandas_reads_as_missing(tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("x,y\n" + "".join(f"{m},1\n" for m in NULL_MARKERS) + "none,1\nNone.,1\nNan,1\n")
    assert pd.read_csv(path)["x"].isna().sum() == len(NULL_MARKERS)


def test_build_features_keeps_the_key_and_skips_what_it_cannot_build(spark):
    df = spark.createDataFrame([(9, "n", 30_000.0)], "id long, name string, annual_income_usd double")
    out = build_features(df, key="id")
    assert out.columns == ["id", "annual_income_usd", "income_band", "log_income", "income_z", "income_decile"]
    assert build_features(df).columns[0] == "annual_income_usd"


def test_histogram_counts_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, inf, -inf, inf, None, float("nan"))], "x double")
    got = [tuple(r) for r in histogram(df, "x", 2).orderBy("bin").collect()]
    assert got == [(-1, -inf, -inf, 1), (0, 1.0, 2.0, 1), (1, 2.0, 3.0, 2), (2, inf, inf, 2)]
    assert [tuple(r) for r in histogram(df.where("x > 5"), "x", 2).collect()] == [(2, inf, inf, 2)]


def test_correlations_of_pairs_with_gaps(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, None), (3.0, None, 5.0), (4.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["x"], r["y"]): r["corr"] for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert list(got) and len(got) == 6 and got["b", "c"] is None
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 1, 7])[0, 1]) and got["a", "a"] == 1.0
