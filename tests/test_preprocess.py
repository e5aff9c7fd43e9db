import dataclasses
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohort import (
    build_preprocessor,
    fit_preprocessor,
    get_feature_names_after_preprocessor,
    infer_columns,
    load_preprocessor,
    save_preprocessor,
    transform_df,
)
from cohort.operators import lookups
from cohort.operators.model import build_model
from cohort.operators.preprocess import all_null_columns

SCHEMA = "id long, n double, w int, none double, c string, b boolean, empty string, when date"


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (1, 1.0, 5, None, "x", True, None, None),
        (2, None, 5, None, "a.b c", False, None, None),
        (3, 4.0, 5, None, None, None, None, None),
        (4, 7.0, 5, None, "x", True, None, None),
        (5, float("nan"), 5, None, "a.b c", True, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def fitted(table):
    return fit_preprocessor(table, key="id")


def test_columns_by_type(table):
    assert infer_columns(table) == (["id", "n", "w", "none"], ["c", "b", "empty"])
    assert all_null_columns(table, ["n", "none", "c", "empty"]) == (["n", "c"], ["none", "empty"])


def test_names_follow_the_branches(fitted):
    assert get_feature_names_after_preprocessor(fitted) == [
        "n", "w", "none", "c_a.b c", "c_x", "b_False", "b_True", "empty_missing",
    ]


def test_values(table, fitted):
    out = transform_df(table, fitted, keep=["id"]).orderBy("id").toPandas()
    filled = np.array([1.0, 4.0, 4.0, 7.0, 4.0])
    assert np.allclose(out["n"], (filled - filled.mean()) / filled.std())
    assert out["w"].tolist() == out["none"].tolist() == [0.0] * 5
    # A tie between the two texts: the smaller one fills the gap.
    assert out["c_a.b c"].tolist() == [0, 1, 1, 0, 1]
    assert out["b_True"].tolist() == [1, 0, 1, 1, 1]
    assert out["empty_missing"].tolist() == [1.0] * 5


def test_three_forms_agree(table, fitted):
    wide = transform_df(table, fitted, keep=["id"]).toPandas().set_index("id")
    vectors = fitted.transform_vector(table, keep=["id"]).select("id", vector_to_array("features").alias("f"))
    for r in vectors.collect():
        assert r["f"] == pytest.approx(wide.loc[r["id"]].tolist())
    long = fitted.transform_long(table, key="id").toPandas()
    pivot = long.pivot(index="id", columns="feature", values="value").reindex(columns=wide.columns).fillna(0.0)
    assert np.allclose(pivot, wide)


def test_unseen_values(spark, fitted):
    later = spark.createDataFrame([(9, 4.0, 6, 3.5, "new", None, "real", None)], SCHEMA)
    row = transform_df(later, fitted).first()
    assert (row["none"], row["w"]) == (3.5, 1.0)
    assert row["c_x"] == row["c_a.b c"] == row["empty_missing"] == 0.0
    vector = fitted.transform_vector(later).first()["features"]
    assert list(vector.toArray()) == pytest.approx(list(row))


def test_save_and_load(spark, table, fitted, tmp_path):
    save_preprocessor(fitted, str(tmp_path / "p"))
    again = load_preprocessor(spark, str(tmp_path / "p"))
    assert again.feature_names() == fitted.feature_names()
    assert transform_df(table, again).collect() == transform_df(table, fitted).collect()


@pytest.mark.parametrize("bound, hot", [(0, 1e-4), (0, 0.2), (0, 2.0), (1 << 20, 1e-4)])
def test_joins_of_all_kinds_give_the_same_entries(spark, table, fitted, monkeypatch, bound, hot):
    # All hot, some hot, none hot, broadcast; with Spark's own broadcasts off.
    monkeypatch.setattr(lookups, "HOT_SHARE", hot)
    later = table.unionByName(table.withColumn("c", F.lit("never seen")))
    want = [tuple(r)[1:] for r in fitted.transform_df(later, keep=["id"]).collect()]
    model = dataclasses.replace(fitted, broadcast_bytes=bound)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = model.transform_vector(later, keep=["id"]).select(vector_to_array("features")).collect()
        assert sorted(tuple(r[0]) for r in got) == sorted(want)
        long = model.transform_long(later, key="id")
        assert long.count() == sum(x != 0 for r in want for x in r)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_rows_are_spread(spark):
    rows = spark.range(4_000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("c"))
    model = dataclasses.replace(fit_preprocessor(rows, numeric_cols=[], categorical_cols=["c"]), broadcast_bytes=0)
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = model.transform_long(rows, key="id")
        sizes = out.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert sizes.sum() == 4_000 and sizes.max() < 1_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])


def test_training_with_more_than_100_000_categories(spark):
    n = 100_001
    rows = spark.range(n).select(
        "id", F.concat(F.lit("c"), "id").alias("name"), (F.col("id") % 5).cast("double").alias("x"),
        (F.col("id") % 5 > 2).cast("int").alias("y"),
    )
    fitted = fit_preprocessor(rows, target="y", key="id")
    assert (fitted.size, fitted.feature_table().count()) == (n, n + 1)
    vectors = fitted.transform_vector(rows, keep=["y"])
    first = vectors.first()["features"]
    assert first.size == n + 1 and first.numNonzeros() == 2
    forest = build_model(vectors, label="y", n_estimators=1, max_depth=1, max_features="all", max_samples=2_000)
    assert forest.numFeatures == n + 1 and forest.featureImportances.indices.tolist() == [0]


def test_many_columns_need_no_option(spark):
    rows = spark.range(1_200).select("id", F.concat(F.lit("v"), "id").alias("c"))
    model = fit_preprocessor(rows, numeric_cols=[], categorical_cols=["c"])
    assert len(transform_df(rows, model, keep=["id"]).columns) == 1_201
    with pytest.raises(ValueError, match="exceed"):
        transform_df(rows, model, max_columns=1_000)


def test_width_limit(table, fitted):
    with pytest.raises(ValueError, match="exceed"):
        fitted.transform_df(table, max_columns=3)


def test_refusals(spark, table, fitted):
    with pytest.raises(ValueError, match="missing"):
        transform_df(table.drop("n"), fitted)
    with pytest.raises(ValueError, match="no columns"):
        fit_preprocessor(table.select("when"))
    with pytest.raises(ValueError, match="missing"):
        fit_preprocessor(table, numeric_cols=["absent"], categorical_cols=[])
    with pytest.raises(ValueError, match="infinite"):
        fit_preprocessor(spark.createDataFrame([(math.inf,), (1.0,)], "x double"))


def test_target_and_key_are_not_features(table):
    model = fit_preprocessor(table.withColumn("n_1", F.lit(1)), target="n", key="id")
    assert model.input_columns == ["w", "none", "c", "b", "empty"]


def test_builder_takes_explicit_columns(table):
    model = build_preprocessor(numeric_cols=["n"], categorical_cols=["c"]).fit(table)
    assert model.feature_names() == ["n", "c_a.b c", "c_x"]


def test_fit_on_large_path_equals_small_path(spark, monkeypatch):
    frame = pd.DataFrame({"x": np.random.default_rng(2).normal(size=900), "y": np.arange(900) % 4})
    frame.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(frame)
    small = fit_preprocessor(df).numeric
    from cohort.operators import numbers

    monkeypatch.setattr(numbers.summarize_numbers, "__kwdefaults__",
                        {**numbers.summarize_numbers.__kwdefaults__, "fetch_rows": 30, "accuracy": 40})
    assert fit_preprocessor(df).numeric == small
