import math

import pytest
from pyspark.sql import functions as F

import cohort
from cohort.checks.fixtures import population, raw_population
from cohort.operators.model import feature_vector, forbid_target, pick_id, require_target
from cohort.sources.tables import load_metrics, read_csv

TARGET = "has_health_issues"


@pytest.fixture(scope="module")
def table(spark, folder):
    return cohort.build_features(population(spark, folder), key="id").persist()


@pytest.fixture(scope="module")
def training(table):
    return cohort.train_model(table, target=TARGET, n_estimators=10)


def test_training(table, training):
    assert training.metrics["support"]["n"] == math.ceil(0.2 * table.count())
    assert set(training.metrics) == {
        "accuracy", "precision", "recall", "f1", "confusion_matrix", "support", "roc_auc", "log_loss",
    }
    assert training.model.getNumTrees == 10
    assert training.train.count() + training.test.count() == table.count()
    assert not any(n.startswith(TARGET) or n == "id" for n in training.feature_names)
    again = cohort.train_model(table.repartition(3), target=TARGET, n_estimators=10)
    assert again.test.select("id").exceptAll(training.test.select("id")).isEmpty()


def test_a_table_of_one_task_is_trained_by_all_cores(spark, table):
    one = table.coalesce(1)
    found = cohort.train_model(one, target=TARGET, n_estimators=2)
    assert found.train.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_evaluation_uses_the_same_rows(training):
    found = cohort.evaluate(training.model, training.test)
    assert found["n_samples"] == training.metrics["support"]["n"]
    for name in ("accuracy", "f1", "roc_auc", "confusion_matrix"):
        assert found[name] == training.metrics[name]


def test_prediction(table, training):
    out = cohort.predict_df(table, training.model, preprocessor=training.preprocessor, target=TARGET)
    assert out.columns == ["id", "pred", "proba_1"]
    row = out.agg(
        F.count("*"), F.countDistinct("id"), F.min("proba_1"), F.max("proba_1"),
        F.count_if((F.col("proba_1") > 0.5) != (F.col("pred") == 1)),
    ).first()
    assert row[0] == row[1] == table.count()
    assert 0 <= row[2] < row[3] <= 1 and row[4] == 0
    no_key = table.drop("id")
    numbered = cohort.predict_df(no_key, training.model, preprocessor=training.preprocessor, proba=False)
    assert numbered.columns == ["row_id", "pred"]
    assert numbered.agg(F.min("row_id"), F.max("row_id")).first() == (0, table.count() - 1)


def test_importances(spark, training):
    ranked = cohort.feature_importances(spark, training.model, training.feature_names).collect()
    values = [r["importance"] for r in ranked]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1.0)
    assert {r["feature"] for r in ranked} == set(training.feature_names)
    by_place = cohort.feature_importances(spark, training.model, ["one"]).collect()
    assert {r["feature"] for r in by_place} == {str(i) for i in range(len(ranked))}
    assert cohort.feature_importances(spark, object()) is None


def test_numeric_table_needs_no_preprocessor(spark):
    df = spark.range(300).select("id", (F.col("id") % 7).alias("x"), (F.col("id") % 7 > 3).alias("y"))
    found = cohort.train_model(df, target="y", fit_on=None, n_estimators=3, class_weight=None, max_samples=150)
    assert found.feature_names == ["x"] and found.metrics["accuracy"] == 1.0
    out = cohort.predict_df(df, found.model, target="y")
    assert out.where("proba_1 >= 0.5").count() == df.where("y").count()


def test_prediction_reads_the_columns_of_the_training(spark, tmp_path):
    row = F.col("id")
    df = spark.range(400).select(
        "id", (row % 5).alias("y_x"), (row % 7).alias("a"), (row % 7 > 3).alias("y"), (row % 3).alias("b")
    )
    found = cohort.train_model(df, target="y", fit_on=None, n_estimators=20)
    assert found.feature_names == ["a", "b"] and found.metrics["accuracy"] == 1.0
    cohort.save_model(found.model, str(tmp_path / "m"))
    moved = df.select("id", "b", "y_x", "a", "y")
    for model in (found.model, cohort.load_model(str(tmp_path / "m"))):
        out = cohort.predict_df(moved, model, target="y").join(df, "id")
        assert out.where((F.col("pred") == 1) != F.col("y")).isEmpty()
        with pytest.raises(ValueError, match="missing"):
            cohort.predict_df(moved.drop("a"), model, target="y")
    cohort.save_interim(moved, str(tmp_path / "t"))
    scores = cohort.evaluate_file(
        spark, str(tmp_path / "t"), str(tmp_path / "m"), str(tmp_path / "s"), target="y"
    )
    assert scores["accuracy"] == 1.0
    with pytest.raises(FileNotFoundError):
        cohort.load_model(str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        cohort.load_preprocessor(spark, str(tmp_path / "none"))


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert {r["label"]: r["weight"] for r in cohort.class_weights(df, "y").collect()} == {0: 8 / 12, 1: 2.0}


def test_guards(spark, table, training):
    with pytest.raises(KeyError, match="no target column"):
        require_target(table, "nope")
    with pytest.raises(ValueError, match="must not"):
        forbid_target(table, TARGET)
    with pytest.raises(ValueError, match="empty"):
        cohort.train_model(table.limit(0), target=TARGET)
    with pytest.raises(ValueError, match="empty"):
        cohort.predict_df(table.limit(0), training.model, preprocessor=training.preprocessor)
    with pytest.raises(ValueError, match="no feature"):
        feature_vector(spark.createDataFrame([(1, "a")], "id long, s string"), None, keep=["id"])
    with pytest.raises(ValueError, match="class_weight"):
        cohort.build_model(training.train, class_weight="other")
    assert pick_id(table) == "id"
    assert pick_id(spark.createDataFrame([(1, 2)], ["index", "ID"])) == "ID"
    assert pick_id(spark.createDataFrame([(1,)], ["Id"])) is None


def test_training_names_what_is_wrong_with_the_table(spark, table):
    for change, said in (
        (("id", F.when(F.col("id") % 7 > 0, F.col("id"))), "missing values"),
        ((TARGET, F.col(TARGET) + 1), "0/1"),
        ((TARGET, F.when(F.col("id") % 7 > 0, F.col(TARGET))), "0/1"),
    ):
        with pytest.raises(ValueError, match=said):
            cohort.train_model(table.withColumn(*change), target=TARGET, fit_on=None, n_estimators=1)


def test_from_raw_file_to_predictions(spark, folder, tmp_path):
    path = {n: str(tmp_path / n) for n in (
        "raw", "interim", "features", "prep", "matrix", "model", "m1", "m2", "imp", "pred", "prep2",
    )}
    cohort.write_csv(raw_population(spark, folder), path["raw"])
    interim = cohort.make_interim(spark, path["raw"], path["interim"])
    assert interim.count() == population(spark, folder).count()
    features = cohort.make_features(spark, path["interim"], path["features"], target=TARGET)
    assert {"id", TARGET, "income_band"} <= set(features.columns)
    model = cohort.make_matrix(spark, path["features"], path["prep"], output_csv=path["matrix"], target=TARGET)
    matrix = read_csv(spark, path["matrix"])
    assert matrix.columns == ["id", *model.feature_names()]
    assert matrix.count() == features.count()
    base = cohort.make_matrix(
        spark, path["features"], path["prep2"], mode="fit", target=TARGET, fit_on="interim", interim=path["interim"]
    )
    assert base.input_columns == ["annual_income_usd", "gender", "education_level"]
    trained = cohort.train_file(
        spark, path["features"], path["model"], path["m1"],
        target=TARGET, preprocessor_path=path["prep"], n_estimators=5,
    )
    found = cohort.evaluate_file(
        spark, path["features"], path["model"], path["m2"],
        target=TARGET, preprocessor_path=path["prep"], importances_csv=path["imp"],
    )
    assert load_metrics(spark, path["m1"])["accuracy"] == trained.metrics["accuracy"] == found["accuracy"]
    assert read_csv(spark, path["imp"]).columns == ["feature", "importance"]
    cohort.predict_file(
        spark, path["features"], path["model"], path["pred"], preprocessor_path=path["prep"], target=TARGET
    )
    assert read_csv(spark, path["pred"]).count() == features.count()
    with pytest.raises(FileNotFoundError):
        cohort.predict_file(spark, path["features"], path["m1"] + "x", path["pred"])
    with pytest.raises(ValueError, match="drop_target"):
        cohort.make_features(spark, path["interim"], path["features"], drop_target=True)
    with pytest.raises(ValueError, match="mode"):
        cohort.make_matrix(spark, path["features"], path["prep"], mode="guess")
