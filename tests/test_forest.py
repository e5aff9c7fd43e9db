import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohort.operators import forest, model, statistics
from cohort.operators.numbers import summarize_numbers
from cohort.operators.preprocess import fit_preprocessor

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(4_000, numPartitions=4).select(
        "id", F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(3) * 5).cast("int").cast("double").alias("c"),
        F.lit(0.0).alias("d"), F.rand(4).alias("e"),
    )
    label = (F.rand(5) < 0.1 + 0.5 * F.col("a") + 0.08 * F.col("c")).cast("int")
    df = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df.withColumn("label", label))
    return df.select("id", "label", "features").persist()


def grown(rows, **options):
    options = {"n_estimators": 8, "key": "id", **options}
    return model.build_model(rows, **options)


def by_hand(x, y, times, weights, width):
    """(feature, value below the cut) of the best first split, row by row."""
    best = (-1.0, None)
    total = times * weights[y]

    def gini(of):
        w = total[of].sum()
        p = total[of & (y == 1)].sum() / w
        return w, 2 * p * (1 - p)

    everything, impurity = gini(np.ones(len(y), bool))
    for f in range(width):
        for cut in forest.cuts_of(x[:, f], weights[y], 31):
            left = (x[:, f] <= cut) & (times > 0)
            right = (x[:, f] > cut) & (times > 0)
            if left.any() and right.any():
                (wl, gl), (wr, gr) = gini(left), gini(right)
                gain = impurity - (wl * gl + wr * gr) / everything
                if gain > best[0] + 1e-12:
                    best = (gain, (f, cut))
    return best


def test_mllib_trains_only_a_model_of_one_tree(rows, monkeypatch):
    asked = []
    fit = forest.RandomForestClassifier.fit
    monkeypatch.setattr(
        forest.RandomForestClassifier, "fit", lambda self, df: (asked.append((self.getNumTrees(), df.count())), fit(self, df))[1]
    )
    assert grown(rows).getNumTrees == 8 and asked == [(1, 2)]


def test_first_splits_are_those_found_row_by_row(rows):
    found = grown(rows, n_estimators=3, max_depth=1, max_features="all")
    local = rows.select(F.xxhash64("id").alias("row"), "label", vector_to_array("features").alias("x")).toPandas()
    x, y = np.array(local["x"].tolist()), local["label"].to_numpy()
    weights = len(y) / (2 * np.bincount(y))
    times = forest.draws(local["row"].to_numpy().view(np.uint64), 0, 42, forest.poisson_table(1.0))
    for number, tree in enumerate(found.trees):
        gain, (feature, cut) = by_hand(x, y, times[:, number].astype(float), weights, x.shape[1])
        root = tree._call_java("rootNode")
        assert (root.split().featureIndex(), root.gain()) == (feature, pytest.approx(gain))
        assert root.split().threshold() == pytest.approx(cut)
        assert root.impurityStats().rawCount() == times[:, number].sum()


def test_a_forest_does_not_depend_on_how_rows_are_stored(rows):
    one, other = (grown(df).toDebugString.split("\n", 1)[1] for df in (rows, rows.repartition(7)))
    assert one == other


def test_a_forest_is_as_good_as_that_of_mllib(rows, monkeypatch):
    own = grown(rows, n_estimators=60)
    monkeypatch.setattr(model, "can_grow", lambda *a: False)
    mllib = grown(rows, n_estimators=60)
    ours, theirs = (model.evaluate(m, rows)["roc_auc"] for m in (own, mllib))
    assert ours == pytest.approx(theirs, abs=0.01)
    assert own.featureImportances.toArray() == pytest.approx(mllib.featureImportances.toArray(), abs=0.06)


def test_scores_are_those_of_the_model(rows):
    for options in ({"n_estimators": 9}, {"n_estimators": 3, "max_depth": 8}, {"n_estimators": 2, "max_depth": 0}):
        found = grown(rows, **options)
        assert forest.can_score(found)
        told = found.transform(rows).select("id", F.col("prediction").alias("p"), vector_to_array("probability")[1].alias("s"))
        both = model.score(found, rows, keep=["id"]).join(told, "id")
        assert both.count() == rows.count() and both.where("pred <> p or score <> s").isEmpty()


def test_several_passes_and_one_find_the_same(rows, monkeypatch):
    once = grown(rows).toDebugString.split("\n", 1)[1]
    monkeypatch.setattr(forest, "CELLS_PER_PASS", 500)
    assert grown(rows).toDebugString.split("\n", 1)[1] == once


def test_deep_trees_are_left_to_mllib(rows):
    found = grown(rows.limit(300), n_estimators=2, max_depth=10)
    assert found.getNumTrees == 2 and not forest.can_score(found)


def test_draws_are_poisson():
    times = forest.draws(np.arange(100_000, dtype=np.uint64), 3, 42, forest.poisson_table(1.0))
    assert times.mean(axis=0) == pytest.approx(1, abs=0.02) and times.var(axis=0) == pytest.approx(1, abs=0.03)
    assert abs(np.corrcoef(times.T) - np.eye(4)).max() < 0.02
    assert not (times == forest.draws(np.arange(100_000, dtype=np.uint64), 4, 42, forest.poisson_table(1.0))).all()


def test_cuts():
    x = np.repeat([3.0, 1.0, 2.0], 4)
    assert forest.cuts_of(x, np.ones(12), 31).tolist() == [1.5, 2.5]
    assert len(forest.cuts_of(np.zeros(5), np.ones(5), 31)) == 0
    many = forest.cuts_of(np.arange(1_000.0), np.ones(1_000), 3)
    assert many.tolist() == [249.5, 499.5, 749.5]


def test_numbers_leave_a_row_as_one_array(spark, monkeypatch):
    """A struct per number made code that HotSpot does not compile."""
    plans = []
    keep = statistics.materialize
    monkeypatch.setattr(statistics, "materialize", lambda df, *a: (plans.append(df._jdf.queryExecution().toString()), keep(df, *a))[1])
    df = spark.range(1_000).select(*[((F.col("id") * (k + 1)) % 97).cast("double").alias(f"x{k}") for k in range(40)])
    found = summarize_numbers(df, df.columns, [0.5])
    assert [found[f"x{k}"].quantiles[0.5] for k in range(3)] == [
        float(np.median((np.arange(1_000) * (k + 1)) % 97)) for k in range(3)
    ]
    assert plans and all("posexplode" in p for p in plans)


def test_narrow_vectors_need_no_join(spark):
    df = spark.createDataFrame([(1.0, "a", "u"), (None, "b", None), (3.0, "a", "v")], "x double, c string, d string")
    fitted = fit_preprocessor(df)
    vectors = fitted.transform_vector(df)
    assert "Join" not in vectors._jdf.queryExecution().toString()
    later = spark.createDataFrame([(2.0, "new", "v"), (2.0, None, "u")], "x double, c string, d string")
    assert [r[0].toArray().tolist() for r in fitted.transform_vector(later).collect()] == [
        [0.0, 0.0, 0.0, 0.0, 1.0], [0.0, 1.0, 0.0, 1.0, 0.0]
    ]
