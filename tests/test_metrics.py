import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cohort.operators.metrics import (
    classification_metrics,
    confusion_matrix,
    log_loss,
    metrics_of,
    positive_class_index,
    roc_auc,
    score_ranges,
    to01,
)


def from_cells(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "label int, pred int")


def test_published_ratios_follow_from_the_published_matrix(spark):
    row = classification_metrics(from_cells(spark, 139, 163, 152, 146)).first()
    assert [round(v, 6) for v in row] == [0.475, 0.472492, 0.489933, 0.481054]


def test_empty_divisors_and_one_class(spark):
    df = from_cells(spark, 3, 0, 0, 0)
    assert tuple(classification_metrics(df).first()) == (1.0, 0.0, 0.0, 0.0)
    assert tuple(confusion_matrix(df).first()) == (3, 0, 0, 0)
    found = metrics_of(df.withColumn("score", F.lit(0.2)))
    assert found["confusion_matrix"] == [[3, 0], [0, 0]]
    assert found["roc_auc"] is None and found["log_loss"] is None


@pytest.mark.parametrize("range_rows", [3, 50, 1_000_000])
def test_auc_equals_counting_pairs(spark, range_rows):
    draw = random.Random(5)
    rows = []
    for _ in range(400):
        y = draw.random() < 0.3
        # A third of the rows share one score.
        rows.append((int(y), 0.5 if draw.random() < 0.33 else draw.gauss(y, 1)))
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    got = roc_auc(df, range_rows=range_rows).first()[0]
    assert got == pytest.approx(want, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert got == pytest.approx(evaluator.evaluate(df.withColumn("label", F.col("label").cast("double"))), abs=1e-9)


def test_ranges_do_not_grow_with_the_scores_until_they_are_full():
    assert score_ranges(0, 100) == score_ranges(100, 100) == 1
    assert score_ranges(350, 100) == 4
    assert score_ranges(400_000, 100) == score_ranges(40_000_000, 100) == 64
    assert score_ranges(1_000_000_000, 100) == score_ranges(1_000_000_000, 1_000_000) == 1_000


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0), (1, 0.5)], "label int, score double")
    want = (-math.log(2.220446049250313e-16) + 0 + math.log(2)) / 3
    assert log_loss(df).first()[0] == pytest.approx(want, rel=1e-12)


def test_labels(spark):
    for kind, values in (("boolean", [True, False]), ("double", [1.0, 0.0]), ("int", [1, 0])):
        df = spark.createDataFrame([(v,) for v in values], f"y {kind}")
        assert [r["y"] for r in to01(df, "y").collect()] == [1, 0]
    for kind, bad in (("int", 2), ("string", "1"), ("int", None)):
        with pytest.raises(ValueError, match="0/1"):
            to01(spark.createDataFrame([(bad,)], f"y {kind}"), "y")


def test_positive_class():
    class Model:
        numClasses = 1

    assert positive_class_index(Model()) == 0
    assert positive_class_index(object()) == 1


def test_missing_scores_give_no_metric(spark):
    from cohort.operators.metrics import log_loss, roc_auc

    for missing in ((None, 1), (float("nan"), 1), (0.5, None)):
        df = spark.createDataFrame([(0.5, 1), (0.4, 0), missing], "score double, label int")
        assert roc_auc(df).first()[0] is None
        assert log_loss(df).first()[0] is None
