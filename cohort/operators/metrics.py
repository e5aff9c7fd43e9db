"""Binary classification metrics as aggregates over (label, pred, score)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import nan_to_null, quoted
from cohort.plans.workspace import materialize

# Fixed value: probabilities are clipped by the spacing of doubles at 1.
PROBABILITY_EPSILON = 2.220446049250313e-16

#: Distinct scores that one task orders, about.
RANGE_ROWS = 1_000_000
#: Ranges that there may be for less; a range is a task and a row of the last, single one.
MOST_RANGES = 64


def score_ranges(scores: int, range_rows: int) -> int:
    """How many ranges order so many distinct scores.

    Ranges of ``range_rows`` scores while they are few: many small ones cost a task each
    and save nothing.  Beyond ``MOST_RANGES`` they grow to ``RANGE_ROWS`` scores first.
    """
    asked = max(1, -(-scores // range_rows))
    return min(asked, max(MOST_RANGES, -(-scores // RANGE_ROWS)))


def strange_label(df: DataFrame, column: str) -> Column:
    """Whether a label is neither boolean nor 0/1; types that never are raise."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.BooleanType):
        return quoted(column).isNull()
    if not isinstance(dtype, T.NumericType):
        raise ValueError(f"labels must be boolean or 0/1, {column!r} is {dtype.simpleString()}")
    return ~F.coalesce(quoted(column).isin(0, 1), F.lit(False))


def forbid_strange(count: int, example: Any = None) -> None:
    if count:
        said = "" if example is None else f", for example {example}"
        raise ValueError(f"labels must be boolean or 0/1: {count} rows differ{said}")


def to01(df: DataFrame, column: str) -> DataFrame:
    """Labels as 0/1 integers; anything but booleans or 0/1 raises."""
    strange = strange_label(df, column)
    if not isinstance(df.schema[column].dataType, T.BooleanType):
        bad = df.agg(F.count_if(strange).alias("n"), F.min(F.when(strange, quoted(column))).alias("v")).first()
        forbid_strange(bad["n"], bad["v"])
    return as01(df, column)


def as01(df: DataFrame, column: str) -> DataFrame:
    """Labels that are known to be boolean or 0/1 as integers."""
    return df.withColumn(column, quoted(column).cast("int"))


def _cells(label: Column, pred: Column) -> list[Column]:
    return [
        F.count_if((label == 0) & (pred == 0)).alias("tn"),
        F.count_if((label == 0) & (pred == 1)).alias("fp"),
        F.count_if((label == 1) & (pred == 0)).alias("fn"),
        F.count_if((label == 1) & (pred == 1)).alias("tp"),
    ]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def _rates() -> list[Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return [
        _share(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row of tn, fp, fn, tp; always all four cells."""
    return df.agg(*_cells(quoted(label), quoted(pred)))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row of accuracy, precision, recall and F1; 0 for an empty divisor."""
    return confusion_matrix(df, label, pred).select(*_rates())


def _log_loss(label: Column, score: Column) -> Column:
    hit = F.when(label == 1, score).otherwise(1 - score)
    clipped = F.greatest(F.least(hit, F.lit(1 - PROBABILITY_EPSILON)), F.lit(PROBABILITY_EPSILON))
    missing = F.count_if(label.isNull() | nan_to_null(score.cast("double")).isNull())
    return F.when(missing == 0, F.avg(-F.log(clipped)))


def log_loss(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return df.agg(_log_loss(quoted(label), quoted(score)).alias("log_loss"))


def support(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(
        F.count(quoted(label)).alias("n"), F.avg(quoted(label).cast("double")).alias("pos_rate")
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", *, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Area under the ROC curve; tied scores count half.  One class gives NULL, and
    so does a missing score or label: an area over the rest would be another one.

    Equal scores merge before the shuffle and are stored.  The distinct scores are
    range-partitioned, as many ranges as ``score_ranges`` says; a range adds up the
    negatives below each of its scores, and the ranges, one row each, add up those of
    the ranges below.
    """
    value = nan_to_null(quoted(score).cast("double"))
    y = quoted(label)
    per_score = materialize(
        df.select(value.alias("score"), y.alias("label")).groupBy("score").agg(
            F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"),
            F.count_if(F.col("label").isNull() | F.col("score").isNull()).alias("missing"),
        ),
        "scores",
    )
    missing, scores = per_score.agg(F.coalesce(F.sum("missing"), F.lit(0)), F.count(F.lit(1))).first()
    if missing:
        return df.sparkSession.range(1).select(F.lit(None).cast("double").alias("roc_auc"))
    ranges = score_ranges(scores, range_rows)
    placed = per_score.repartitionByRange(ranges, "score").withColumn("range", F.spark_partition_id())
    below = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(below), F.lit(0))
    per_range = (
        placed.withColumn("pairs", F.col("pos") * (neg_below + F.col("neg") / 2))
        .groupBy("range")
        .agg(F.sum("pairs").alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # One row per range, so this window is small.
    ranges_below = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    neg_under = F.coalesce(F.sum("neg").over(ranges_below), F.lit(0))
    total = F.sum("pos").cast("double") * F.sum("neg")
    return (
        per_range.withColumn("pairs", F.col("pairs") + F.col("pos").cast("double") * neg_under)
        .agg(F.when(total > 0, F.sum("pairs") / total).alias("roc_auc"))
    )


def positive_class_index(model: Any) -> int:
    """Index of class 1 among the classes 0..k-1 of a model, else the last."""
    classes = int(getattr(model, "numClasses", 2))
    return 1 if classes > 1 else classes - 1


def metrics_of(
    df: DataFrame, label: str = "label", pred: str = "pred", score: str | None = "score"
) -> dict[str, Any]:
    """All metrics of a scored table in one pass, plus the AUC."""
    y, p = quoted(label), quoted(pred)
    wanted = [*_cells(y, p), F.avg(y.cast("double")).alias("pos_rate")]
    if score is not None:
        wanted.append(_log_loss(y, quoted(score)).alias("log_loss"))
    row = df.agg(*wanted).select("*", *_rates()).first()
    out = {name: row[name] for name in ("accuracy", "precision", "recall", "f1")}
    out["confusion_matrix"] = [[row["tn"], row["fp"]], [row["fn"], row["tp"]]]
    out["support"] = {
        "n": row["tn"] + row["fp"] + row["fn"] + row["tp"],
        "pos_rate": row["pos_rate"],
    }
    if score is not None:
        auc = roc_auc(df, label, score).first()["roc_auc"]
        out["roc_auc"] = auc
        # With a single class neither ranking nor likelihood is reported.
        out["log_loss"] = row["log_loss"] if auc is not None else None
    return out
