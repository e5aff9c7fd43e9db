"""Random forest: build, train on a hold-out split, score, explain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.operators.clean import number_rows
from cohort.operators.features import drop_target_columns
from cohort.operators.forest import can_grow, can_score, grow, score_rows
from cohort.operators.metrics import (
    as01,
    forbid_strange,
    metrics_of,
    positive_class_index,
    strange_label,
    to01,
)
from cohort.operators.preprocess import PreprocessorModel, fit_preprocessor, infer_columns
from cohort.operators.split import plan_split
from cohort.plans.workspace import materialize, spread
from cohort.sources.tables import path_exists

# Names under which a table may already carry a row key.
ID_COLUMNS = ("id", "ID", "row_id", "index")

# MLlib grows trees to depth 30 at most.
UNLIMITED_DEPTH = 30

_WEIGHT = "_cohort_weight"
_TEST = "_cohort_test"
_NAMES_FOLDER = "featureNames"
_NAMES_SCHEMA = "place int, name string"


# --- guards ------------------------------------------------------------------


def require_target(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise KeyError(f"no target column {target!r} among the {len(df.columns)} columns {df.columns}")


def forbid_target(df: DataFrame, target: str) -> None:
    if target in df.columns:
        raise ValueError(f"target {target!r} must not be among the feature columns")


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"{what} table is empty")


def guard_counts(df: DataFrame, target: str, key: str) -> dict[str, Column]:
    """The conditions that no row of a training table may meet, by name."""
    return {
        "missing_keys": quoted(key).isNull(),
        "missing_labels": quoted(target).isNull(),
        "strange_labels": strange_label(df, target),
    }


def guard_report(df: DataFrame, target: str, *, key: str = "id") -> DataFrame:
    """One row, from one pass: rows, missing_keys, missing_labels, strange_labels and the
    least strange label as text.  Training counts the same in the scan of its split."""
    require_target(df, target)
    counts = guard_counts(df, target, key)
    example = F.min(F.when(counts["strange_labels"], quoted(target).cast("string")))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()], example.alias("example")
    )


def pick_id(df: DataFrame) -> str | None:
    """The first known key name the table has (exact case)."""
    return next((c for c in ID_COLUMNS if c in df.columns), None)


# --- building ----------------------------------------------------------------


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: n / (classes * rows of the class)."""
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # Only the two totals reach the driver, however many classes there are.
    total, k = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    weight = F.lit(total).cast("bigint") / (F.lit(k) * F.col("n"))
    return counts.select("label", "n", weight.alias("weight"))


def build_model(
    train: DataFrame,
    *,
    label: str = "label",
    features: str = "features",
    n_estimators: int = 500,
    max_depth: int | None = 5,
    max_features: str | float | int | None = "sqrt",
    min_samples_leaf: int = 1,
    class_weight: str | None = "balanced",
    random_state: int = 42,
    max_samples: int | None = None,
    checked: bool = False,
    key: str | None = None,
) -> RandomForestClassificationModel:
    """Fit a forest on a table with a feature vector and a 0/1 label.

    ``max_samples`` is the expected number of rows each tree draws.  Labels that
    are ``checked`` are not looked at again.  With a ``key`` the forest does not depend
    on how the table is stored.  MLlib itself fits what is too deep or too wide for
    ``cohort.operators.forest``.
    """
    if class_weight not in (None, "balanced"):
        raise ValueError(f"unknown class_weight: {class_weight}")
    forest = RandomForestClassifier(
        featuresCol=features,
        labelCol=label,
        numTrees=n_estimators,
        maxDepth=UNLIMITED_DEPTH if max_depth is None else max_depth,
        featureSubsetStrategy="all" if max_features is None else str(max_features),
        minInstancesPerNode=min_samples_leaf,
        seed=random_state,
    )
    data = as01(train, label) if checked else to01(train, label)
    if class_weight == "balanced":
        found = class_weights(data, label).collect()
        weight = F.lit(None).cast("double")
        for r in found:
            weight = F.when(quoted(label) == r["label"], F.lit(r["weight"])).otherwise(weight)
        data = data.withColumn(_WEIGHT, weight)
        forest = forest.setWeightCol(_WEIGHT)
        weights = {r["label"]: r["weight"] for r in found}
    else:
        found = data.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()
        weights = {r["label"]: 1.0 for r in found}
    rows = {r["label"]: r["n"] for r in found}
    if max_samples is not None:
        forest = forest.setSubsamplingRate(min(1.0, max_samples / sum(rows.values())))
    if can_grow(forest, data, features, rows):
        return grow(forest, data, label=label, features=features, rows=rows, weights=weights, key=key)
    return forest.fit(data)


def bind_features(model: Any, names: Sequence[str]) -> Any:
    """Let the model remember which column each place of its vector holds."""
    model.feature_names = list(names)
    return model


def bound_features(model: Any) -> list[str] | None:
    return getattr(model, "feature_names", None)


def save_model(model: RandomForestClassificationModel, path: str) -> str:
    """The forest, and the names of its features where it knows them."""
    model.write().overwrite().save(path)
    names = bound_features(model)
    if names is not None:
        spark = SparkSession.active()
        rows = spark.createDataFrame(list(enumerate(names)), _NAMES_SCHEMA)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_NAMES_FOLDER}")
    return path


def load_model(path: str) -> RandomForestClassificationModel:
    spark = SparkSession.active()
    if not path_exists(spark, path):
        raise FileNotFoundError(f"model not found: {path}")
    model = RandomForestClassificationModel.load(path)
    names = f"{path}/{_NAMES_FOLDER}"
    if path_exists(spark, names):
        rows = spark.read.schema(_NAMES_SCHEMA).parquet(names).orderBy("place").collect()
        bind_features(model, [r["name"] for r in rows])
    return model


# --- features for the model --------------------------------------------------


def plain_features(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    """Numeric columns in table order, used when there is no preprocessor."""
    numeric, _ = infer_columns(df)
    return [c for c in numeric if c not in skip]


def feature_vector(
    df: DataFrame,
    preprocessor: PreprocessorModel | None,
    *,
    keep: Sequence[str],
    features: Sequence[str] | None = None,
) -> DataFrame:
    """The columns to keep and a ``features`` vector."""
    if preprocessor is not None:
        if not preprocessor.input_columns:
            raise ValueError("no feature columns after preprocessing")
        return preprocessor.transform_vector(df, keep=keep)
    names = list(features) if features is not None else plain_features(df, keep)
    if not names:
        raise ValueError("no feature columns after preprocessing")
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise ValueError(f"columns are missing: {absent}")
    numbers = [f"_n{i}" for i in range(len(names))]
    out = df.select(
        *[quoted(c) for c in keep],
        *[quoted(c).cast("double").alias(n) for c, n in zip(names, numbers)],
    )
    out = VectorAssembler(inputCols=numbers, outputCol="features").transform(out)
    return out.select(*[quoted(c) for c in keep], "features")


# --- training ----------------------------------------------------------------


@dataclass
class Training:
    model: RandomForestClassificationModel
    train: DataFrame = field(repr=False)
    test: DataFrame = field(repr=False)
    metrics: dict[str, Any]
    preprocessor: PreprocessorModel | None
    feature_names: list[str]


def train_model(
    df: DataFrame,
    *,
    target: str,
    test_size: float = 0.2,
    random_state: int = 42,
    stratify: bool = True,
    key: str = "id",
    preprocessor: PreprocessorModel | None = None,
    fit_on: str | None = "train",
    **forest_options,
) -> Training:
    """Split, preprocess, fit, and measure on the hold-out.

    ``preprocessor`` is used as it is when given.  Otherwise ``fit_on`` says
    whether to fit one on the ``"train"`` rows (the default), on ``"all"``
    rows, or not at all (None: every column must already be numeric).
    """
    require_target(df, target)
    # What the guards ask is counted in the scan that plans the split.
    split = plan_split(
        df, target, key=key, test_size=test_size, random_state=random_state, stratify=stratify,
        count=guard_counts(df, target, key),
    )
    forbid_strange(split.counted["strange_labels"])
    marked = as01(split.marked(df, _TEST), target)
    if preprocessor is None and fit_on is not None:
        if fit_on not in ("train", "all"):
            raise ValueError(f"unknown fit_on: {fit_on}")
        rows = df if fit_on == "all" else split.train_rows(df)
        preprocessor = fit_preprocessor(rows, target=target, key=key)
    if preprocessor is not None:
        if target in preprocessor.input_columns:
            raise ValueError(f"target {target!r} must not be among the feature columns")
        names = preprocessor.feature_names()
    else:
        rest = drop_target_columns(df, target)
        forbid_target(rest, target)
        names = plain_features(rest, [key])

    vectors = feature_vector(marked, preprocessor, keep=[key, target, _TEST], features=names)
    # The forest reads its input several times; it is computed once, and every core trains.
    vectors = spread(vectors.withColumnRenamed(target, "label"), split.rows)
    stored = materialize(vectors, "vectors")
    train = stored.where(~F.col(_TEST)).drop(_TEST)
    test = stored.where(_TEST).drop(_TEST)
    forest = build_model(train, random_state=random_state, checked=True, key=key, **forest_options)
    model = bind_features(forest, names)
    metrics = metrics_of(_scored_once(model, test))
    return Training(model, train, test, metrics, preprocessor, names)


# --- scoring -----------------------------------------------------------------


def score(model: Any, vectors: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns, ``pred``, and ``score`` (probability, else margin)."""
    if can_score(model) and (scored := score_rows(model, vectors, keep)) is not None:
        return scored
    out = model.transform(vectors)
    index = positive_class_index(model)
    source = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(
        *[quoted(c) for c in keep],
        F.col("prediction").cast("int").alias("pred"),
        vector_to_array(F.col(source))[index].alias("score"),
    )


def model_features(model: Any, df: DataFrame, skip: Sequence[str]) -> list[str]:
    """The columns of ``df`` that the model reads when there is no preprocessor."""
    names = bound_features(model)
    if names is None:
        names = plain_features(df, skip)
        width = getattr(model, "numFeatures", len(names))
        if names and len(names) != width:
            raise ValueError(f"the model reads {width} features, the table has {len(names)}: {names}")
    return names


def _scored_once(model: Any, vectors: DataFrame) -> DataFrame:
    """Metrics read the scores several times; the trees are walked once."""
    return materialize(score(model, vectors, keep=["label"]), "scored")


def predict_df(
    df: DataFrame,
    model: Any,
    *,
    preprocessor: PreprocessorModel | None = None,
    target: str | None = None,
    proba: bool = True,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Key, ``pred`` and, if wanted, ``proba_1`` for every row.

    Without a preprocessor the columns are those that the model was trained on,
    by name; a forest that knows no names takes the numeric columns in table
    order, of which there must be as many as it was trained on.

    A table without a known key column is numbered from 0 as ``row_id``, in the
    order in which it is stored unless ``order_by`` names columns.
    """
    if not df.isStreaming:
        require_rows(df, "input")
    key = pick_id(df)
    if key is None:
        df = number_rows(df, "row_id", order_by=order_by or [], start=0)
        key = "row_id"
    rest = df.drop(target) if target else df
    names = model_features(model, rest, [key]) if preprocessor is None else None
    scored = score(model, feature_vector(rest, preprocessor, keep=[key], features=names), keep=[key])
    if not proba:
        return scored.drop("score")
    return scored.withColumnRenamed("score", "proba_1")


def evaluate(
    model: Any, test: DataFrame, *, label: str = "label", features: str = "features"
) -> dict[str, Any]:
    """AUC, accuracy, precision, recall, F1, confusion matrix, sample count."""
    vectors = to01(test, label).select(
        quoted(label).alias("label"), quoted(features).alias("features")
    )
    found = metrics_of(_scored_once(model, vectors))
    out = {name: found[name] for name in ("roc_auc", "accuracy", "precision", "recall", "f1")}
    out["confusion_matrix"] = found["confusion_matrix"]
    out["n_samples"] = found["support"]["n"]
    return out


def feature_importances(
    spark, model: Any, names: Sequence[str] | None = None
) -> DataFrame | None:
    """(feature, importance), largest first; None if the model has none.

    Without usable names the features are called by position.
    """
    if not hasattr(model, "featureImportances"):
        return None
    values = model.featureImportances.toArray()
    if names is None or len(names) != len(values):
        names = [str(i) for i in range(len(values))]
    rows = [(n, float(v)) for n, v in zip(names, values)]
    out = spark.createDataFrame(rows, "feature string, importance double")
    return out.orderBy(F.desc("importance"), F.asc("feature"))
