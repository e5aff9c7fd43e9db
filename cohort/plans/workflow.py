"""Whole flows from file to file, one function per stage."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from cohort.operators.clean import basic_cleanup
from cohort.operators.features import REGISTRY, drop_target_columns
from cohort.operators.model import (
    Training,
    evaluate,
    feature_importances,
    feature_vector,
    load_model,
    model_features,
    predict_df,
    require_target,
    save_model,
    train_model,
)
from cohort.operators.preprocess import (
    PreprocessorModel,
    fit_preprocessor,
    load_preprocessor,
    save_preprocessor,
)
from cohort.operators.split import plan_split
from cohort.sources.tables import (
    build_if_absent,
    load_interim,
    load_raw,
    save_interim,
    save_metrics,
    write_csv,
)


def make_interim(
    spark: SparkSession, raw_csv: str, output: str, *, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Raw CSV to a cleaned table, unless that table is there already."""
    return build_if_absent(
        spark, output, lambda: basic_cleanup(load_raw(spark, raw_csv), order_by=order_by)
    )


def make_features(
    spark: SparkSession,
    interim: str,
    output: str,
    *,
    target: str | None = None,
    drop_target: bool = False,
    only: set[str] | None = None,
    exclude: set[str] | None = None,
    key: str | None = "id",
) -> DataFrame:
    """Cleaned table to feature table; the target stays unless dropped."""
    df = load_interim(spark, interim)
    if drop_target:
        if not target:
            raise ValueError("drop_target needs the name of the target")
        df = drop_target_columns(df, target)
    key = key if key in df.columns else None
    save_interim(REGISTRY.build(df, only=only, exclude=exclude, key=key), output)
    return load_interim(spark, output)


def make_matrix(
    spark: SparkSession,
    features: str,
    model_path: str,
    *,
    mode: str = "fit-transform",
    output_csv: str | None = None,
    target: str | None = None,
    key: str | None = "id",
    fit_on: str = "features",
    interim: str | None = None,
    **fit_options,
) -> PreprocessorModel:
    """Fit and / or apply the preprocessor (``fit``, ``transform``, both).

    ``fit_on="interim"`` fits on the cleaned table instead of the feature table.
    """
    if mode not in ("fit", "transform", "fit-transform"):
        raise ValueError(f"unknown mode: {mode}")
    if fit_on not in ("features", "interim"):
        raise ValueError(f"unknown fit_on: {fit_on}")
    if mode != "transform":
        source = features
        if fit_on == "interim":
            if interim is None:
                raise ValueError("fit_on='interim' needs the interim table")
            source = interim
        rows = load_interim(spark, source).drop("name")
        fit_key = key if key in rows.columns else None
        save_preprocessor(
            fit_preprocessor(rows, target=target, key=fit_key, **fit_options), model_path
        )
    model = load_preprocessor(spark, model_path)
    if mode != "fit":
        if output_csv is None:
            raise ValueError(f"mode {mode!r} needs an output")
        rows = drop_target_columns(load_interim(spark, features), target)
        keep = [key] if key in rows.columns else []
        write_csv(model.transform_df(rows, keep=keep), output_csv)
    return model


def train_file(
    spark: SparkSession,
    features: str,
    model_path: str,
    metrics_path: str,
    *,
    target: str,
    preprocessor_path: str | None = None,
    **options,
) -> Training:
    """Feature table to a saved forest and its hold-out metrics."""
    given = load_preprocessor(spark, preprocessor_path) if preprocessor_path else None
    df = load_interim(spark, features)
    found = train_model(df, target=target, preprocessor=given, **options)
    save_model(found.model, model_path)
    save_metrics(spark, found.metrics, metrics_path)
    return found


def evaluate_file(
    spark: SparkSession,
    features: str,
    model_path: str,
    metrics_path: str,
    *,
    target: str,
    preprocessor_path: str | None = None,
    importances_csv: str | None = None,
    test_size: float = 0.2,
    random_state: int = 42,
    key: str = "id",
) -> dict[str, Any]:
    """Metrics of a saved forest on the hold-out of a feature table."""
    df = load_interim(spark, features)
    require_target(df, target)
    split = plan_split(df, target, key=key, test_size=test_size, random_state=random_state)
    given = load_preprocessor(spark, preprocessor_path) if preprocessor_path else None
    model = load_model(model_path)
    test = split.test_rows(df)
    rest = drop_target_columns(df, target)
    names = model_features(model, rest, [key]) if given is None else None
    vectors = feature_vector(test, given, keep=[key, target], features=names)
    found = evaluate(model, vectors, label=target)
    save_metrics(spark, found, metrics_path)
    if importances_csv:
        names = given.feature_names() if given else names
        ranked = feature_importances(spark, model, names)
        if ranked is not None:
            write_csv(ranked.coalesce(1), importances_csv)
    return found


def predict_file(
    spark: SparkSession,
    features: str,
    model_path: str,
    output_csv: str,
    *,
    preprocessor_path: str | None = None,
    target: str | None = None,
    proba: bool = True,
) -> str:
    """Feature table and saved forest to predictions."""
    model = load_model(model_path)
    given = load_preprocessor(spark, preprocessor_path) if preprocessor_path else None
    df = load_interim(spark, features)
    out = predict_df(df, model, preprocessor=given, target=target, proba=proba)
    return write_csv(out, output_csv)
