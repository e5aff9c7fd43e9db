"""Tabular feature, preprocessing and scoring work on Spark DataFrames."""

from cohort.operators.clean import (
    basic_cleanup,
    coerce_numeric,
    count_copies,
    drop_copies,
    ensure_id,
    normalize_names,
    number_rows,
    standardize_strings,
)
from cohort.operators.features import REGISTRY, build_features, drop_target_columns
from cohort.operators.metrics import metrics_of, roc_auc, to01
from cohort.operators.model import (
    build_model,
    class_weights,
    evaluate,
    feature_importances,
    load_model,
    predict_df,
    save_model,
    train_model,
)
from cohort.operators.numbers import exact_quantiles, summarize_numbers
from cohort.operators.preprocess import (
    build_preprocessor,
    fit_preprocessor,
    get_feature_names_after_preprocessor,
    infer_column_types,
    infer_columns,
    load_preprocessor,
    make_preprocessor,
    save_preprocessor,
    transform_df,
)
from cohort.operators.profile import schema_profile, value_counts
from cohort.operators.split import mark_split, plan_split, train_test_split_safe
from cohort.plans.registry import FeatureError, FeatureRegistry, FeatureSpec
from cohort.plans.workflow import (
    evaluate_file,
    make_features,
    make_interim,
    make_matrix,
    predict_file,
    train_file,
)
from cohort.sources.tables import (
    build_if_absent,
    load_interim,
    load_metrics,
    load_raw,
    read_csv,
    save_interim,
    save_metrics,
    write_csv,
)
