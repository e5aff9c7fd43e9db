"""One query per operator, over whole tables.

Each takes (spark, folder of Parquet tables) and returns a DataFrame.  Doubles
that were computed are rounded to 6 places, because float sums depend on the
order of the rows.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.checks.fixtures import WIDE, labelled, population, raw_population, scored
from cohort.functions.values import quoted
from cohort.operators import clean, features, groups, metrics, model, preprocess, profile, split
from cohort.operators.numbers import exact_quantiles
from cohort.plans.workspace import materialize, shared_folder, spread
from cohort.sources import tables
from cohort.sources.tables import read_csv, write_csv

Query = Callable[[SparkSession, str], DataFrame]

TARGET = "has_health_issues"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r6(col: Column) -> Column:
    """6 places by plain double arithmetic, the same in every engine."""
    return F.when(F.abs(col) < 1e12, F.floor(col * 1e6 + 0.5) / 1e6).otherwise(col)


def rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: r6(quoted(c)) for c in doubles})


def with_feature(df: DataFrame, feature: Callable[[DataFrame], DataFrame], *columns: str) -> DataFrame:
    return rounded(feature(df).select("id", *columns))


# --- cleanup -----------------------------------------------------------------


@query
def csv_source(spark, folder):
    path = f"{shared_folder(spark)}/cohort-csv-{uuid.uuid4().hex}"
    write_csv(raw_population(spark, folder), path)
    # The three columns that arrive as text keep their blanks.
    out = read_csv(spark, path)
    return out.toDF("id_number", "income_text", "gender", "education_level", TARGET)


def _new_path(spark, label: str) -> str:
    return f"{shared_folder(spark)}/cohort-{label}-{uuid.uuid4().hex}"


@query
def interim_roundtrip(spark, folder):
    path = tables.save_interim(population(spark, folder), _new_path(spark, "interim"))
    return tables.load_interim(spark, path)


@query
def build_if_absent(spark, folder):
    """Built once; the second call finds the finished table."""
    path = _new_path(spark, "built")
    rows = population(spark, folder).select("id", "annual_income_usd")
    tables.build_if_absent(spark, path, lambda: rows)
    return tables.build_if_absent(spark, path, lambda: rows.where("id is null"))


@query
def metrics_roundtrip(spark, folder):
    found = metrics.metrics_of(scored(spark, folder))
    path = tables.save_metrics(spark, found, _new_path(spark, "metrics"))
    frame = tables.metrics_frame(spark, tables.load_metrics(spark, path))
    cells = F.flatten("confusion_matrix")
    return rounded(
        frame.select(
            "accuracy", "precision", "recall", "f1", F.col("support")["n"].alias("n"),
            *[cells[i].alias(name) for i, name in enumerate(("tn", "fp", "fn", "tp"))],
        )
    )


@query
def normalize_names(spark, folder):
    return clean.normalize_names(raw_population(spark, folder))


@query
def coerce_numeric(spark, folder):
    return clean.coerce_numeric(clean.normalize_names(raw_population(spark, folder))).select(
        "id", "annual_income_usd"
    )


@query
def standardize_strings(spark, folder):
    return clean.standardize_strings(clean.normalize_names(raw_population(spark, folder))).select(
        "id", "gender", "education_level"
    )


@query
def dedup(spark, folder):
    return clean.drop_copies(clean.normalize_names(raw_population(spark, folder)))


@query
def dedup_count(spark, folder):
    return clean.count_copies(raw_population(spark, folder))


@query
def ensure_id(spark, folder):
    rows = population(spark, folder).select(
        F.col("id").alias("person"), "name", "annual_income_usd", "gender"
    )
    return clean.ensure_id(rows, order_by=["name", "person"])


@query
def row_id(spark, folder):
    rows = clean.normalize_names(raw_population(spark, folder))
    return clean.number_rows(rows, "row_id", start=0)


@query
def basic_cleanup(spark, folder):
    return clean.basic_cleanup(raw_population(spark, folder))


# --- columns -----------------------------------------------------------------


@query
def drop_pii(spark, folder):
    return features.drop_pii(population(spark, folder))


@query
def drop_target_cols(spark, folder):
    wide = population(spark, folder).withColumns(
        {f"{TARGET}_0": 1 - F.col(TARGET), f"{TARGET}_1": F.col(TARGET)}
    )
    return features.drop_target_columns(wide, TARGET)


@query
def drop_target(spark, folder):
    return population(spark, folder).drop(TARGET)


@query
def infer_columns(spark, folder):
    df = population(spark, folder)
    numeric, categorical = preprocess.infer_columns(df)
    kind = F.when(F.col("column").isin(numeric), "numeric").when(
        F.col("column").isin(categorical), "categorical"
    )
    return profile.null_profile(df).select("column", kind.alias("kind"), "non_null")


@query
def all_null_columns(spark, folder):
    df = population(spark, folder)
    _, empty = preprocess.all_null_columns(df, df.columns)
    return spark.createDataFrame([(c,) for c in empty], "column string")


@query
def to01(spark, folder):
    df = population(spark, folder).select(
        "id", (F.col(TARGET) == 1).alias("from_bool"), F.col(TARGET).alias("from_int")
    )
    return metrics.to01(metrics.to01(df, "from_bool"), "from_int")


# --- profile -----------------------------------------------------------------


@query
def head_n(spark, folder):
    return profile.preview(population(spark, folder), 10, order_by=["annual_income_usd", "id"]).select(
        "id", "name", "annual_income_usd"
    )


@query
def schema_profile(spark, folder):
    return profile.schema_profile(population(spark, folder))


@query
def table_shape(spark, folder):
    return profile.table_shape(population(spark, folder))


@query
def columns_with_nulls(spark, folder):
    return profile.columns_with_nulls(population(spark, folder))


@query
def top_missing(spark, folder):
    return profile.top_missing(population(spark, folder), 10)


@query
def income_summary(spark, folder):
    return rounded(profile.numeric_summary(population(spark, folder), "annual_income_usd"))


@query
def target_counts(spark, folder):
    return profile.value_counts(population(spark, folder), TARGET)


@query
def value_counts_with_missing(spark, folder):
    return profile.value_counts(population(spark, folder), "marital_status")


@query
def corr_matrix(spark, folder):
    columns = ["annual_income_usd", "smokes_per_day", "bmi", "sleep_hours"]
    return rounded(profile.corr_matrix(population(spark, folder), columns))


@query
def corr_matrix_wide(spark, folder):
    """30 columns with gaps: 465 pairs."""
    people = population(spark, folder)
    squares = {f"{c}_sq": F.col(c) * F.col(c) for c in WIDE}
    return rounded(profile.corr_matrix(people.withColumns(squares), [*WIDE, *squares]))


@query
def histogram_infinite(spark, folder):
    income = F.expr(
        "CASE WHEN id % 50 = 0 THEN double('infinity') WHEN id % 70 = 1 THEN double('-infinity') "
        "ELSE annual_income_usd END"
    )
    rows = population(spark, folder).select(income.alias("income"))
    return rounded(profile.histogram(rows, "income", 10))


@query
def histogram(spark, folder):
    return rounded(profile.histogram(population(spark, folder), "annual_income_usd", 10))


# --- features ----------------------------------------------------------------


@query
def income_band(spark, folder):
    return with_feature(population(spark, folder), features.income_levels, "income_band")


@query
def log_income(spark, folder):
    return with_feature(population(spark, folder), features.income_levels, "log_income")


@query
def income_z(spark, folder):
    df = population(spark, folder)
    return with_feature(df, features.IncomeScore.fit(df).transform, "income_z")


@query
def income_decile(spark, folder):
    return with_feature(population(spark, folder), features.income_features, "income_decile")


@query
def income_decile_tied(spark, folder):
    """Half of all incomes are one value, and few values are fetched at once."""
    income = F.when(F.col("id") % 2 == 0, F.lit(12345.67)).otherwise(F.col("annual_income_usd"))
    df = population(spark, folder).withColumn("annual_income_usd", income)
    fitted = features.IncomeFeatures.fit(df, fetch_rows=100)
    return fitted.transform(df).select("id", "income_decile")


@query
def price_deciles(spark, folder):
    """Exact deciles by the narrowing search, fetching few values at once."""
    prices = spark.read.parquet(f"{folder}/lineitem.parquet")
    found = exact_quantiles(prices, "l_extendedprice", features.DECILES, fetch_rows=500)
    return rounded(spark.createDataFrame(list(enumerate(found)), "decile int, price double"))


@query
def smoke_intensity(spark, folder):
    df = features.smoke_intensity(population(spark, folder))
    open_low = features.smoke_band(F.col("smokes_per_day"), include_lowest=False)
    return df.select("id", "smoke_intensity", open_low.alias("open_lowest"))


@query
def drink_intensity(spark, folder):
    df = features.drink_intensity(population(spark, folder))
    open_low = features.drink_band(F.col("drinks_per_week"), include_lowest=False)
    return df.select("id", "drink_intensity", open_low.alias("open_lowest"))


@query
def dependents_ratio(spark, folder):
    df = features.ratios_dependents(population(spark, folder))
    unfilled = features.dependents_ratio(
        F.col("children_count"), F.col("annual_income_usd"), fill_missing=False
    )
    # Ratios are tiny, so they are compared per million.
    return df.select(
        "id",
        r6(F.col("dependents_ratio") * 1e6).alias("ratio_ppm"),
        r6(unfilled * 1e6).alias("unfilled_ppm"),
    )


@query
def quit_effort_smoke(spark, folder):
    df = features.quit_effort_smoke(population(spark, folder))
    unfilled = features.quit_effort(
        F.col("attempts_to_quit_smoking"), F.col("smokes_per_day"), fill_missing=False
    )
    return rounded(df.select("id", "quit_effort_smoke_norm", unfilled.alias("unfilled")))


@query
def quit_effort_drink(spark, folder):
    df = features.quit_effort_drink(population(spark, folder))
    unfilled = features.quit_effort(
        F.col("attempts_to_quit_drinking"), F.col("drinks_per_week"), fill_missing=False
    )
    return rounded(df.select("id", "quit_effort_drink_norm", unfilled.alias("unfilled")))


@query
def heavy_poly_use(spark, folder):
    return with_feature(population(spark, folder), features.heavy_poly_use, "heavy_poly_use")


@query
def pack_years_transforms(spark, folder):
    return with_feature(
        population(spark, folder), features.pack_years_transforms,
        "pack_years_log", "pack_years_sqrt", "pack_years_sq",
    )


@query
def alcohol_transforms(spark, folder):
    return with_feature(
        population(spark, folder), features.alcohol_transforms,
        "drink_per_day", "drink_per_day_sq", "drinks_per_week_log",
    )


@query
def risk_burden(spark, folder):
    return with_feature(
        population(spark, folder), features.risk_burden, "risk_factor_count", "elevated_risk_flag"
    )


@query
def duration_intensity(spark, folder):
    return with_feature(
        population(spark, folder), features.duration_intensity,
        "years_smoking_x_heavy", "years_smoking_x_spd",
    )


@query
def mode_safe(spark, folder):
    df = population(spark, folder)
    keys = ["marital_status", "children_count"]
    return groups.group_modes(df, "social_support", keys)


@query
def global_mode(spark, folder):
    return groups.global_mode(population(spark, folder), "education_level")


@query
def impute_social_support(spark, folder):
    return with_feature(
        population(spark, folder), features.impute_social_support, "social_support"
    )


@query
def impute_education(spark, folder):
    df = population(spark, folder)
    df = df.withColumn("income_band", features.income_band(F.col("annual_income_usd")))
    return with_feature(df, features.impute_education_level, "education_level")


@query
def impute_therapy(spark, folder):
    df = population(spark, folder)
    df = df.withColumn("income_band", features.income_band(F.col("annual_income_usd")))
    df = features.impute_education_level(df)
    return with_feature(df, features.impute_therapy_history, "therapy_history")


DERIVED = (
    "income_band", "log_income", "income_z", "income_decile", "smoke_intensity",
    "drink_intensity", "quit_effort_smoke_norm", "quit_effort_drink_norm",
    "social_support", "education_level", "therapy_history", "heavy_poly_use",
    "pack_years_log", "pack_years_sqrt", "pack_years_sq", "drink_per_day",
    "drink_per_day_sq", "drinks_per_week_log", "risk_factor_count",
    "elevated_risk_flag", "years_smoking_x_heavy", "years_smoking_x_spd",
)


@query
def build_features(spark, folder):
    out = features.build_features(population(spark, folder), TARGET, key="id")
    ratio = r6(F.col("dependents_ratio") * 1e6).alias("ratio_ppm")
    return rounded(out.select("id", *DERIVED, ratio))


@query
def feature_catalog(spark, folder):
    """Each feature with the number of rows that have all its inputs."""
    df = population(spark, folder)
    specs = features.REGISTRY.ordered()
    complete = []
    for spec in specs:
        present = F.lit(True)
        for c in spec.requires:
            present = present & (quoted(c).isNotNull() if c in df.columns else F.lit(False))
        complete.append(F.count_if(present))
    counts = df.agg(*complete).first()
    rows = [(spec.name, n) for spec, n in zip(specs, counts)]
    listed = features.REGISTRY.catalog(spark).withColumn("requires", F.array_join("requires", ","))
    return listed.join(spark.createDataFrame(rows, "name string, complete_rows bigint"), "name").select(
        "order", "name", "status", "requires", "complete_rows"
    )


@query
def features_reloaded(spark, folder):
    """Fitted on all rows, saved, loaded again and applied to another table: the odd rows."""
    people = population(spark, folder)
    path = f"{shared_folder(spark)}/fitted-{uuid.uuid4().hex}"
    features.REGISTRY.fit(people, key="id").save(spark, path)
    out = features.REGISTRY.load(spark, path).transform(people.where("id % 2 = 1"))
    ratio = r6(F.col("dependents_ratio") * 1e6).alias("ratio_ppm")
    return rounded(out.select("id", *DERIVED, ratio))


@query
def registry_only(spark, folder):
    df = population(spark, folder)
    out = features.REGISTRY.build(df, only={"risk_burden", "heavy_poly_use"}, key="id")
    added = [c for c in out.columns if c not in df.columns]
    return out.select("id", *added)


@query
def registry_exclude(spark, folder):
    """Without the incomes: education can't be filled either, so it stays as it is."""
    out = features.REGISTRY.build(population(spark, folder), exclude={"income_features"}, key="id")
    banded = F.lit("income_band" in out.columns).alias("has_band")
    return out.select("id", "education_level", "social_support", "risk_factor_count", banded)


@query
def registry_skip(spark, folder):
    """Features that lack an input are left out and listed."""
    df = population(spark, folder).drop("diet_score", "pack_years")
    fitted = features.REGISTRY.fit(df, key="id")
    names = F.lit(",".join(sorted(fitted.left_out))).alias("left_out")
    return fitted.fitted_on.select("id", "heavy_poly_use", names)


# --- split -------------------------------------------------------------------


@query
def split_train(spark, folder):
    return split.mark_split(population(spark, folder), TARGET).select("id", TARGET, "split")


@query
def split_many_classes(spark, folder):
    """Stratified by as many classes as make 12 rows each; 1,250 at 15,000 rows."""
    people = population(spark, folder)
    classes = max(1, people.count() // 12)
    people = people.withColumn("class", F.concat(F.lit("c"), F.col("id") % classes))
    return split.mark_split(people, "class").select("id", "class", "split")


@query
def split_plain(spark, folder):
    out = split.mark_split(population(spark, folder), TARGET, stratify=False)
    return out.select("id", TARGET, "split")


@query
def split_counts(spark, folder):
    return (
        split.mark_split(population(spark, folder), TARGET)
        .groupBy(TARGET, "split")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def split_counts_imbalanced(spark, folder):
    rows = labelled(spark, folder)
    return (
        split.mark_split(rows, "toxic", key="doc_id")
        .groupBy("toxic", "split")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- preprocessing -----------------------------------------------------------


def _inputs(spark, folder) -> DataFrame:
    """Population without the name, plus a text column that has no value."""
    return (
        population(spark, folder)
        .drop("name")
        .withColumn("referral_source", F.lit(None).cast("string"))
    )


@query
def scale_numeric(spark, folder):
    df = _inputs(spark, folder)
    columns = ["annual_income_usd", "children_count", "social_support", "bmi"]
    fitted = preprocess.fit_preprocessor(df, numeric_cols=columns, categorical_cols=[])
    return rounded(fitted.transform_df(df, keep=["id"]))


@query
def scale_all_null(spark, folder):
    df = _inputs(spark, folder)
    fitted = preprocess.fit_preprocessor(
        df, numeric_cols=["smoking_rate_pct"], categorical_cols=[]
    )
    later = df.withColumn("smoking_rate_pct", F.col("bmi"))
    return fitted.transform_df(df, keep=["id"]).join(
        fitted.transform_df(later, keep=["id"]).withColumnRenamed("smoking_rate_pct", "later_value"),
        "id",
    )


@query
def impute_most_frequent(spark, folder):
    df = _inputs(spark, folder)
    columns = ["education_level", "marital_status", "therapy_history"]
    fitted = preprocess.fit_preprocessor(df, numeric_cols=[], categorical_cols=columns)
    return df.select("id", *[fitted.filled(df, s).alias(s.name) for s in fitted.categorical])


@query
def impute_missing_label(spark, folder):
    df = _inputs(spark, folder)
    fitted = preprocess.fit_preprocessor(
        df, numeric_cols=[], categorical_cols=["referral_source"]
    )
    return df.select("id", *[fitted.filled(df, s).alias(s.name) for s in fitted.categorical])


@query
def one_hot(spark, folder):
    """Long form: one row per person and category."""
    df = _inputs(spark, folder)
    fitted = preprocess.fit_preprocessor(
        df,
        numeric_cols=[],
        categorical_cols=["gender", "employment_status", "education_level", "referral_source"],
    )
    return fitted.transform_long(df, key="id")


@query
def vector_of_names(spark, folder):
    """Length and place of the one entry of each person's vector; nothing is broadcast."""
    df = population(spark, folder)
    fitted = preprocess.fit_preprocessor(df, numeric_cols=[], categorical_cols=["name"])
    fitted = dataclasses.replace(fitted, broadcast_bytes=0)
    text = fitted.transform_vector(df, keep=["id"]).select("id", F.col("features").cast("string").alias("v"))
    parts = (F.regexp_extract("v", r"^\((\d+),\[(\d+)\],\[1\.0\]\)$", k).cast("bigint") for k in (1, 2))
    return text.select("id", *[p.alias(n) for p, n in zip(parts, ("length", "place"))])


@query
def preprocess_matrix(spark, folder):
    df = _inputs(spark, folder)
    fitted = preprocess.fit_preprocessor(df, target=TARGET, key="id")
    return rounded(fitted.transform_df(df, keep=["id"]))


@query
def assert_no_nulls(spark, folder):
    """Missing values per column after preprocessing; all of them zero."""
    df = _inputs(spark, folder)
    fitted = preprocess.fit_preprocessor(df, target=TARGET, key="id")
    checked = profile.assert_no_nulls(fitted.transform_df(df))
    return profile.null_profile(checked).select("column", "nulls")


# --- model -------------------------------------------------------------------


@query
def guard_report(spark, folder):
    """A table with missing keys, missing labels and labels other than 0 and 1."""
    people = population(spark, folder).selectExpr(
        "if(id % 97 = 0, null, id) AS id",
        f"CASE WHEN id % 50 = 0 THEN 2 WHEN id % 60 = 1 THEN null ELSE {TARGET} END AS {TARGET}",
    )
    return model.guard_report(people, TARGET)


@query
def class_weights(spark, folder):
    return rounded(model.class_weights(population(spark, folder), TARGET))


@query
def class_weights_imbalanced(spark, folder):
    return rounded(model.class_weights(labelled(spark, folder), "quality"))


def _feature_table(spark, folder) -> DataFrame:
    """Features with a target that one of them determines, so the result is known."""
    people = population(spark, folder)
    people = materialize(spread(people, people.count()), "people")
    built = features.build_features(people, key="id")
    target = (F.col("heavy_smoker_flag") > 0).cast("int")
    return materialize(built.withColumn(TARGET, target), "features")


@query
def rf_train(spark, folder):
    found = model.train_model(_feature_table(spark, folder), target=TARGET).metrics
    row = (
        found["accuracy"], found["precision"], found["recall"], found["f1"],
        found["roc_auc"], found["support"]["n"],
    )
    return rounded(
        spark.createDataFrame(
            [row],
            "accuracy double, precision double, recall double, f1 double, roc_auc double, n bigint",
        )
    )


@query
def rf_predict(spark, folder):
    df = _feature_table(spark, folder)
    found = model.train_model(df, target=TARGET)
    out = model.predict_df(df, found.model, preprocessor=found.preprocessor, target=TARGET)
    return out.select("id", "pred", ((F.col("proba_1") > 0.5) == (F.col("pred") == 1)).alias("agrees"))


@query
def rf_importances(spark, folder):
    found = model.train_model(_feature_table(spark, folder), target=TARGET)
    ranked = model.feature_importances(spark, found.model, found.feature_names)
    total = ranked.agg(F.sum("importance")).first()[0]
    return rounded(ranked.select("feature", F.lit(total).alias("total")))


# --- metrics -----------------------------------------------------------------


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(scored(spark, folder))


@query
def classification_metrics(spark, folder):
    return rounded(metrics.classification_metrics(scored(spark, folder)))


@query
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(scored(spark, folder)))


@query
def roc_auc_continuous(spark, folder):
    """Nearly as many scores as rows, in ranges of a hundred."""
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    return rounded(metrics.roc_auc(rows, range_rows=100))


@query
def log_loss(spark, folder):
    return rounded(metrics.log_loss(scored(spark, folder)))


def _with_gaps(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.when(F.col("id") % 50 != 0, F.col("score")))


@query
def roc_auc_missing(spark, folder):
    return rounded(metrics.roc_auc(_with_gaps(scored(spark, folder))))


@query
def log_loss_missing(spark, folder):
    return rounded(metrics.log_loss(_with_gaps(scored(spark, folder))))


@query
def support(spark, folder):
    return rounded(metrics.support(scored(spark, folder)))
