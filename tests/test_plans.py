"""The shape of the physical plans, and fitted transforms on a stream."""

import pytest
from pyspark.sql import functions as F

from cohort.checks.fixtures import population, raw_population, scored
from cohort.operators import clean, features, metrics, profile, split
from cohort.operators.groups import GroupFill
from cohort.operators.preprocess import fit_preprocessor
from cohort.plans.workspace import materialize

FITTED = {"income_features", "impute_social_support", "impute_education_level", "impute_therapy_history"}


@pytest.fixture(scope="module")
def people(spark, folder):
    return materialize(population(spark, folder), "people")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_wise_features_are_one_projection(people):
    out = people
    for spec in features.REGISTRY.ordered(exclude=FITTED):
        out = spec.apply(out)
    text = plan(out)
    assert "Exchange" not in text and "Python" not in text and "Join" not in text
    assert text.count("Project") == 1


def test_all_features_join_small_tables_only(people):
    text = plan(features.build_features(people, key="id"))
    assert "SortMergeJoin" not in text and "Python" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("BroadcastHashJoin") == 3


def test_large_group_tables_are_not_broadcast_whole(people):
    fill = GroupFill.fit(people, "social_support", ["marital_status", "children_count"], broadcast_bytes=0)
    text = plan(fill.transform(people))
    assert "Union" in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_columns_are_pruned_and_filters_pushed(spark, folder):
    text = plan(profile.value_counts(population(spark, folder), "has_health_issues"))
    assert "o_totalprice" not in text.split("ReadSchema")[1]
    df = materialize(population(spark, folder), "people").where("bmi > 30")
    assert "GreaterThan(bmi,30.0)" in plan(features.risk_burden(df))


def test_split_needs_no_shuffle(people):
    held = split.plan_split(people, "has_health_issues")
    text = plan(held.test_rows(people))
    assert "Exchange hash" not in text and "Window" not in text


def test_copies_merge_before_the_shuffle(spark, folder):
    text = plan(clean.drop_copies(raw_population(spark, folder)))
    assert text.count("HashAggregate") == 2 and "Exchange hashpartitioning" in text


def test_metrics_are_one_aggregate(spark, folder):
    assert plan(metrics.confusion_matrix(scored(spark, folder))).count("Exchange SinglePartition") == 1


def test_preprocessing_is_a_projection(people):
    model = fit_preprocessor(people.drop("name"), target="has_health_issues", key="id")
    for out in (model.transform_df(people, keep=["id"]), model.transform_vector(people, keep=["id"])):
        # Broadcasts of category tables are the only exchanges.
        assert "Exchange hash" not in plan(out) and "Python" not in plan(out)


def test_fitted_transforms_run_on_a_stream(spark, people, tmp_path):
    fitted = features.REGISTRY.fit(people, key="id")
    model = fit_preprocessor(fitted.fitted_on, target="has_health_issues", key="id")
    people.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(people.schema).parquet(str(tmp_path / "in"))
    out = model.transform_df(fitted.transform(stream), keep=["id"])
    run = (
        out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    assert run.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = model.transform_df(fitted.transform(people), keep=["id"])
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert got.agg(F.countDistinct("id")).first()[0] == want.count()
