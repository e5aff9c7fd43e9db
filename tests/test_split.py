import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohort.operators import split
from cohort.operators.split import mark_split, plan_split, share_out, train_test_split_safe


def people(spark, n=1_003):
    return spark.range(n).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"), (F.col("id") * 2).alias("x"))


def sides(df):
    return {r["id"]: r["split"] for r in df.collect()}


def test_counts_are_exact_and_proportional(spark):
    marked = mark_split(people(spark), "y")
    n = {(r["y"], r["split"]): r["count"] for r in marked.groupBy("y", "split").count().collect()}
    assert n[0, "test"] + n[1, "test"] == math.ceil(0.2 * 1_003)
    assert (n[1, "test"], n[0, "test"]) == (20, 181)


@pytest.mark.parametrize("digits", [1, 4])
def test_split_takes_the_smallest_draws(spark, monkeypatch, digits):
    monkeypatch.setattr(split, "DIGITS_PER_ROUND", digits)
    df = people(spark)
    got = {i for i, s in sides(mark_split(df, "y")).items() if s == "test"}
    draws = df.select("id", "y", split.row_draw("id", 42).alias("d")).collect()
    want = set()
    for c, n in ((0, 181), (1, 20)):
        ranked = sorted((r["d"], r["id"]) for r in draws if r["y"] == c)
        want |= {i for _, i in ranked[:n]}
    assert got == want


def test_split_depends_on_key_and_seed_only(spark):
    df = people(spark)
    assert sides(mark_split(df.repartition(13), "y")) == sides(mark_split(df.orderBy(F.desc("x")), "y"))
    assert sides(mark_split(df, "y")) != sides(mark_split(df, "y", random_state=43))


def test_four_tables(spark):
    x_train, x_test, y_train, y_test = train_test_split_safe(people(spark), "y", 0.25, 1)
    assert x_train.columns == x_test.columns == ["id", "x"]
    assert (y_test.count(), x_test.count(), x_train.count()) == (251, 251, 752)
    assert x_test.join(y_train, "id", "left_semi").count() == 0


def test_unstratified(spark):
    plan = plan_split(people(spark), "y", stratify=False)
    assert plan.test_rows(people(spark)).count() == 201


def test_labels_may_be_boolean_text_or_missing(spark):
    df = people(spark, 100).withColumn("y", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 2 == 0))
    marked = mark_split(df, "y")
    assert marked.where("split = 'test'").count() == 20
    assert marked.where("split = 'test' and y is null").count() == 5
    assert mark_split(df.withColumn("y", F.col("y").cast("string")), "y").where("split='test'").count() == 20


def test_refusals(spark):
    df = people(spark)
    with pytest.raises(KeyError):
        plan_split(df, "nope")
    with pytest.raises(ValueError, match="empty"):
        plan_split(df.limit(0), "y")
    with pytest.raises(ValueError, match="at least 2"):
        plan_split(df.withColumn("y", (F.col("id") == 3).cast("int")), "y")
    with pytest.raises(ValueError, match="identify"):
        plan_split(df.withColumn("id", F.lit(1)), "y")
    with pytest.raises(ValueError, match="3 test and .* 4 classes"):
        plan_split(df.where("id < 12").withColumn("x", F.col("id") % 4), "x")
    with pytest.raises(ValueError):
        plan_split(df, "y", test_size=1.5)


@given(st.dictionaries(st.integers(0, 9), st.integers(1, 10**12), min_size=1), st.floats(0, 1))
def test_shares_add_up_and_stay_close(counts, part):
    everything = sum(counts.values())
    total = int(everything * part)
    got = share_out(counts, total)
    assert sum(got.values()) == total
    for c, n in counts.items():
        assert abs(got[c] - total * n / everything) <= 1 + 1e-3


def test_missing_key_is_refused(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (4, 0)], "id long, label int")
    with pytest.raises(ValueError, match="missing values"):
        plan_split(df, "label", key="id")


@pytest.mark.parametrize("bound, hot", [(0, 1e-3), (0, 2.0), (1 << 20, 1e-3)])
def test_thousands_of_classes(spark, monkeypatch, bound, hot):
    monkeypatch.setattr(split.lookups, "BROADCAST_BYTES", bound)
    monkeypatch.setattr(split.lookups, "HOT_SHARE", hot)
    # One class, and the rows without one, hold much of the table.
    y = F.when(F.col("id") < 3_000, F.lit("big")).when(F.col("id") < 5_000, None).otherwise(F.concat(F.lit("c"), F.col("id") % 1_500))
    df = spark.range(12_500).select("id", y.alias("y"))
    got = {(r["y"], r["split"]): r["count"] for r in mark_split(df, "y").groupBy("y", "split").count().collect()}
    sizes = {"big": 3_000, None: 2_000} | {f"c{k}": 5 for k in range(1_500)}
    train = share_out(sizes, 10_000)
    for c, n in sizes.items():
        assert (got.get((c, "train"), 0), got.get((c, "test"), 0)) == (train[c], n - train[c])


def test_shares_of_a_table_are_those_of_a_list(spark):
    sizes = {f"k{k}": 2 + (k * 7919) % 23 for k in range(40)}
    table = spark.createDataFrame(list(sizes.items()), "label string, n long")
    got = {r["label"]: r["train"] for r in split._shares(table, 300, sum(sizes.values())).collect()}
    assert got == share_out(sizes, 300)
