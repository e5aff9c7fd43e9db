import pytest
from pyspark.sql import functions as F

from cohort import FeatureError, FeatureRegistry
from cohort.checks.fixtures import population
from cohort.operators.features import REGISTRY
from cohort.operators.statistics import Cell, Deferred, Request, gather_round
from cohort.plans import registry as plans


@pytest.fixture
def registry():
    return FeatureRegistry()


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, 2.0), (2, 4.0)], "id long, x double")


class Centre:
    def __init__(self, df):
        self.mean = df.agg(F.avg("x")).first()[0]

    def transform(self, df):
        return df.withColumn("centred", F.col("x") - self.mean)


def test_three_kinds_of_features_in_order(registry, df):
    @registry.feature("last", requires=["double"], produces=["plus"], order=200)
    def last(df):
        return {"plus": F.col("double") + 1}

    @registry.feature("first", requires=["x"], produces=["double"], order=1)
    def first(df):
        return {"double": F.col("x") * 2}

    registry.feature("middle", requires=["x"], produces=["centred"], order=5)(Centre)

    @registry.feature("drop", order=300)
    def drop(df):
        return df.drop("x")

    assert registry.names() == ["drop", "first", "last", "middle"]
    assert [s.name for s in registry.ordered()] == ["first", "middle", "last", "drop"]
    assert [tuple(r) for r in registry.build(df).collect()] == [(1, 4.0, -1.0, 5.0), (2, 8.0, 1.0, 9.0)]
    assert registry.build(df, only={"first"}).columns == ["id", "x", "double"]
    assert registry.build(df, exclude={"drop", "last"}).columns == ["id", "x", "double", "centred"]
    fitted = registry.fit(df)
    later = fitted.transform(df.withColumn("x", F.lit(10.0)))
    assert [r["centred"] for r in later.collect()] == [7.0, 7.0]
    assert first(df).columns == ["id", "x", "double"]
    assert first.__feature_spec__ is registry.get("first")


def test_equal_orders_keep_registration_order(registry):
    for name in "bca":
        registry.feature(name)(lambda df: {})
    assert [s.name for s in registry.ordered()] == ["b", "c", "a"]


def test_a_feature_that_cannot_run_changes_nothing(registry, df):
    registry.feature("off", enabled=False)(lambda df: {"a": F.lit(1)})
    registry.feature("absent", requires=["nope"])(lambda df: {"b": F.lit(1)})
    registry.feature("wrong")(lambda df: {"c": F.col("not_there")})
    registry.feature("raises")(lambda df: 1 / 0)
    registry.feature("number")(lambda df: 3)
    registry.feature("strict", produces=["d"], strict_produces=True)(lambda df: {"e": F.lit(1)})
    registry.feature("loose", produces=["d"])(lambda df: {"f": F.lit(1)})
    assert registry.build(df).columns == ["id", "x", "f"]
    assert registry.fit(df).transform(df).columns == ["id", "x", "f"]


def test_direct_calls_raise(registry, df):
    needs = registry.feature("needs", requires=["nope"])(lambda df: {})
    with pytest.raises(AssertionError, match="nope"):
        needs(df)
    strict = registry.feature("strict", produces=["d"], strict_produces=True)(lambda df: {})
    with pytest.raises(FeatureError, match="'d'"):
        strict(df)
    number = registry.feature("number")(lambda df: 3)
    with pytest.raises(FeatureError, match="number"):
        number(df)


def test_unknown_and_duplicate_names(registry, df):
    registry.feature("a")(lambda df: {})
    with pytest.raises(FeatureError, match="duplicate"):
        registry.feature("a")(lambda df: {})
    with pytest.raises(FeatureError, match="unknown"):
        registry.get("b")
    for option in ("only", "exclude"):
        with pytest.raises(FeatureError, match=option):
            registry.build(df, **{option: {"b"}})


def test_catalog(spark):
    rows = REGISTRY.catalog(spark).collect()
    assert [r["order"] for r in rows] == [0, 10, 20, 20, 30, 30, 30, 40, 40, 40, 65, 66, 67, 68, 70]
    assert rows[1]["produces"] == ["income_band", "income_decile", "income_z", "log_income"]
    assert {r["status"] for r in rows} == {"ENABLED"}


def test_key_passes_through_even_when_a_feature_drops_it(registry, df):
    registry.feature("drop_id")(lambda df: df.drop("id"))
    assert registry.build(df, key="id").columns == ["id", "x"]
    assert registry.build(df).columns == ["x"]


def test_failures_of_the_cluster_are_not_skipped(spark):
    from cohort.plans.registry import FeatureRegistry
    from cohort.plans.workspace import NoSharedFolder

    registry = FeatureRegistry()

    @registry.feature("own", order=1)
    def own(df):
        raise ValueError("own fault")

    assert registry.fit(spark.range(2)).left_out == {"own": "ValueError('own fault')"}

    @registry.feature("job", order=2)
    def job(df):
        raise NoSharedFolder("no folder")

    with pytest.raises(NoSharedFolder):
        registry.build(spark.range(2))


class Mean(Request):
    """The mean of a column, counted like any other statistic."""

    def __init__(self, column):
        self.columns, self.mean = [column], None

    def cells(self, df):
        return [Cell(F.struct(F.lit(1).alias("one")), F.col(self.columns[0]))]

    def take(self, sums):
        row = sums.first()
        self.mean, self.settled = row["total"] / row["n"], True


class Shift:
    def __init__(self, by, to):
        self.by, self.to = by, to

    def transform(self, df):
        return df.withColumn(self.to, F.col("x") - self.by)

    def stored(self):
        return {"by": self.by, "to": self.to}, {}

    @classmethod
    def restored(cls, plain, tables):
        return cls(**plain)


def shift(registry, name, order, read="x", to=None, requires=None, produces=None):
    def make(df):
        request = Mean(read)
        return Deferred([request], lambda: Shift(request.mean, to or name))

    return registry.feature(
        name, requires=[read] if requires is None else requires,
        produces=[to or name] if produces is None else produces, order=order,
    )(make)


@pytest.fixture
def scans(monkeypatch):
    made = []
    monkeypatch.setattr(plans, "gather_round", lambda df, rs: (made.append(len(rs)), gather_round(df, rs)))
    return made


def test_independent_features_share_a_scan(registry, df, scans):
    shift(registry, "a", 1)
    shift(registry, "b", 2)
    registry.feature("c", requires=["x"], produces=["c"], order=3)(lambda df: {"c": F.col("x") + 1})
    shift(registry, "late", 4, read="a")
    shift(registry, "d", 5)
    got = registry.fit(df)
    assert scans == [2, 2]
    assert [s.name for s, _ in got.steps] == ["a", "b", "c", "late", "d"]
    assert [tuple(r) for r in got.fitted_on.collect()] == [
        (1, 2.0, -1.0, -1.0, 3.0, 2.0, -1.0), (2, 4.0, 1.0, 1.0, 5.0, 4.0, 1.0),
    ]


def test_undeclared_features_wait_for_all(registry, df, scans):
    shift(registry, "a", 1)
    registry.feature("free", order=2)(lambda df: {"twice": F.col("a") * 2})
    shift(registry, "b", 3, produces=[])
    registry.feature("more", requires=["x"], order=4)(lambda df: {"sum": F.col("a") + F.col("b")})
    out = registry.build(df)
    assert [r["twice"] for r in out.collect()] == [-2.0, 2.0] and [r["sum"] for r in out.collect()] == [-2.0, 2.0]
    assert scans == [1, 1]


def test_a_feature_that_overwrites_what_waits_to_be_read(registry, df, scans):
    shift(registry, "a", 1)
    registry.feature("ten", requires=["id"], produces=["x"], order=2)(lambda df: {"x": F.lit(10.0)})
    shift(registry, "b", 3)
    # Undeclared: the table it gives lacks x, which b has yet to read.
    registry.feature("gone", requires=["id"], order=4)(lambda df: df.drop("x"))
    out = registry.build(df)
    assert out.columns == ["id", "a", "b"]
    assert [tuple(r) for r in out.collect()] == [(1, -1.0, 0.0), (2, 1.0, 0.0)]


def test_deferred_features_that_fail_are_left_out(registry, df):
    registry.feature("bad", requires=["x"], produces=["bad"], order=1)(
        lambda df: Deferred([Mean("x")], lambda: 1 / 0)
    )
    registry.feature("next", requires=["bad"], order=2)(lambda df: {"n": F.col("bad")})
    shift(registry, "a", 3)
    fitted = registry.fit(df)
    assert fitted.fitted_on.columns == ["id", "x", "a"]
    assert fitted.left_out == {"bad": "ZeroDivisionError('division by zero')", "next": "needs bad"}


def test_built_in_features_take_two_scans(spark, folder, scans):
    people = population(spark, folder)
    fitted = REGISTRY.fit(people, key="id")
    assert len(scans) == 2 and not fitted.left_out


def test_one_by_one_gives_the_same(spark, folder):
    people = population(spark, folder)
    whole = REGISTRY.build(people, key="id")
    single = people.withColumnRenamed("id", "kept")
    for spec in REGISTRY.ordered():
        single = spec.run(single)[0]
    single = single.withColumnRenamed("kept", "id").select(whole.columns)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, single.collect()))


def test_saved_features_in_a_new_session(spark, folder, tmp_path):
    people = population(spark, folder)
    fitted = REGISTRY.fit(people.where("id % 2 = 0"), key="id")
    path = str(tmp_path / "fitted")
    fitted.save(spark, path)
    session = spark.newSession()
    loaded = REGISTRY.load(session, path)
    other = population(session, folder).where("id % 3 = 0")
    want = fitted.transform(people.where("id % 3 = 0"))
    assert sorted(map(repr, loaded.transform(other).collect())) == sorted(map(repr, want.collect()))
    assert loaded.key == "id" and loaded.left_out == fitted.left_out
    # The version saved last is the one that is read.
    REGISTRY.fit(people, only={"heavy_poly_use"}, key="id").save(spark, path)
    assert [s.name for s, _ in REGISTRY.load(spark, path).steps] == ["heavy_poly_use"]


def test_saving_and_loading_refuse_what_they_do_not_know(registry, df, spark, tmp_path):
    registry.feature("centre", requires=["x"], produces=["centred"])(Centre)
    with pytest.raises(FeatureError, match="Centre"):
        registry.fit(df).save(spark, str(tmp_path / "a"))
    with pytest.raises(FileNotFoundError):
        registry.load(spark, str(tmp_path / "none"))
    other = FeatureRegistry()
    shift(other, "s", 1)
    other.fit(df).save(spark, str(tmp_path / "b"))
    with pytest.raises(FeatureError, match="Shift"):
        other.load(spark, str(tmp_path / "b"))
    other.storable(Shift)
    assert [r["s"] for r in other.load(spark, str(tmp_path / "b")).transform(df).collect()] == [-1.0, 1.0]
    with pytest.raises(FeatureError, match="unknown feature"):
        registry.load(spark, str(tmp_path / "b"))
    empty = FeatureRegistry()
    empty.fit(df).save(spark, str(tmp_path / "c"))
    assert empty.load(spark, str(tmp_path / "c")).transform(df).columns == ["id", "x"]
