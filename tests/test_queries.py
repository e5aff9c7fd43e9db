"""Every query against its SQL in DuckDB, over whole tables."""

import pytest
from compare import connect, difference, kinds

import __spark_entry__ as entry
from cohort.checks.oracles import ORACLES
from cohort.checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(name, spark, folder, duck):
    df = entry.queries()[name](spark, folder)
    relation = duck.sql(entry.oracle_sql()[name])
    assert difference(df.toPandas(), relation.df()) is None
    assert kinds(df, relation) is None


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["people"] for r in rows) == 1500
    assert {r["income_band"] for r in rows} >= {"<25k", "150k+"}
