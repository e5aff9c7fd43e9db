"""Stored tables and their removal."""

import os

import pytest

from cohort.plans.workspace import dropping, materialize, spread


def stored(df):
    return df.inputFiles() and all(os.path.exists(f.removeprefix("file://")) for f in df.inputFiles())


def test_dropping(spark):
    rows = spark.range(10)
    with dropping(spark):
        with dropping(spark):
            inner = materialize(rows, "inner")
            lasting = materialize(inner.filter("id > 4"), "lasting", outlives=True)
            files = inner.inputFiles()
        assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
        assert lasting.count() == 5
        last = materialize(lasting, "last", outlives=True)
    assert not stored(lasting) and last.count() == 5


def test_dropping_after_an_error(spark):
    kept = materialize(spark.range(3), "kept")
    with pytest.raises(ValueError), dropping(spark):
        gone = materialize(spark.range(4), "gone")
        raise ValueError
    assert not stored(gone) and kept.count() == 3


def test_spread(spark):
    rows = spark.range(1_000, numPartitions=1)
    cores = spark.sparkContext.defaultParallelism
    sizes = spread(rows, 1_000).rdd.glom().map(len).collect()
    assert len(sizes) == cores and sum(sizes) == 1_000 and max(sizes) < 2 * 1_000 / cores
    assert spread(rows, 1_000, each=10).rdd.getNumPartitions() == 100
