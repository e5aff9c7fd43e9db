"""Profiling: schema, missing values, summaries, frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import nan_to_null, quoted, to_number
from cohort.operators.numbers import summarize_numbers


def _present(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing."""
    dtype = df.schema[name].dataType
    col = quoted(name)
    return nan_to_null(col) if isinstance(dtype, (T.DoubleType, T.FloatType)) else col


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-missing and missing counts.

    All counts come from one aggregate; the per-column rows are spread out of
    that single row afterwards.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(_present(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"n{i}").alias("non_null"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.col("rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*entries)))


def schema_profile(df: DataFrame) -> DataFrame:
    """Column, type, counts and missing percentage, most missing first."""
    percent = F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows") * 100)
    return (
        null_profile(df)
        .select("column", "dtype", "non_null", "nulls", F.bround(percent, 2).alias("null_pct"))
        .orderBy(F.desc("nulls"), F.asc("column"))
    )


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_profile(df).where("nulls > 0").select("column")


def top_missing(df: DataFrame, n: int = 10) -> DataFrame:
    """The n columns with the most missing values."""
    return (
        null_profile(df)
        .select("column", "nulls")
        .orderBy(F.desc("nulls"), F.asc("column"))
        .limit(n)
    )


def assert_no_nulls(df: DataFrame) -> DataFrame:
    """Raise when any column has a missing value, else return the table."""
    found = [r["column"] for r in columns_with_nulls(df).collect()]
    if found:
        raise AssertionError(f"missing values in columns: {sorted(found)}")
    return df


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def preview(df: DataFrame, n: int = 10, *, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows by the given order (a top-k, not a full sort)."""
    ordered = df.orderBy(*[quoted(c) for c in order_by]) if order_by else df
    return ordered.limit(n)


def numeric_summary(df: DataFrame, column: str, **options) -> DataFrame:
    """One row: min, max, median, mean and sample standard deviation."""
    found = summarize_numbers(df, [column], [0.5], **options)[column]
    row = (found.low, found.high, found.quantiles[0.5], found.mean, found.std_samp)
    schema = "min double, max double, median double, mean double, std double"
    return df.sparkSession.createDataFrame([row], schema)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, missing included, most frequent first."""
    value = _present(df, column)
    return (
        df.groupBy(value.alias(column))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), quoted(column).asc_nulls_last())
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair, over the rows that have both.

    A row becomes one cell per pair that it has, and one aggregate grouped by pair
    adds them up, so the plan does not grow with the number of pairs.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = list(columns)
    values = df.select(F.array(*[to_number(quoted(c), types[c]) for c in columns]).alias("v"))
    last = len(columns) - 1

    def with_later(i: Column) -> Column:
        return F.transform(
            F.sequence(i, F.lit(last)),
            lambda j: F.struct(i.alias("i"), j.alias("j"), F.get("v", i).alias("a"), F.get("v", j).alias("b")),
        )

    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(last)), with_later))
    found = (
        values.select(F.inline(cells)).where("a is not null and b is not null")
        .groupBy("i", "j").agg(F.corr("a", "b").alias("corr"))
    )
    # A pair without common rows has a row too.
    pairs = [(i, j, columns[i], columns[j]) for i in range(len(columns)) for j in range(i, len(columns))]
    named = df.sparkSession.createDataFrame(pairs, "i int, j int, x string, y string")
    return named.join(F.broadcast(found), ["i", "j"], "left").select("x", "y", "corr")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins; the last one includes the maximum.

    Infinite values are counted in bins of their own, -1 and ``bins``, which are
    there if there are any; missing ones are not counted.
    """
    value = to_number(quoted(column), df.schema[column].dataType)
    finite = F.when(F.abs(value) < float("inf"), value)
    schema = "bin int, left double, right double, count bigint"
    spark = df.sparkSession
    low, high, below, above = df.agg(
        F.min(finite), F.max(finite), F.count_if(value == float("-inf")), F.count_if(value == float("inf"))
    ).first()
    infinite = [(at, x, x, n) for at, x, n in ((-1, float("-inf"), below), (bins, float("inf"), above)) if n]
    if low is None:
        return spark.createDataFrame(infinite, schema)
    if low == high:
        low, high = low - 0.5, high + 0.5
    value = finite
    width = (high - low) / bins
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(value.isNotNull()).groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    found = frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("left"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )
    return found.unionByName(spark.createDataFrame(infinite, schema)) if infinite else found
