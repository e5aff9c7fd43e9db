"""Readers and writers: typed CSV, interim tables, metrics."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import (
    INFINITY_PATTERN,
    NUMBER_PATTERN,
    markers_to_null,
    quoted,
    strip,
)

INTEGER_PATTERN = r"^[+-]?[0-9]+$"
BOOLEAN_PATTERN = r"^(True|TRUE|true|False|FALSE|false)$"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system holds it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def _require_path(spark: SparkSession, path: str, what: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{what} not found: {path}")


def _header_names(cells: Row) -> list[str]:
    """Header cells as column names; repeats get .1, .2, blanks a position."""
    names = [c if c else f"Unnamed: {i}" for i, c in enumerate(cells)]
    seen: Counter[str] = Counter()
    taken = set(names)
    out = []
    for name in names:
        candidate = name
        while seen[name] and candidate in taken | set(out):
            candidate = f"{name}.{seen[name]}"
            seen[name] += 1
        if candidate == name:
            seen[name] = 1
        out.append(candidate)
    return out


def _require_one_header(spark: SparkSession, path: str) -> None:
    """Raise when the files of a folder do not all begin with the same line.

    Only blocks at the start of a file are looked at, and each task keeps one
    line per file.
    """
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at"), "_metadata")
    starts = lines.where("_metadata.file_block_start = 0").groupBy("_metadata.file_path")
    first = starts.agg(F.min_by(F.rtrim("value"), "at").alias("line"))
    low, high = first.agg(F.min("line"), F.max("line")).first()
    if low != high:
        raise ValueError(f"CSV files of {path} differ in their headers: {low!r}, {high!r}")


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header; missing-value markers become NULL.

    Without a ``schema`` all cells are read as text and one aggregate over the
    table decides every column type; a given schema skips that pass.  Set
    ``multiline`` for quoted line breaks: such a file is read by one task.

    All files of a folder must have the same header, or reading them raises.
    """
    _require_path(spark, path, "CSV")
    reader = spark.read.option("quote", '"').option("escape", '"').option("multiLine", multiline)
    first = reader.option("header", False).csv(path).head()
    if first is None:
        raise ValueError(f"CSV has no header: {path}")
    names = _header_names(first)
    # Columns go by position until the end: headers may differ in case only.
    places = [f"c{i}" for i in range(len(names))]
    text = T.StructType([T.StructField(p, T.StringType()) for p in places])
    _require_one_header(spark, path)
    cells = reader.option("header", True).option("enforceSchema", True).schema(text).csv(path)
    cells = cells.select(*[markers_to_null(F.col(p)).alias(p) for p in places])
    if schema is None:
        return infer_types(cells).toDF(*names)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    absent = [f.name for f in wanted.fields if f.name not in names]
    if absent:
        raise ValueError(f"CSV has no columns {absent}: {path}")
    place = dict(zip(names, places))
    return cells.select(
        *[_typed(F.col(place[f.name]), f.dataType).alias(f.name) for f in wanted.fields]
    )


def _typed(cell: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return cell
    text = strip(cell)
    if isinstance(dtype, T.NumericType):
        number = text.rlike(NUMBER_PATTERN) | text.rlike(INFINITY_PATTERN)
        return F.when(number, text.try_cast(dtype))
    return text.try_cast(dtype)


def infer_types(df: DataFrame) -> DataFrame:
    """Narrow text columns to bigint, double or boolean where every cell fits.

    Whole numbers with gaps become double, and a column without any value too.
    """
    wanted = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        raw = quoted(c)
        text = strip(raw)
        number = text.rlike(NUMBER_PATTERN) | text.rlike(INFINITY_PATTERN)
        whole = text.rlike(INTEGER_PATTERN) & text.try_cast("bigint").isNotNull()
        wanted += [
            F.count(raw).alias(f"n{i}"),
            F.count_if(whole).alias(f"w{i}"),
            F.count_if(number).alias(f"d{i}"),
            F.count_if(raw.rlike(BOOLEAN_PATTERN)).alias(f"b{i}"),
        ]
    row = df.agg(*wanted).first()
    out = []
    for i, c in enumerate(df.columns):
        present = row[f"n{i}"]
        if present and row[f"b{i}"] == present:
            out.append(F.lower(quoted(c)).try_cast("boolean").alias(c))
        elif present and row[f"w{i}"] == present == row["rows"]:
            out.append(strip(quoted(c)).try_cast("bigint").alias(c))
        elif row[f"d{i}"] == present:
            out.append(strip(quoted(c)).try_cast("double").alias(c))
        else:
            out.append(quoted(c))
    return df.select(*out)


def load_raw(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, **options)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """CSV with a header in every part, no row numbers; blanks are kept."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)
    return path


def save_interim(df: DataFrame, path: str, *, format: str = "parquet") -> str:
    if format == "csv":
        return write_csv(df, path)
    df.write.mode("overwrite").format(format).save(path)
    return path


def load_interim(spark: SparkSession, path: str, *, format: str = "parquet") -> DataFrame:
    _require_path(spark, path, "interim table")
    if format == "csv":
        return read_csv(spark, path)
    return spark.read.format(format).load(path)


def build_if_absent(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], *, format: str = "parquet"
) -> DataFrame:
    """Reuse a finished table, otherwise build and write it.

    A folder without the writer's success mark is a broken run: it is rebuilt.
    """
    if not path_exists(spark, f"{path}/_SUCCESS"):
        save_interim(build(), path, format=format)
    return load_interim(spark, path, format=format)


_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("log_loss", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("n_samples", T.LongType()),
        T.StructField(
            "support",
            T.StructType(
                [T.StructField("n", T.LongType()), T.StructField("pos_rate", T.DoubleType())]
            ),
        ),
    ]
)


def metrics_frame(spark: SparkSession, metrics: dict[str, Any]) -> DataFrame:
    """Metrics as a one-row table with the columns they have."""
    fields = [f for f in _METRICS_SCHEMA.fields if f.name in metrics]
    unknown = sorted(set(metrics) - {f.name for f in fields})
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    row = tuple(metrics[f.name] for f in fields)
    return spark.createDataFrame([row], T.StructType(fields))


def save_metrics(spark: SparkSession, metrics: dict[str, Any], path: str) -> str:
    """Metrics as indented JSON, in a folder written by Spark."""
    text = json.dumps(metrics, indent=2)
    lines = spark.createDataFrame([(text,)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(path)
    return path


def load_metrics(spark: SparkSession, path: str) -> dict[str, Any]:
    _require_path(spark, path, "metrics")
    row = spark.read.option("multiLine", True).schema(_METRICS_SCHEMA).json(path).first()
    return {name: value for name, value in row.asDict(recursive=True).items() if value is not None}
