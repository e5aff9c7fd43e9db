"""Impute, scale and one-hot encode: fit once, apply to any table.

A fitted model has a fill value, a centre and a divisor per numeric column, a fill
value per categorical column, and a stored table of categories with their places in
the vector.  Statistics of all columns are gathered together, in two scans.

``transform_df`` gives one column per feature, ``transform_vector`` a sparse vector
for MLlib, ``transform_long`` one row per non-zero entry.  The last two find the
places by joins, so a column may have any number of categories.  The categories of a
column are broadcast if their bytes are few.  Otherwise the hot ones, a bounded number,
are, and the rest is joined by a shuffle in which the rows of hot ones are spread.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import quoted, to_number
from cohort.operators.clean import number_rows
from cohort.operators.features import drop_target_columns
from cohort.operators.lookups import BROADCAST_BYTES, look_up
from cohort.operators.numbers import summarize_numbers
from cohort.operators.statistics import Cell, NumberStats, NumberSummary, Request, gather
from cohort.plans.workspace import materialize
from cohort.sources.tables import path_exists

log = logging.getLogger(__name__)

# Fixed value: the category given to a column without any value.
MISSING_LABEL = "missing"

#: Vectors of up to so many places are dense, and their categories are listed in the plan.
DENSE_WIDTH = 256


def infer_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric columns, and text or boolean columns; other types are ignored."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            categorical.append(f.name)
    return numeric, categorical


infer_column_types = infer_columns


def category_text(df: DataFrame, name: str) -> Column:
    """A category as text; booleans read True and False."""
    col = quoted(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        return F.when(col, "True").when(~col, "False")
    return col.cast("string")


def all_null_columns(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(columns with some value, columns without any), from one aggregate."""
    columns = list(columns)
    if not columns:
        return [], []
    row = df.agg(*[F.count(_value(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    some = [c for i, c in enumerate(columns) if row[f"n{i}"]]
    return some, [c for c in columns if c not in some]


def _value(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    return to_number(quoted(name), dtype) if isinstance(dtype, T.NumericType) else quoted(name)


@dataclass(frozen=True)
class NumericStep:
    name: str
    fill: float
    center: float
    scale: float
    constant: bool = False


@dataclass(frozen=True)
class CategoryStep:
    name: str
    fill: str
    constant: bool = False


class CategoryCounts(Request):
    """How often each category of ``columns`` occurs: place (of the column), category, n."""

    def __init__(self, columns: Sequence[str]) -> None:
        self.columns = list(columns)
        self.counts: DataFrame | None = None

    def cells(self, df: DataFrame) -> list[Cell]:
        texts = [category_text(df, c) for c in self.columns]
        return [
            Cell(F.struct(F.lit(i).alias("place"), text.alias("category")), where=text.isNotNull())
            for i, text in enumerate(texts)
        ]

    def take(self, sums: DataFrame) -> None:
        self.counts, self.settled = sums.select("place", "category", "n"), True


def count_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(place of the column, category, n) of all categorical columns from one scan."""
    request = CategoryCounts(columns)
    gather(df, [request])
    return request.counts


@dataclass(frozen=True)
class PlaceSize:
    """How many categories a column has, their bytes, and the rows they were counted in."""

    categories: int = 0
    bytes: int = 0
    rows: int = 0


def _sizes(table: DataFrame, columns: int) -> list[PlaceSize]:
    found = table.groupBy("place").agg(
        F.count(F.lit(1)).alias("categories"), F.sum(F.octet_length("category") + 32).alias("bytes"),
        F.sum("n").alias("rows"),
    )
    known = {r["place"]: PlaceSize(r["categories"], r["bytes"], r["rows"]) for r in found.collect()}
    return [known.get(i, PlaceSize()) for i in range(columns)]


@dataclass
class PreprocessorModel:
    numeric: list[NumericStep]
    categorical: list[CategoryStep]
    #: (place in ``categorical``, category, n, at): ``at`` is the place in the vector.
    table: DataFrame = field(repr=False)
    sizes: list[PlaceSize]
    broadcast_bytes: int = BROADCAST_BYTES

    @property
    def size(self) -> int:
        return sum(s.categories for s in self.sizes)

    @property
    def input_columns(self) -> list[str]:
        return [s.name for s in self.numeric] + [s.name for s in self.categorical]

    def feature_table(self) -> DataFrame:
        """(at, feature) of the whole vector, however many features there are."""
        spark = self.table.sparkSession
        numeric = spark.createDataFrame(
            [(i, s.name) for i, s in enumerate(self.numeric)], "at long, feature string"
        )
        columns = spark.createDataFrame(
            [(i, s.name) for i, s in enumerate(self.categorical)], "place int, column string"
        )
        named = self.table.join(F.broadcast(columns), "place").select(
            "at", F.concat_ws("_", "column", "category").alias("feature")
        )
        return numeric.unionByName(named)

    def feature_names(self) -> list[str]:
        """All names in one list; ``feature_table`` has them as a table."""
        return [s.name for s in self.numeric] + [
            f"{step.name}_{v}" for step, values in zip(self.categorical, self.listed()) for v in values
        ]

    def listed(self) -> list[list[str]]:
        """The categories of each column in their order."""
        out: list[list[str]] = [[] for _ in self.categorical]
        for r in self.table.orderBy("at").select("place", "category").collect():
            out[r["place"]].append(r["category"])
        return out

    def _check(self, df: DataFrame) -> None:
        absent = [c for c in self.input_columns if c not in df.columns]
        if absent:
            raise ValueError(f"columns are missing: {absent}")

    def scaled(self, df: DataFrame, step: NumericStep) -> Column:
        value = to_number(quoted(step.name), df.schema[step.name].dataType)
        return (F.coalesce(value, F.lit(step.fill)) - step.center) / step.scale

    def filled(self, df: DataFrame, step: CategoryStep) -> Column:
        return F.coalesce(category_text(df, step.name), F.lit(step.fill))

    def transform_df(
        self, df: DataFrame, *, keep: Sequence[str] = (), max_columns: int | None = None
    ) -> DataFrame:
        """One double column per feature, after the columns to keep.

        More of them than ``max_columns``, if given, is an error.
        """
        self._check(df)
        width = len(self.numeric) + self.size
        if max_columns is not None and width > max_columns:
            raise ValueError(
                f"{width} feature columns exceed {max_columns}; "
                "use transform_vector or transform_long"
            )
        listed = self.listed()
        names = [s.name for s in self.numeric]
        values = [self.scaled(df, s) for s in self.numeric]
        for step, categories in zip(self.categorical, listed):
            names += [f"{step.name}_{v}" for v in categories]
            filled = self.filled(df, step)
            values += [(filled == v).cast("double") for v in categories]
        return df.select(
            *[quoted(c) for c in keep], *[v.alias(n) for v, n in zip(values, names)]
        )

    def transform_vector(
        self, df: DataFrame, *, keep: Sequence[str] = (), output: str = "features"
    ) -> DataFrame:
        """The same features as one vector column, sparse if it is wider than ``DENSE_WIDTH``.

        Then each categorical column is joined to its categories by itself, so rows keep
        their identity without a key.  The vector knows its length and no names.
        """
        self._check(df)
        if len(self.numeric) + self.size <= DENSE_WIDTH and all(s.bytes <= self.broadcast_bytes for s in self.sizes):
            dense = self._dense(df).alias(output, metadata={"ml_attr": {"num_attrs": len(self.numeric) + self.size}})
            return df.select(*[quoted(c) for c in keep], dense)
        numbers = [f"_n{i}" for i in range(len(self.numeric))]
        texts = [f"_t{i}" for i in range(len(self.categorical))]
        own = [*numbers, *texts]
        out = df.select(
            F.struct(*[quoted(c) for c in keep], F.lit(0).alias("_")).alias("_kept"),
            *[self.scaled(df, s).alias(n) for s, n in zip(self.numeric, numbers)],
            *[self.filled(df, s).alias(t) for s, t in zip(self.categorical, texts)],
        )
        hots, first = [], len(self.numeric)
        for i, (text, size) in enumerate(zip(texts, self.sizes)):
            known = self.table.where(F.col("place") == i).withColumnsRenamed({"category": text, "at": f"_i{i}"})
            out = look_up(
                out, known, [text], f"_i{i}", spread_by=own, small=size.bytes <= self.broadcast_bytes, counted=size.rows
            )
            # Unknown categories take one more place, which the encoder drops.
            place = F.coalesce(F.col(f"_i{i}") - first, F.lit(size.categories)).cast("double")
            nominal = {"ml_attr": {"type": "nominal", "num_vals": size.categories + 1}}
            out = out.withColumn(f"_i{i}", place.alias(f"_i{i}", metadata=nominal))
            encoder = OneHotEncoder(inputCols=[f"_i{i}"], outputCols=[f"_h{i}"], dropLast=True)
            length = {"ml_attr": {"num_attrs": size.categories}}
            out = encoder.fit(out).transform(out).withColumn(f"_h{i}", F.col(f"_h{i}").alias(f"_h{i}", metadata=length))
            hots, first = [*hots, f"_h{i}"], first + size.categories
        out = VectorAssembler(inputCols=[*numbers, *hots], outputCol=output).transform(out)
        whole = F.col(output).alias(output, metadata={"ml_attr": {"num_attrs": first}})
        return out.select(*[F.col("_kept")[c].alias(c) for c in keep], whole)

    def _dense(self, df: DataFrame) -> Column:
        """The vector of a row as one expression: numbers, then a one or zero per category.

        Spark generates no code for ``transform``, so it splits that of the numbers into
        methods short enough to be compiled.
        """
        numbers = F.array(*[self.scaled(df, s) for s in self.numeric]).cast("array<double>")
        listed = self.listed()
        if not listed:
            return array_to_vector(numbers)
        # Where the ones and zeros of a column begin in its pattern, which has a one in the
        # middle; those of a category that the model does not know have none.
        starts = F.array(*[
            F.lit(len(known) + 1) - F.array_position(F.lit(known), self.filled(df, step)).cast("int")
            for step, known in zip(self.categorical, listed)
        ])
        patterns = F.array(*[F.lit([0.0] * (len(known) - 1) + [1.0] + [0.0] * len(known)) for known in listed])
        lengths = F.lit([len(known) for known in listed])
        ones = F.transform(starts, lambda at, k: F.slice(F.get(patterns, k), at, F.get(lengths, k)))
        return array_to_vector(F.concat(numbers, F.flatten(ones)))

    def transform_long(self, df: DataFrame, *, key: str) -> DataFrame:
        """(key, feature, value) for every non-zero entry of the matrix."""
        self._check(df)
        parts = []
        if self.numeric:
            entries = [
                F.struct(F.lit(s.name).alias("feature"), self.scaled(df, s).alias("value"))
                for s in self.numeric
            ]
            parts.append(df.select(quoted(key), F.inline(F.array(*entries))).where("value <> 0"))
        if self.categorical:
            entries = [
                F.struct(
                    F.lit(i).alias("place"),
                    F.lit(s.name).alias("column"),
                    self.filled(df, s).alias("category"),
                )
                for i, s in enumerate(self.categorical)
            ]
            cells = df.select(quoted(key).alias("_key"), F.inline(F.array(*entries)))
            found = look_up(
                cells, self.table, ["place", "category"], "at", spread_by=["_key"],
                small=sum(s.bytes for s in self.sizes) <= self.broadcast_bytes,
                counted=max(s.rows for s in self.sizes),
            )
            hot = found.where("at is not null").withColumnRenamed("_key", key)
            parts.append(
                hot.select(
                    quoted(key),
                    F.concat_ws("_", "column", "category").alias("feature"),
                    F.lit(1.0).alias("value"),
                )
            )
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def save(self, path: str) -> None:
        spark = self.table.sparkSession
        rows = [
            (i, "numeric", s.name, s.fill, s.center, s.scale, None, s.constant)
            for i, s in enumerate(self.numeric)
        ] + [
            (i, "categorical", s.name, None, None, None, s.fill, s.constant)
            for i, s in enumerate(self.categorical)
        ]
        steps = spark.createDataFrame(rows, _STEP_SCHEMA)
        steps.coalesce(1).write.mode("overwrite").parquet(f"{path}/steps")
        self.table.write.mode("overwrite").parquet(f"{path}/categories")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PreprocessorModel:
        if not path_exists(spark, f"{path}/steps"):
            raise FileNotFoundError(f"preprocessor not found: {path}")
        rows = spark.read.schema(_STEP_SCHEMA).parquet(f"{path}/steps").orderBy("place").collect()
        numeric = [
            NumericStep(r["name"], r["fill"], r["center"], r["scale"], r["constant"])
            for r in rows if r["kind"] == "numeric"
        ]
        categorical = [
            CategoryStep(r["name"], r["label"], r["constant"])
            for r in rows if r["kind"] == "categorical"
        ]
        table = spark.read.schema(_TABLE_SCHEMA).parquet(f"{path}/categories")
        return cls(numeric, categorical, table, _sizes(table, len(categorical)))


_STEP_SCHEMA = (
    "place int, kind string, name string, fill double, center double, scale double, "
    "label string, constant boolean"
)
_TABLE_SCHEMA = "place int, category string, n long, at long"


def fit_preprocessor(
    df: DataFrame,
    *,
    numeric_cols: Sequence[str] | None = None,
    categorical_cols: Sequence[str] | None = None,
    encode_categoricals: bool = True,
    target: str | None = None,
    key: str | None = None,
    quantiles: str = "exact",
) -> PreprocessorModel:
    """Fit on a table; target-derived columns and the key are never features.

    ``encode_categoricals`` is accepted and ignored.
    """
    df = drop_target_columns(df, target)
    if key is not None:
        df = df.drop(key)
    if numeric_cols is None or categorical_cols is None:
        found_numeric, found_categorical = infer_columns(df)
        numeric_cols = found_numeric if numeric_cols is None else numeric_cols
        categorical_cols = found_categorical if categorical_cols is None else categorical_cols
    numeric_cols, categorical_cols = list(numeric_cols), list(categorical_cols)
    if not numeric_cols and not categorical_cols:
        raise ValueError("no columns to preprocess")
    absent = [c for c in [*numeric_cols, *categorical_cols] if c not in df.columns]
    if absent:
        raise ValueError(f"columns are missing: {absent}")

    if quantiles not in ("exact", "approx"):
        raise ValueError(f"unknown quantile method: {quantiles}")
    requests: list[Request] = []
    if categorical_cols:
        requests.append(CategoryCounts(categorical_cols))
    if quantiles == "exact":
        requests.append(NumberStats(numeric_cols, [0.5]))
    gather(df, requests)
    if quantiles == "exact":
        numeric = _fit_numeric(numeric_cols, requests[-1].summaries)
    else:
        numeric = _fit_numeric(numeric_cols, summarize_numbers(df, numeric_cols, [0.5], method=quantiles))
    counts = requests[0].counts if categorical_cols else None
    categorical, table = _fit_categorical(df.sparkSession, counts, categorical_cols, len(numeric))
    empty = [s.name for s in [*numeric, *categorical] if s.constant]
    if empty:
        log.warning("columns without any value are filled with a constant: %s", empty)
    return PreprocessorModel(numeric, categorical, table, _sizes(table, len(categorical)))


def _fit_numeric(columns: list[str], summaries: dict[str, NumberSummary]) -> list[NumericStep]:
    """Median fill, then moments of the filled column in closed form."""
    infinite = [c for c in columns if summaries[c].infinite]
    if infinite:
        raise ValueError(f"columns hold infinite values: {infinite}")
    some, constant = [], []
    for c in columns:
        s = summaries[c]
        if not s.present:
            constant.append(NumericStep(c, 0.0, 0.0, 1.0, constant=True))
            continue
        median = s.quantiles[0.5]
        mean = (s.present * s.mean + s.missing * median) / s.rows
        spread = s.present * (s.var_pop + (s.mean - mean) ** 2)
        spread += s.missing * (median - mean) ** 2
        # Equal values give no spread to scale by, whatever the rounding.
        scale = 1.0 if s.low == s.high else math.sqrt(spread / s.rows)
        some.append(NumericStep(c, median, mean, scale or 1.0))
    return some + constant


def _fit_categorical(
    spark: SparkSession, counts: DataFrame | None, columns: list[str], first: int
) -> tuple[list[CategoryStep], DataFrame]:
    """Most frequent fill (smallest on ties) and the stored table of categories."""
    if counts is None:
        return [], spark.createDataFrame([], _TABLE_SCHEMA)
    rank = F.struct((-F.col("n")).alias("n"), "category")
    modes = {
        r["place"]: r["mode"]
        for r in counts.groupBy("place").agg(F.min(rank)["category"].alias("mode")).collect()
    }
    # Columns with values come first, columns without any after them.
    some = [i for i in range(len(columns)) if i in modes]
    constant = [i for i in range(len(columns)) if i not in modes]
    steps = [CategoryStep(columns[i], modes[i]) for i in some] + [
        CategoryStep(columns[i], MISSING_LABEL, constant=True) for i in constant
    ]
    place = F.lit(None).cast("int")
    for new, old in enumerate(some):
        place = F.when(F.col("place") == old, F.lit(new)).otherwise(place)
    table = counts.select(place.alias("place"), "category", "n")
    if constant:
        rows = [(len(some) + i, MISSING_LABEL, 1) for i in range(len(constant))]
        table = table.unionByName(spark.createDataFrame(rows, "place int, category string, n long"))
    # Numbered over range-sorted partitions: no task orders a whole column.
    numbered = number_rows(table, "at", order_by=["place", "category"], start=first)
    return steps, materialize(numbered.select("place", "category", "n", "at"), "categories")


@dataclass(frozen=True)
class Preprocessor:
    """Column choice without statistics; ``fit`` makes a model of it."""

    numeric_cols: tuple[str, ...]
    categorical_cols: tuple[str, ...]

    def fit(self, df: DataFrame, **options) -> PreprocessorModel:
        return fit_preprocessor(
            df, numeric_cols=self.numeric_cols, categorical_cols=self.categorical_cols, **options
        )


def build_preprocessor(
    *,
    numeric_cols: Sequence[str] | None = None,
    categorical_cols: Sequence[str] | None = None,
    encode_categoricals: bool = True,
) -> Preprocessor:
    return Preprocessor(tuple(numeric_cols or ()), tuple(categorical_cols or ()))


make_preprocessor = build_preprocessor


def transform_df(
    df: DataFrame,
    model: PreprocessorModel,
    *,
    keep: Sequence[str] = (),
    max_columns: int | None = None,
) -> DataFrame:
    return model.transform_df(df, keep=keep, max_columns=max_columns)


def get_feature_names_after_preprocessor(model: PreprocessorModel) -> list[str]:
    return model.feature_names()


def save_preprocessor(model: PreprocessorModel, path: str) -> None:
    model.save(path)


def load_preprocessor(spark: SparkSession, path: str) -> PreprocessorModel:
    return PreprocessorModel.load(spark, path)
