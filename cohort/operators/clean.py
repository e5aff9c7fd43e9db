"""Cleanup of a raw table: names, numbers, text, copies, row ids."""

from __future__ import annotations

import logging
import re
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort.functions.values import quoted, to_number, to_token
from cohort.plans.workspace import materialize

log = logging.getLogger(__name__)

# Columns the cleanup reads as numbers when they are present.
NUMERIC_COLUMNS = (
    "annual_income_usd", "smokes_per_day", "drinks_per_week", "children_count",
    "attempts_to_quit_smoking", "attempts_to_quit_drinking", "sleep_hours",
    "bmi", "social_support", "smoking_rate_pct",
)

# Columns the cleanup standardises as text when they are present.
TEXT_COLUMNS = (
    "gender", "education_level", "employment_status", "marital_status",
    "mental_health_status", "exercise_frequency", "diet_quality", "state", "name",
)


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim names, turn inner whitespace into underscores, lower the case."""
    names = [re.sub(r"\s+", "_", c.strip()).lower() for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"column names collide after normalisation: {clashes}")
    return df.toDF(*names)


def coerce_numeric(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Listed columns that exist become doubles; anything else in them NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in types]
    return df.withColumns({c: to_number(quoted(c), types[c]) for c in present})


def standardize_strings(df: DataFrame, columns: Iterable[str] = TEXT_COLUMNS) -> DataFrame:
    """Listed columns that exist become trimmed lower-case text."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_token(quoted(c)) for c in present})


def drop_copies(df: DataFrame) -> DataFrame:
    """Exact de-duplication over all columns; missing equals missing.

    Equal rows are merged before the shuffle, so a row with very many copies
    costs each map task one output row.
    """
    return df.dropDuplicates()


def count_copies(df: DataFrame) -> DataFrame:
    """One row: rows before, rows after, rows dropped by ``drop_copies``."""
    groups = df.groupBy(*[quoted(c) for c in df.columns]).agg(
        F.count(F.lit(1)).alias("copies")
    )
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("dropped"),
    )


def number_rows(
    df: DataFrame,
    column: str,
    *,
    order_by: Sequence[str] | None = None,
    start: int = 1,
) -> DataFrame:
    """Add a dense row number as the first column.

    The default order is by all columns, which is reproducible; pass
    ``order_by=[]`` to number the rows as they are stored, without a sort.

    The rows are range-sorted and written once together with their place in
    their sort partition.  Only the row count of each partition is summed up
    across partitions; no task ever sees more than its own range.
    """
    part, place, copy = "_cohort_part", "_cohort_place", "_cohort_copy"
    keys = df.columns if order_by is None else list(order_by)
    ordered = df
    if keys:
        # The other columns break ties, so that a hot key still splits by range;
        # copies of one row are interchangeable and split by their place.
        ties = [c for c in df.columns if c not in keys]
        order = [quoted(c).asc_nulls_last() for c in [*keys, *ties]]
        ordered = df.withColumn(copy, F.monotonically_increasing_id()).orderBy(*order, copy).drop(copy)
    in_part = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    stored = materialize(
        ordered.withColumns({part: F.spark_partition_id(), place: in_part}), "numbered"
    )
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("_cohort_size"))
    # One row per partition of the sort, so this window stays small.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        part, F.coalesce(F.sum("_cohort_size").over(before), F.lit(0)).alias("_cohort_offset")
    )
    number = F.col("_cohort_offset") + F.col(place) + start
    return stored.join(F.broadcast(offsets), part).select(
        number.cast("bigint").alias(column), *[quoted(c) for c in df.columns]
    )


def ensure_id(
    df: DataFrame, column: str = "id", *, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Keep an existing id column, otherwise number the rows 1..n."""
    if column in df.columns:
        return df
    return number_rows(df, column, order_by=order_by, start=1)


def basic_cleanup(
    df: DataFrame,
    *,
    numeric_columns: Iterable[str] = NUMERIC_COLUMNS,
    text_columns: Iterable[str] = TEXT_COLUMNS,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Names, numbers, text, exact copies, row id, in that order."""
    out = normalize_names(df)
    out = coerce_numeric(out, numeric_columns)
    out = standardize_strings(out, text_columns)
    return ensure_id(drop_copies(out), order_by=order_by)
