"""Column-level building blocks.

Everything here returns a plain ``Column`` made of built-in expressions, so it
stays inside whole-stage code generation.  Two rules hold for every helper:

* a missing number is NULL, never NaN (in Spark ``NaN > 0`` is true);
* every expression is total, because ANSI mode turns a bad cast or a division
  by zero into a failed job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cells that a CSV read treats as missing.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Text accepted as a number or as an infinity.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"^[+-]?(?i:inf|infinity)$"

INFINITY = float("inf")


def strip(col: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def to_number(col: Column, dtype: T.DataType) -> Column:
    """Coerce to double; whatever is not a number becomes NULL."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return nan_to_null(col.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("double")
    text = strip(col.cast("string"))
    accepted = text.rlike(NUMBER_PATTERN) | text.rlike(INFINITY_PATTERN)
    return F.when(accepted, text.try_cast("double"))


def to_token(col: Column) -> Column:
    """Trimmed lower-case text; blank text becomes NULL."""
    return F.nullif(F.lower(strip(col.cast("string"))), F.lit(""))


def markers_to_null(col: Column) -> Column:
    return F.when(~col.isin(*NULL_MARKERS), col)


def holds(predicate: Column) -> Column:
    """A predicate in which missing counts as false."""
    return F.coalesce(predicate, F.lit(False))


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """IEEE division without raising: x/0 is a signed infinity, 0/0 is NULL."""
    by_zero = F.when(numerator > 0, F.lit(INFINITY)).when(numerator < 0, F.lit(-INFINITY))
    return F.when(denominator != 0, numerator / denominator).when(denominator == 0, by_zero)


def log1p(col: Column) -> Column:
    """``log(1 + x)``: -infinity at -1, NULL below it."""
    return F.when(col == -1, F.lit(-INFINITY)).otherwise(F.log1p(col))


def square_root(col: Column) -> Column:
    return F.when(col >= 0, F.sqrt(col))


def band(
    col: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    *,
    include_lowest: bool = True,
) -> Column:
    """Right-closed bands ``(a, b]``; values outside all bands become NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("bands need exactly one label per interval")
    below = col < edges[0] if include_lowest else col <= edges[0]
    out = F.when(below, F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(col <= upper, F.lit(label))
    return out


def quantile_bin(col: Column, edges: Sequence[float]) -> Column:
    """0-based bin of a value among sorted quantile edges.

    Duplicate edges collapse, so equal values always share a bin.  Fewer than
    two distinct edges leave nothing to cut and give NULL.
    """
    distinct = sorted({e for e in edges if e is not None and not math.isnan(e)})
    if len(distinct) < 2:
        return F.lit(None).cast("int")
    passed = F.lit(0)
    for edge in distinct[1:-1]:
        passed = passed + F.when(col > edge, 1).otherwise(0)
    return F.when(col.isNotNull(), passed.cast("int"))


def quoted(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")
