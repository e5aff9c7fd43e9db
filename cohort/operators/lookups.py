"""Joins with a table of one row per key that may be too large to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a table that may be broadcast as a whole.
BROADCAST_BYTES = 32 << 20
#: A key is hot when it has more than this share of the rows, and is not too long.
HOT_SHARE, HOT_BYTES = 1e-4, 1_024
#: Over how many keys the rows of hot keys are spread.
SPREAD = 1 << 20


def look_up(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], value: str, *,
    spread_by: Sequence[str | Column], small: bool, counted: int, hot_share: float | None = None,
) -> DataFrame:
    """``rows`` with the ``value`` that ``table`` has for their ``keys``, null if none.

    ``table`` has the keys, the value and ``n``, how many of ``counted`` rows have
    the key.  If it is not ``small``, its hot keys (a bounded number) are broadcast
    and the rest is joined by a shuffle, in which the rows of hot keys and those
    without a key are spread by a hash of ``spread_by``.
    """
    keys = list(keys)
    if small:
        return rows.join(F.broadcast(table.select(*keys, value)), keys, "left")
    length = sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(0))
    share = HOT_SHARE if hot_share is None else hot_share
    marked = table.withColumn("_hot", (F.col("n") > counted * share) & (length <= HOT_BYTES))
    few = marked.where("_hot").select(*keys, F.col(value).alias("_of_hot"), F.lit(True).alias("_is_hot"))
    # Always 0, but no constant: Spark would take a constant out of the join's keys.
    no_salt = F.pmod(F.col("n"), F.lit(1)).alias("_salt")
    many = marked.where(~F.col("_hot")).select(*keys, no_salt, F.col(value).alias("_of_cold"))
    apart = F.coalesce("_is_hot", F.lit(False))
    for k in keys:
        apart = apart | F.col(k).isNull()
    salt = F.when(apart, 1 + F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD))).otherwise(F.lit(0).cast("long"))
    # Rows apart match nothing below, so they may have any key.
    return (
        rows.join(F.broadcast(few), keys, "left")
        .withColumn("_salt", salt)
        .join(many, [*keys, "_salt"], "left")
        .withColumn(value, F.coalesce("_of_hot", "_of_cold"))
        .drop("_salt", "_of_hot", "_is_hot", "_of_cold")
    )
