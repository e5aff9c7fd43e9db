"""Group-wise mode and the fill of missing values from it.

Counting by (group, value) merges equal pairs before the shuffle, so a group
that holds a third of the table still reaches the reducers as a few rows per
map task, and no buffer ever holds all values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import nan_to_null, quoted
from cohort.operators.statistics import Deferred, GroupCounts
from cohort.plans.workspace import materialize

BROADCAST_BYTES = 64 << 20
# A group counts as hot when it holds more than this share of the rows to fill.
HOT_SHARE = 1e-4

_MODE = "_cohort_mode"
_NEED = "_cohort_need"


def _clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    floats = [c for c in columns if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(quoted(c)) for c in floats})


def _pick_mode(value: str):
    """Most frequent value, the smallest one on a tie, over counted values."""
    rank = F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))
    return F.min(F.when(F.col(value).isNotNull(), rank))["v"]


def global_mode(df: DataFrame, value: str) -> DataFrame:
    """One row with the mode of a column; NULL when nothing is present."""
    counts = _clean(df.select(quoted(value)), [value]).groupBy(value).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.agg(_pick_mode(value).alias(value))


def group_modes(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Mode of ``value`` per group; rows with a missing key form no group."""
    counts = _count_pairs(df, value, keys)
    return (
        counts.groupBy(*keys)
        .agg(_pick_mode(value).alias("mode"))
        .dropna(subset=list(keys))
    )


def _count_pairs(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    columns = [*keys, value]
    slim = _clean(df.select(*[quoted(c) for c in columns]), columns)
    return slim.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class GroupFill:
    """Fitted fill: value, else mode of its group, else global mode."""

    value: str
    keys: tuple[str, ...]
    modes: DataFrame
    fallback: Any
    small: bool
    hot_rows: float

    @classmethod
    def deferred(cls, value: str, keys: Sequence[str], **options) -> Deferred:
        """The fill once its counts are gathered."""
        request = GroupCounts([*keys, value])
        return Deferred([request], lambda: cls.of(request.counts, value, keys, **options))

    @classmethod
    def fit(cls, df: DataFrame, value: str, keys: Sequence[str], **options) -> GroupFill:
        return cls.deferred(value, keys, **options).now(df)

    @classmethod
    def of(
        cls, counts: DataFrame, value: str, keys: Sequence[str], *, broadcast_bytes: int = BROADCAST_BYTES
    ) -> GroupFill:
        """From a stored table of (keys, value, n)."""
        keys = tuple(keys)
        # What a row of modes holds in memory: text by its length, plus words.
        width = F.lit(16 * (len(keys) + 1))
        for name in (*keys, value):
            width = width + F.coalesce(F.length(F.col(name).cast("string")), F.lit(0))
        size = (
            counts.groupBy(value)
            .agg(F.sum("n").alias("n"), F.sum(width).alias("bytes"))
            .agg(
                _pick_mode(value).alias("fallback"),
                F.sum("bytes").alias("bytes"),
                F.sum(F.when(F.col(value).isNull(), F.col("n"))).alias("need"),
            )
            .first()
        )
        need = F.sum(F.when(F.col(value).isNull(), F.col("n")))
        modes = (
            counts.groupBy(*keys)
            .agg(_pick_mode(value).alias(_MODE), F.coalesce(need, F.lit(0)).alias(_NEED))
            .dropna(subset=[*keys, _MODE])
        )
        # There are at most as many groups as counted pairs.
        small = (size["bytes"] or 0) <= broadcast_bytes
        return cls(
            value=value,
            keys=keys,
            modes=modes if small else materialize(modes, f"modes-{value}"),
            fallback=size["fallback"],
            small=small,
            hot_rows=(size["need"] or 0) * HOT_SHARE,
        )

    def stored(self) -> tuple[dict[str, Any], dict[str, DataFrame]]:
        """What ``restored`` makes the same fill of: plain values and tables."""
        fallback = self.modes.sparkSession.range(1).select(
            F.lit(self.fallback).cast(self.modes.schema[_MODE].dataType).alias("fallback")
        )
        plain = {"value": self.value, "keys": list(self.keys), "small": self.small, "hot_rows": self.hot_rows}
        return plain, {"modes": self.modes, "fallback": fallback}

    @classmethod
    def restored(cls, plain: dict[str, Any], tables: dict[str, DataFrame]) -> GroupFill:
        return cls(
            plain["value"], tuple(plain["keys"]), tables["modes"], tables["fallback"].first()[0],
            plain["small"], plain["hot_rows"],
        )

    def transform(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        df = _clean(df, [*self.keys, self.value])
        keys, value = list(self.keys), quoted(self.value)
        dtype = df.schema[self.value].dataType
        filled = F.coalesce(value, F.col(_MODE), F.lit(self.fallback)).cast(dtype)

        def finish(joined: DataFrame) -> DataFrame:
            return joined.select(
                *[filled.alias(c) if c == self.value else quoted(c) for c in columns]
            )

        if self.small:
            return finish(df.join(F.broadcast(self.modes.drop(_NEED)), keys, "left"))

        # Too many groups to broadcast: shuffle only the rows that need a group,
        # and take the hot groups, at most 1/HOT_SHARE of them, out of that.
        needs = value.isNull()
        for k in keys:
            needs = needs & quoted(k).isNotNull()
        hot = F.broadcast(self.modes.where(F.col(_NEED) > self.hot_rows).drop(_NEED))
        cold = self.modes.where(F.col(_NEED) <= self.hot_rows).drop(_NEED)
        open_rows = df.where(needs)
        settled = df.where(~needs).withColumn(_MODE, F.lit(None).cast(dtype))
        in_hot = open_rows.join(hot, keys, "inner")
        in_cold = open_rows.join(hot, keys, "left_anti").join(cold, keys, "left")
        return finish(settled.unionByName(in_hot).unionByName(in_cold))
