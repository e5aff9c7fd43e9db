"""Exact, seeded, stratified hold-out as a row-wise predicate.

Each row draws the MD5 of ``seed:key``.  Within a class the rows with the
smallest draws are the test rows, so membership depends on the row and the
seed alone, never on partitioning or on how often a task was retried.

The cut of each class is found without sorting it: count rows by the leading
hex digits of the draw, take the one bucket in which the quota is reached, and
go on with the next digits inside that bucket only.  Three digits make a bucket
1/4096 of its class, so the table is read once to count and once to write out
the draws of the boundary buckets; all further rounds read that small table.
The cuts are a stored table with one row per class, found and applied by joins, so
there may be any number of classes.  Where the table is small enough to be broadcast,
the split itself needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.operators import lookups
from cohort.operators.clean import number_rows
from cohort.operators.lookups import look_up
from cohort.plans.workspace import materialize

DIGITS_PER_ROUND = 3
DRAW_DIGITS = 32
_DRAW, _LABEL, _CUT, _TEST = "_cohort_draw", "_cohort_label", "_cohort_cut", "_cohort_test_row"


@dataclass(frozen=True)
class HoldOut:
    """Which draws of each class belong to the test side.

    A cut is the last test prefix of a class, or null when it has no test row.
    ``cut`` is that of all rows, or of the rows without a class when the split is
    stratified; ``cuts`` are those of the classes.
    """

    key: str
    seed: int
    stratify_by: str | None
    cut: str | None
    #: label, n (rows), cut
    cuts: DataFrame | None = None
    rows: int = 0
    small: bool = True
    #: How many rows met each condition that was to be counted on the way.
    counted: dict[str, int] = field(default_factory=dict)

    def marked(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with a boolean column that holds for test rows."""
        draw = row_draw(self.key, self.seed)
        if self.stratify_by is None:
            return df.withColumn(column, _under(draw, F.lit(self.cut)))
        label = quoted(self.stratify_by)
        own = df.withColumns({_DRAW: draw, _LABEL: label})
        cuts = self.cuts.select(F.col("label").alias(_LABEL), "n", F.col("cut").alias(_CUT))
        found = look_up(own, cuts, [_LABEL], _CUT, spread_by=[_DRAW], small=self.small, counted=self.rows)
        cut = F.when(F.col(_LABEL).isNull(), F.lit(self.cut)).otherwise(F.col(_CUT))
        return found.withColumn(column, _under(F.col(_DRAW), cut)).select(*[quoted(c) for c in df.columns], column)

    def test_rows(self, df: DataFrame) -> DataFrame:
        return self.marked(df, _TEST).where(_TEST).drop(_TEST)

    def train_rows(self, df: DataFrame) -> DataFrame:
        return self.marked(df, _TEST).where(~F.col(_TEST)).drop(_TEST)


def row_draw(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), quoted(key).cast("string")).cast("binary"))


def _under(draw: Column, cut: Column) -> Column:
    # Without a cut there is no test row; a row without a key has no draw and trains.
    return F.coalesce(draw.substr(F.lit(1), F.length(cut)) <= cut, F.lit(False))


def share_out(counts: dict[Any, int], total: int) -> dict[Any, int]:
    """Split ``total`` over classes in proportion, largest remainder first."""
    everything = sum(counts.values())
    exact = {c: total * n / everything for c, n in counts.items()}
    out = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (out[c] - exact[c], str(c)))
    for c in by_remainder[: total - sum(out.values())]:
        out[c] += 1
    return out


def _quotas(sizes: DataFrame, test_size: float, stratified: bool) -> DataFrame:
    """label, n, left: how many test rows each class has."""
    rows, classes, least = sizes.agg(F.sum("n"), F.count(F.lit(1)), F.min("n")).first()
    if not rows:
        raise ValueError("cannot split an empty table")
    n_test = math.ceil(test_size * rows)
    n_train = rows - n_test
    if not 0 < test_size < 1 or n_train <= 0:
        raise ValueError(f"test_size={test_size} leaves no training rows out of {rows}")
    if not stratified:
        return sizes.withColumn("left", F.lit(n_test).cast("long"))
    if least < 2:
        raise ValueError("every class needs at least 2 rows for a stratified split")
    if min(n_train, n_test) < classes:
        raise ValueError(f"{n_test} test and {n_train} training rows for {classes} classes")
    return _shares(sizes, n_train, rows).withColumn("left", F.col("n") - F.col("train")).drop("train")


def _shares(sizes: DataFrame, total: int, rows: int) -> DataFrame:
    """``share_out`` over a table (label, n): with a column ``train``."""
    exact = F.lit(total).cast("decimal(19, 0)") * F.col("n").cast("decimal(19, 0)")
    shares = sizes.withColumns({"exact": exact, "rows": F.lit(rows).cast("decimal(19, 0)")}).selectExpr(
        "label", "n", "exact div rows as train", "cast(-(exact % rows) as decimal(19, 0)) as over"
    )
    shares = materialize(shares, "shares")
    extra = total - shares.agg(F.sum("train")).first()[0]
    if not extra:
        return shares.drop("over")
    named = shares.withColumn("name", F.coalesce(F.col("label").cast("string"), F.lit("None")))
    ranked = number_rows(named, "place", order_by=["over", "name"])
    more = (F.col("place") <= extra).cast("long")
    return ranked.select("label", "n", (F.col("train") + more).alias("train"))


def plan_split(
    df: DataFrame,
    target: str,
    *,
    key: str = "id",
    test_size: float = 0.2,
    random_state: int = 42,
    stratify: bool = True,
    count: Mapping[str, Column] | None = None,
) -> HoldOut:
    """Find the cut of each class; ``key`` must identify a row.

    ``count`` names conditions whose rows are counted in the same scan.
    """
    if target not in df.columns:
        raise KeyError(f"target column {target!r} not in the table")
    if key not in df.columns:
        raise KeyError(f"key column {key!r} not in the table")
    label = quoted(target) if stratify else F.lit(None).cast("string")
    draws = df.select(label.alias("label"), row_draw(key, random_state).alias("draw"))
    # The first histogram also yields the class sizes and missing keys: one scan for all.
    asked = list((count or {}).items())
    conditions = [c.alias(f"c{k}") for k, (_, c) in enumerate(asked)]
    watched = df.select(label.alias("label"), row_draw(key, random_state).alias("draw"), *conditions)
    histogram = materialize(_buckets(watched, DIGITS_PER_ROUND, *[f"c{k}" for k in range(len(asked))]), "draws")
    if not histogram.where("bucket is null").isEmpty():
        raise ValueError(f"key column {key!r} has missing values; it must identify every row")
    sums = histogram.agg(F.count(F.lit(1)), *[F.sum(f"c{k}") for k in range(len(asked))]).first()
    counted = {name: n or 0 for (name, _), n in zip(asked, sums[1:])}
    sizes = histogram.groupBy("label").agg(F.sum("n").alias("n"))
    quotas = materialize(_quotas(sizes, test_size, stratify), "quotas")

    settled = quotas.where("left = 0").select("label", F.lit(None).cast("string").alias("cut"))
    # Classes still searched, with the rows still to be taken.
    searched = quotas.where("left > 0").select("label", "left")
    digits = DIGITS_PER_ROUND
    while True:
        found = materialize(_boundaries(histogram, searched), "boundaries")
        settled = settled.unionByName(found.where("taken = left").select("label", F.col("bucket").alias("cut")))
        searched = found.where("taken > left").select("label", "bucket", (F.col("left") - F.col("taken") + F.col("n")).alias("left"))
        some = [r["label"] for r in searched.limit(3).collect()]
        if not some:
            break
        if digits == DRAW_DIGITS:
            raise ValueError(
                f"{key!r} does not identify rows: an exact split would have to cut "
                f"through rows that share one key (classes {some} and perhaps more)"
            )
        open_buckets = searched.select(F.col("label").alias("own"), F.col("bucket").alias("prefix"))
        inside = F.col("label").eqNullSafe(F.col("own")) & (F.substring("draw", 1, digits) == F.col("prefix"))
        draws = draws.join(open_buckets, inside, "left_semi")
        if digits == DIGITS_PER_ROUND:
            draws = materialize(draws, "boundary")
        digits = min(digits + DIGITS_PER_ROUND, DRAW_DIGITS)
        histogram = _buckets(draws, digits)
        searched = searched.select("label", "left")

    found = settled.withColumnRenamed("label", "own")
    cuts = quotas.join(found, F.col("label").eqNullSafe(F.col("own"))).select("label", "n", "cut")
    cuts = materialize(cuts, "cuts")
    without = cuts.where("label is null").first()
    width = F.coalesce(F.octet_length(F.col("label").cast("string")), F.lit(0)) + 64
    rows, size = cuts.agg(F.sum("n"), F.sum(width)).first()
    cut = None if without is None else without["cut"]
    if not stratify:
        return HoldOut(key, random_state, None, cut, rows=rows, counted=counted)
    return HoldOut(
        key, random_state, target, cut, cuts.where("label is not null"), rows, size <= lookups.BROADCAST_BYTES, counted
    )


def _buckets(draws: DataFrame, digits: int, *conditions: str) -> DataFrame:
    """Rows per class and leading digits of the draw."""
    bucket = F.substring("draw", 1, digits).alias("bucket")
    return draws.groupBy("label", bucket).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c)).alias(c) for c in conditions]
    )


def _boundaries(histogram: DataFrame, searched: DataFrame) -> DataFrame:
    """Per searched class: the bucket in which its quota is reached."""
    # At most 16^DIGITS_PER_ROUND buckets per class reach this window.
    so_far = Window.partitionBy("label").orderBy("bucket")
    taken = histogram.withColumn("taken", F.sum("n").over(so_far))
    reached = (F.col("taken") >= F.col("left")) & (F.col("taken") - F.col("n") < F.col("left"))
    own = searched.select(F.col("label").alias("own"), "left")
    return (
        taken.join(own, F.col("label").eqNullSafe(F.col("own"))).where(reached)
        .select("label", "bucket", "n", "taken", "left")
    )


def train_test_split_safe(
    df: DataFrame,
    target: str,
    test_size: float = 0.2,
    random_state: int = 42,
    stratify: bool = True,
    *,
    key: str = "id",
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """X_train, X_test, y_train, y_test; X and y both carry the key."""
    split = plan_split(
        df, target, key=key, test_size=test_size, random_state=random_state, stratify=stratify
    )
    test, train = split.test_rows(df), split.train_rows(df)
    labels = [quoted(key), quoted(target)]
    return train.drop(target), test.drop(target), train.select(*labels), test.select(*labels)


def mark_split(df: DataFrame, target: str, *, column: str = "split", **options) -> DataFrame:
    """The table with a column that says ``train`` or ``test``."""
    split = plan_split(df, target, **options)
    return split.marked(df, _TEST).withColumn(column, F.when(F.col(_TEST), "test").otherwise("train")).drop(_TEST)
