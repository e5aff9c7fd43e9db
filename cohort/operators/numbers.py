"""Numeric summaries: moments and quantiles of several columns.

Exact ones are gathered by ``NumberStats`` in two scans (one if no quantile is
wanted).  Approximate ones take one scan and a sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted, to_number
from cohort.operators.statistics import FETCH_ROWS, NumberStats, NumberSummary, gather

SKETCH_ACCURACY = 1_000


def summarize_numbers(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = (),
    *,
    method: str = "exact",
    fetch_rows: int = FETCH_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, NumberSummary]:
    """Counts, moments and quantiles of several columns.

    ``method="approx"`` takes the quantiles from a sketch of that accuracy.
    """
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown quantile method: {method}")
    if method == "approx" and probabilities:
        return _approximate(df, list(columns), list(probabilities), accuracy)
    stats = NumberStats(columns, probabilities, fetch_rows)
    gather(df, [stats])
    return stats.summaries


def _approximate(
    df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int
) -> dict[str, NumberSummary]:
    types = {f.name: f.dataType for f in df.schema.fields}
    # One (place, x) pair per cell: the generated code stays short however many
    # columns there are, and the merge of partial results spreads over places.
    cells = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("place"), to_number(quoted(c), types[c]).alias("x"))
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    rows = cells.groupBy("place").agg(
        F.count(F.lit(1)).alias("rows"), F.count("x").alias("present"), F.min("x").alias("low"),
        F.max("x").alias("high"), F.avg("x").alias("mean"), F.var_pop("x").alias("var_pop"),
        F.percentile_approx("x", probabilities, accuracy).alias("quantiles"),
    )
    found = {r["place"]: r for r in rows.collect()}
    out = {}
    for i, c in enumerate(columns):
        if (r := found.get(i)) is None:
            out[c] = NumberSummary(0, 0, None, None, None, None, dict.fromkeys(probabilities))
            continue
        values = r["quantiles"] or [None] * len(probabilities)
        moments = (r[k] for k in ("rows", "present", "low", "high", "mean", "var_pop"))
        out[c] = NumberSummary(*moments, dict(zip(probabilities, values)))
    return out


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], **options
) -> list[float | None]:
    """Linear-interpolated quantiles of one column."""
    found = summarize_numbers(df, [column], probabilities, **options)[column]
    return [found.quantiles[p] for p in probabilities]
