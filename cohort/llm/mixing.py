"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the corpus divided by
its share now.  Each document draws a uniform number from a hash of the seed and
its id, inverts the Poisson distribution of its source with it, and appears that
many times (0 included).  Expected sizes meet the targets exactly, every draw is
reproducible on any cluster, and no source has to be counted out row by row.
The copies are then dealt over all partitions by a hash and sorted by it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.shared import materialize

#: Target share of a source ~ (its size) ** TEMPERATURE; 1 leaves the mix as it is.
TEMPERATURE = 0.5
SEED = "mix-1"
#: 13 hex digits of a hash make a number below 2 ** 52.
_DIGITS, _SPAN = 13, float(2**52)


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the parts only."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    head = F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double")
    return (head + 0.5) / _SPAN


def source_rates(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """source, size in bytes (one more per document), target share, mean rate.

    ``weights`` are relative; a source that is not named has weight 0.  Without
    them the target share of a source is proportional to size ** temperature.
    """
    sizes = docs.groupBy(quoted(source_col).alias("mix_source")).agg(
        F.sum(F.coalesce(F.octet_length(quoted(text_col)), F.lit(0)).cast("long") + 1).alias("mix_size")
    )
    if weights is None:
        weight = F.pow(F.col("mix_size").cast("double"), F.lit(float(temperature)))
    else:
        if any(not (math.isfinite(w) and w >= 0) for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("mix_source") == name, F.lit(float(value))).otherwise(weight)
    sized = materialize(sizes.withColumn("mix_weight", weight), "source-sizes")
    whole = sized.agg(F.sum("mix_size").alias("n"), F.sum("mix_weight").alias("w")).first()
    if weights is not None and whole["n"] and not whole["w"]:
        raise ValueError("no source has a positive weight")
    share = F.col("mix_weight") / F.lit(whole["w"] or 1.0)
    return sized.select(
        "mix_source",
        "mix_size",
        share.alias("mix_share"),
        (share * F.lit(float(whole["n"] or 0)) / F.col("mix_size")).alias("mix_rate"),
    )


def _log_factorial(k: Column) -> Column:
    """ln k! by Stirling's series; from 20 on its error is below the spacing of doubles."""
    series = 1 / (12 * k) - 1 / (360 * k * k * k) + 1 / (1260 * F.pow(k, F.lit(5.0)))
    return k * F.log(k) - k + F.log(2 * math.pi * k) / 2 + series


def poisson_steps(rates: DataFrame) -> DataFrame:
    """mix_source, mix_first and mix_steps: P(X <= k) for k = mix_first, ... of a Poisson
    variable of mean mix_rate, stored.

    Numbers that are 12 deviations and 30 below the mean or above it are left out, so
    there are about 24 sqrt(rate) + 60 steps.  Terms are computed from logarithms, so
    large rates do not underflow.
    """
    rate = F.col("mix_rate")
    reach = F.floor(12.0 * F.sqrt(rate)) + 30
    first = F.greatest(F.floor(rate) - reach, F.lit(0).cast("long"))
    wide = (
        rates.filter(rate > 0).select("mix_source", "mix_rate", first.alias("mix_first"))
        .withColumn("k", F.explode(F.sequence("mix_first", F.ceil(rate) + reach)))
    )
    # One row per step of a source.
    upto = Window.partitionBy("mix_source").orderBy("k")
    k = F.col("k").cast("double")
    base = F.when(F.col("mix_first") > 0, _log_factorial(F.greatest("mix_first", F.lit(1)).cast("double"))).otherwise(0.0)
    own = F.when(F.col("k") > F.col("mix_first"), F.log(F.greatest(k, F.lit(1.0)))).otherwise(0.0)
    sums = (
        wide.withColumn("fact", base + F.sum(own).over(upto))
        .withColumn("p", F.sum(F.exp(k * F.log(rate) - rate - F.col("fact"))).over(upto))
        .groupBy("mix_source", "mix_first")
        .agg(F.array_sort(F.collect_list(F.struct("k", "p"))).alias("all"))
        .select("mix_source", "mix_first", F.transform("all", lambda s: s["p"]).alias("mix_steps"))
    )
    never = rates.filter(~(rate > 0)).select(
        "mix_source", F.lit(0).cast("long").alias("mix_first"), F.array(F.lit(1.0)).alias("mix_steps")
    )
    return materialize(sums.unionByName(never), "poisson-steps")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
    seed: str = SEED,
) -> DataFrame:
    """All columns of ``docs`` plus mix_repeats, mix_copy (from 0) and mix_key.

    A row appears mix_repeats times, rows dealt over the partitions by a hash of
    mix_key and in its order within each.  A null source is a
    source of its own, a null or empty text has size one.  Rows that repeat an
    id draw the same number; rows without an id draw by a hash of their text, a null
    text as an empty one.  Columns named mix_* in ``docs`` are refused.  An
    empty table gives an empty result.
    """
    clash = [c for c in docs.columns if c.lower().startswith("mix_")]
    if clash:
        raise ValueError(f"columns {clash} clash with those of the result")
    rates = source_rates(docs, source_col, text_col, weights, temperature)
    steps = poisson_steps(rates)
    by_text = F.concat(F.lit("text:"), F.md5(F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary")))
    name = F.coalesce(quoted(id_col).cast("string"), by_text)
    passed = F.size(F.filter("mix_steps", lambda p: p < F.col("mix_uniform")))
    drawn = (
        docs.withColumns({"mix_name": name, "mix_uniform": uniform(seed, name)})
        .join(steps, quoted(source_col).eqNullSafe(F.col("mix_source")))
        .withColumn("mix_repeats", F.when(passed > 0, passed + F.col("mix_first")).otherwise(0).cast("int"))
        .filter(F.col("mix_repeats") > 0)
        .withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("mix_repeats") - 1)))
    )
    key = F.md5(
        F.concat_ws(
            ":", F.lit(seed), F.lit("order"), F.col("mix_name"), F.col("mix_copy").cast("string"),
        )
    )
    keyed = drawn.withColumn("mix_key", key).drop("mix_source", "mix_first", "mix_steps", "mix_name", "mix_uniform")
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")
