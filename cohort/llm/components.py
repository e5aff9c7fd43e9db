"""Connected components of a graph too large for one machine.

Large-star and small-star steps alternate until every node points at the least
node of its component.  Both are a minimum per node and a join back; the graph is
written to the shared folder after each round, so a lost executor costs one
round.  Hubs are safe: minima are combined before the exchange, and the joins
are plain equi-joins whose large partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.shared import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of ``edges`` (a, b) that is not its own least.

    Edges have no direction; loops, repeats and nulls do not matter.
    """
    graph = materialize(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "graph",
    )
    while not _is_stars(graph):
        graph = materialize(_small_star(_large_star(graph)), "graph")
    return graph.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _is_stars(graph: DataFrame) -> bool:
    """Whether every node has one neighbour below it or none, and none in between."""
    ends = graph.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")),
            )
        ).alias("end")
    ).select("end.*")
    per_node = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return per_node.filter((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))).isEmpty()


def _large_star(graph: DataFrame) -> DataFrame:
    """Neighbours above a node are tied to the least of the node and its neighbours."""
    both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(graph: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the least of these."""
    least = graph.groupBy("u").agg(F.min("v").alias("m"))
    return (
        graph.join(least, "u")
        .select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        .select("e.*")
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
