"""Exact searches by inner product: queries meet shards of vectors.

Vectors become whole numbers, so scores are exact.  They are clustered (a codebook
fitted to a bounded sample) and dealt into shards of bounded size; a large cluster,
or one vector that fills a third of the table, is dealt over several shards.  Queries
of one home shard form crews, which go through a shard together.

A search has two rounds.  Every query first meets its home shard, which gives a lower
bound of its k-th score; then the other shards whose summary allows such a score.
Summaries meet the queries in packs, the way shards do.  A task holds one shard (or
pack) and one crew at a time.  How a crew goes through a shard is what the searches
differ in (``Guide``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cohort.functions.values import quoted
from cohort.llm.embedding_dedup import codebook
from cohort.llm.shared import attach, id_type, materialize

#: Components of the vectors of one shard, of the sample, and rows of the sample, about.
SHARD_VALUES, SAMPLE_VALUES, SAMPLE = 1 << 19, 1 << 22, 8_192
CLUSTERS = 256
#: Queries of a crew, queries that meet one shard in one task, summaries of a pack, about.
CREW, VISITORS, PACK = 256, 20_000, 1_024
#: Scores of longer vectors need not fit in 64 bits.
LONGEST = float(1 << 31)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, scale: int, asks: Column | str, **more: Column
) -> DataFrame:
    """row, vec_id, v, d, asks and ``more``: a stored row for each vector that takes part.

    v is floor(scale * x) of each component x.  A vector that is null or empty, that
    holds null or non-finite components, or whose v is 2^31 long or longer takes no
    part.  ``row`` is a number of its own for each row.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    asked = F.expr(asks) if isinstance(asks, str) else asks
    rows = (
        vectors.select(
            F.monotonically_increasing_id().alias("row"), quoted(id_col).alias("vec_id"),
            quoted(vector_col).alias("v"), F.coalesce(asked, F.lit(False)).alias("asks"),
            *[c.alias(name) for name, c in more.items()],
        )
        .filter(F.coalesce(finite & (F.size("v") > 0), F.lit(False)))
        .withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale)))
        .filter(squares < LONGEST**2)
        .withColumn("d", F.size("v"))
    )
    return _clustered(materialize(rows, "whole-vectors"))


def _clustered(rows: DataFrame) -> DataFrame:
    """``rows`` with a cluster, which is 0 for all vectors but those of the most frequent length."""
    sizes = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    clusters = 1 if sizes is None else min(CLUSTERS, -(-sizes["n"] * sizes["d"] // SHARD_VALUES))
    if clusters == 1:
        return rows.withColumn("cluster", F.lit(0))
    d = sizes["d"]
    sample = rows.filter(F.col("d") == d).orderBy(F.xxhash64("row"), "row").select("v")
    points = unit(matrix(sample.limit(min(SAMPLE, SAMPLE_VALUES // d + 1)).toArrow()["v"]).astype(float))
    book = rows.sparkSession.sparkContext.broadcast(codebook(points, clusters, np.random.default_rng(5)))
    at = rows.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int32)
            alike = pc.list_value_length(batch.column(at)).to_numpy(zero_copy_only=False) == d
            if alike.any():
                own = unit(matrix(batch.column(at).filter(pa.array(alike))).astype(float))
                found[alike] = (own @ book.value.T - (book.value**2).sum(axis=1) / 2).argmax(axis=1)
            yield batch.append_column("cluster", pa.array(found))

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("cluster", IntegerType())]))


def in_shards(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with a shard, stored; shards hold one length, cluster and value of ``by``."""
    keys = [*by, "d", "cluster"]
    rows = materialize(rows, "clusters")
    groups = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "cluster-sizes")
    each = F.greatest(F.lit(64), F.lit(SHARD_VALUES) / F.col("d"))
    part = F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / each))
    dealt = attach(rows, groups, keys, "n").withColumn("shard", F.xxhash64(*keys, part))
    return materialize(dealt.drop("n", "cluster"), "shards")


def crews(shards: DataFrame) -> DataFrame:
    """The rows that ask, with crew and one goal without limits."""
    asking = shards.filter("asks")
    sizes = asking.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / CREW).alias("pieces"))
    crew = F.xxhash64("shard", F.pmod(F.xxhash64(F.lit("crew"), "row"), "pieces"))
    open_goal = F.struct(
        F.lit(0).cast("long").alias("goal"), F.lit(MOST).alias("upper"), F.lit(LEAST).alias("lower")
    )
    return asking.join(sizes, "shard").withColumn("crew", crew).withColumn("goals", F.array(open_goal)).drop("pieces")


def matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero rows stay."""
    length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


class Vectors:
    """The whole-number vectors of some rows, and the order of their ids."""

    def __init__(self, rows: pa.StructArray) -> None:
        self.rows = rows
        self.row = rows.field("row").to_numpy()
        self.ids = rows.field("vec_id")
        self.whole = matrix(rows.field("v"))
        self.real = self.whole.astype(np.float64)
        self.length = np.sqrt((self.real**2).sum(axis=1))
        self.longest = float(self.length.max(initial=0))
        #: Places by id, smallest first, null last; equal ids by row.
        order = pc.sort_indices(
            pa.table({"id": self.ids, "row": rows.field("row")}), sort_keys=[("id", "ascending"), ("row", "ascending")]
        ).to_numpy()
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))

    def __len__(self) -> int:
        return len(self.row)


def scores(one: Vectors, at, other: Vectors, there) -> np.ndarray:
    """Inner products; lengths under 2^31 keep them within 64 bits."""
    if one.longest * other.longest < 2**53:
        return (one.real[at] @ other.real[there].T).astype(np.int64)
    return one.whole[at] @ other.whole[there].T


class Guide:
    """How crews go through shards."""

    def prepare(self, rows: pa.StructArray):
        """What a task keeps of a shard."""
        raise NotImplementedError

    def summary(self, state) -> tuple[np.ndarray, np.ndarray]:
        """Two arrays of numbers that tell which scores a shard can hold."""
        raise NotImplementedError

    def bounds(self, first: np.ndarray, second: np.ndarray, crew: Vectors) -> np.ndarray:
        """The highest score of each of the crew in each summarised shard, or more."""
        raise NotImplementedError

    def walk(self, state, crew: Vectors, owner, goal, upper, lower) -> Iterator[tuple]:
        """(goal's place, places in the shard, scores): the first k for each goal with
        scores of ``lower`` to ``upper``; ``owner`` is the place in the crew."""
        raise NotImplementedError


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Sorted rows cut where ``keys`` change; a run may come in pieces."""
    for batch in batches:
        if batch.num_rows:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows - 1, bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            ends = np.append(np.flatnonzero(change) + 1, batch.num_rows).tolist()
            for a, b in zip([0, *ends], ends):
                yield tuple(c[a] for c in columns), batch.slice(a, b - a)


def _whole_runs(batches, keys):
    for key, pieces in groupby(_runs(batches, keys), key=lambda run: run[0]):
        yield key, [piece for _, piece in pieces]


def meet(shards: DataFrame, visitors: DataFrame, prepare, work, schema: str) -> DataFrame:
    """``work(prepare(rows), crew)`` for each shard and each crew that visits it.

    Both are stored tables.  A shard with more than ``VISITORS`` visitors is given to
    several tasks, whole crews to each.
    """
    inside = F.struct(*[c for c in shards.columns if c != "shard"])
    asking = F.struct(*[c for c in visitors.columns if c not in ("shard", "crew")])
    visits = materialize(visitors.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "visits")
    own, other, deal, theirs = shards, visitors, F.lit(0), F.lit(0)
    if not visits.filter(F.col("n") > VISITORS).isEmpty():
        deals = visits.select("shard", F.ceil(F.col("n") / VISITORS).cast("int").alias("deals"))
        own, other = shards.join(deals, "shard"), visitors.join(deals, "shard")
        deal = F.explode(F.sequence(F.lit(0), F.col("deals") - 1))
        theirs = F.pmod(F.xxhash64("crew"), "deals").cast("int")
    here = own.select(
        "shard", deal.alias("deal"), F.lit(False).alias("visitor"), F.lit(0).cast("long").alias("crew"),
        inside.alias("inside"),
    )
    there = other.select("shard", theirs.alias("deal"), F.lit(True).alias("visitor"), "crew", asking.alias("asking"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = at = None
        for (shard, part, visitor, _), pieces in _whole_runs(batches, ["shard", "deal", "visitor", "crew"]):
            rows = pa.concat_arrays([p.column("asking" if visitor else "inside") for p in pieces])
            if not visitor:
                state, at = prepare(rows), (shard, part)
            elif at == (shard, part):
                yield from work(state, rows)

    return (
        here.unionByName(there, allowMissingColumns=True)
        .repartition("shard", "deal")
        .sortWithinPartitions("shard", "deal", "visitor", "crew")
        .mapInArrow(run, schema)
    )


def _goals(crew: pa.StructArray) -> tuple[np.ndarray, ...]:
    """owner (place in the crew), goal, upper, lower of all goals of a crew."""
    goals = crew.field("goals")
    owner = np.repeat(np.arange(len(crew)), pc.list_value_length(goals).to_numpy(zero_copy_only=False))
    flat = goals.flatten()
    return owner, *[flat.field(c).to_numpy() for c in ("goal", "upper", "lower")]


def _walks(shards: DataFrame, members: DataFrame, guide: Guide) -> DataFrame:
    kind = id_type(shards, "vec_id")

    def work(state, rows: pa.StructArray) -> Iterator[pa.RecordBatch]:
        crew, (owner, goal, upper, lower) = Vectors(rows), _goals(rows)
        found = list(guide.walk(state, crew, owner, goal, upper, lower))
        if not found:
            return
        lists = np.concatenate([np.full(len(places), k) for k, places, _ in found])
        places = np.concatenate([p for _, p, _ in found])
        vectors: Vectors = state.vectors
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(crew.row[owner[lists]]), pa.array(goal[lists]),
                crew.ids.take(pa.array(owner[lists])), pa.array(vectors.row[places]),
                vectors.ids.take(pa.array(places)), pa.array(np.concatenate([s for _, _, s in found])),
            ],
            names=["row", "goal", "asker", "other", "vec_id", "score"],
        )

    schema = f"row long, goal long, asker {kind}, other long, vec_id {kind}, score long"
    return materialize(meet(shards, members, guide.prepare, work, schema), "walks")


def summaries(shards: DataFrame, guide: Guide) -> DataFrame:
    """shard, d, first, second of each shard."""
    columns = [c for c in shards.columns if c != "shard"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), pieces in _whole_runs(batches, ["shard"]):
            state = guide.prepare(pa.concat_arrays([p.column("inside") for p in pieces]))
            first, second = guide.summary(state)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()), pa.array([state.vectors.whole.shape[1]], pa.int32()),
                    pa.array([first], pa.list_(pa.float64())), pa.array([second], pa.list_(pa.float64())),
                ],
                names=["shard", "d", "first", "second"],
            )

    return materialize(
        shards.select("shard", F.struct(*columns).alias("inside"))
        .repartition("shard").sortWithinPartitions("shard")
        .mapInArrow(run, "shard long, d int, first array<double>, second array<double>"),
        "summaries",
    )


def visits(shards: DataFrame, members: DataFrame, guide: Guide) -> DataFrame:
    """row, shard: where else than at home a row can reach the lower end of a goal."""
    known = summaries(shards, guide)
    packs = max(1, -(-known.count() // PACK))
    packed = known.select(
        F.xxhash64("d", F.pmod("shard", F.lit(packs))).alias("shard"), F.col("shard").alias("place"), "first", "second"
    )
    asking = members.select(
        F.explode(F.expr(f"sequence(0L, {packs - 1}L)")).alias("pack"), "crew", "d", "row", "vec_id", "v", "goals",
        F.col("shard").alias("home"),
    )

    def work(rows: pa.StructArray, asking: pa.StructArray) -> Iterator[pa.RecordBatch]:
        crew, (owner, _, _, lower) = Vectors(asking), _goals(asking)
        least = np.full(len(crew), MOST)
        np.minimum.at(least, owner, lower)
        bounds = guide.bounds(matrix(rows.field("first")), matrix(rows.field("second")), crew)
        place, home = rows.field("place").to_numpy(), asking.field("home").to_numpy()
        a, b = np.nonzero((bounds >= least[:, None]) & (place[None, :] != home[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(crew.row[a]), pa.array(place[b])], names=["row", "shard"])

    return materialize(
        meet(
            packed, asking.withColumn("shard", F.xxhash64("d", "pack")).drop("pack", "d"), lambda rows: rows, work,
            "row long, shard long",
        ),
        "visits",
    )


def search(shards: DataFrame, members: DataFrame, guide: Guide, k: int) -> DataFrame:
    """row, goal, asker, rank, other, vec_id, score: the first ``k`` rows for each goal.

    Both are stored tables; members have goals (goal, upper, lower) and are in their
    home shard.  Higher scores come first, ties by smaller vec_id, null ids last.
    """
    home = _walks(shards, members, guide)
    reached = home.groupBy("row", "goal").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("reached"))
    goals = (
        members.select("row", F.explode("goals").alias("g")).select("row", "g.*")
        .join(reached.filter(F.col("n") >= k).drop("n"), ["row", "goal"], "left")
        .groupBy("row")
        .agg(F.collect_list(F.struct("goal", "upper", F.greatest("lower", "reached").alias("lower"))).alias("goals"))
    )
    raised = materialize(members.drop("goals").join(goals, "row"), "raised-goals")
    ways = visits(shards, raised, guide)
    away = materialize(ways.join(raised.drop("shard"), "row"), "visitors")
    order = Window.partitionBy("row", "goal").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    found = home.unionByName(_walks(shards, away, guide))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
