"""Hard negatives by shared candidate lists of anchor clusters (MAXIMUS).

The anchors of a crew are one cluster.  Its centre and widest angle bound the inner
product of any member with a candidate: |a| |x| cos(angle(x, centre) - widest).  For
each crew and shard the candidates are sorted once by |x| cos(...), and all members
walk down that one list together.  A member stops when its own bound at the next
candidate is below the last score that it still needs, which certifies its result; the
walk of the crew ends with its last member.  The same bound with the shard's centre
and widest angle tells which shards an anchor visits at all.

The walks are used twice.  First for the positives, over shards of the anchor's label.
Their scores set the windows of the negatives; anchors then walk over all shards, with
a list of its own for each window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.meetings import Guide, Vectors, crews, in_shards, materialize, scores, search, unit, whole_vectors

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
LOW, HIGH = 30, 90
#: Candidates that a crew scores at a time, at first and at most.
STEP, STEPS = 256, 2_048
#: What angles are rounded by, with room.
SLACK = 1e-6


class Candidates:
    def __init__(self, rows: pa.StructArray) -> None:
        self.vectors = Vectors(rows)
        self.unit = unit(self.vectors.real)
        self.label = rows.field("label").to_numpy(zero_copy_only=False)


def _centre(near: np.ndarray) -> tuple[np.ndarray, float]:
    """Direction of the middle of unit vectors, and the widest angle to it."""
    near = near[near.any(axis=1)]
    middle = unit(near.sum(axis=0, keepdims=True))[0]
    if not middle.any():
        return middle, np.pi
    return middle, float(_angles(near, middle).max())


def _angles(near: np.ndarray, middle: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(near @ middle, -1, 1))


class AngleGuide(Guide):
    """``same``: whether a candidate has to have the anchor's label, or another."""

    def __init__(self, k: int, same: bool) -> None:
        self.k, self.same = k, same

    def prepare(self, rows: pa.StructArray) -> Candidates:
        return Candidates(rows)

    def summary(self, state: Candidates) -> tuple[np.ndarray, np.ndarray]:
        middle, widest = _centre(state.unit)
        return middle, np.array([widest, state.vectors.longest])

    def bounds(self, first: np.ndarray, second: np.ndarray, crew: Vectors) -> np.ndarray:
        widest, longest = second.T
        apart = np.arccos(np.clip(unit(crew.real) @ first.T, -1, 1)) - widest
        most = crew.length[:, None] * longest[None, :]
        return most * np.cos(np.clip(apart, 0, np.pi)) + SLACK * most

    def walk(self, state: Candidates, crew: Vectors, owner, goal, upper, lower) -> Iterator[tuple]:
        vectors, label = state.vectors, crew.rows.field("label").to_numpy(zero_copy_only=False)
        middle, widest = _centre(unit(crew.real))
        apart = np.clip(_angles(state.unit, middle) - widest, 0, np.pi)
        # A zero anchor scores 0 everywhere, whatever the angle; its length is 0 as well.
        shared = vectors.length * np.cos(apart) + SLACK * vectors.longest
        order = np.argsort(-shared, kind="stable")
        floor = lower.copy()
        lists, places, best = (np.empty(0, np.int64) for _ in range(3))
        at, step = 0, STEP
        while at < len(order):
            walking = np.flatnonzero(crew.length[owner] * shared[order[at]] >= floor)
            if not len(walking):
                break
            own = order[at : at + step]
            members, row_of = np.unique(owner[walking], return_inverse=True)
            made = scores(crew, members, vectors, own)[row_of]
            a, b = np.nonzero((made >= floor[walking, None]) & (made <= upper[walking, None]))
            mine, there = walking[a], own[b]
            good = (vectors.row[there] != crew.row[owner[mine]]) & (
                (state.label[there] == label[owner[mine]]) == self.same
            )
            if good.any():
                lists = np.append(lists, mine[good])
                places, best = np.append(places, there[good]), np.append(best, made[a, b][good])
                first = np.lexsort((vectors.rank[places], -best, lists))
                lists, places, best = lists[first], places[first], best[first]
                starts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
                sizes = np.diff(np.append(starts, len(lists)))
                nth = np.arange(len(lists)) - np.repeat(starts, sizes)
                full = starts[sizes >= self.k]
                floor[lists[full]] = np.maximum(floor[lists[full]], best[full + self.k - 1])
                lists, places, best = lists[nth < self.k], places[nth < self.k], best[nth < self.k]
            at += step
            step = min(2 * step, STEPS)
        starts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1])) if len(lists) else []
        for a, b in zip(starts, [*starts[1:], len(lists)]):
            yield int(lists[a]), places[a:b], best[a:b]


def hard_negatives(
    vectors: DataFrame,
    anchors: Column | str = "vec_id % 100 = 0",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the inner product with the anchor,
    of vectors of the same length.  Higher scores come first, ties by smaller id, null
    ids last.  Anchors are the rows for which ``anchors`` holds; an anchor's positives
    are its first ``positives`` other rows of the same label.  For each of them the
    first ``negatives`` rows of another label are returned whose score is at least
    ``low`` and at most ``high`` percent of the positive's.

    Rows without a label, and vectors that are null or empty, hold null or non-finite
    components, or are 2^31 long or longer when scaled take no part.  A row that repeats
    an id or a vector is a row of its own.  A positive without negatives has no rows; an
    empty table gives an empty result; other columns are ignored.
    """
    rows = whole_vectors(
        vectors.filter(quoted(label_col).isNotNull()), id_col, vector_col, scale, anchors, label=quoted(label_col)
    )
    alike = in_shards(rows, "label")
    near = materialize(
        search(alike, materialize(crews(alike), "anchors"), AngleGuide(positives, True), positives)
        .select("row", F.col("vec_id").alias("positive_id"), "rank", F.col("score").alias("positive_score")),
        "positives",
    )
    share = "cast({0}(cast(positive_score as decimal(20, 0)) * {1} / 100) as bigint)".format
    windows = (
        near.select("row", "positive_score").distinct()
        .select(
            "row", F.col("positive_score").alias("goal"), F.expr(share("floor", high)).alias("upper"),
            F.expr(share("ceil", low)).alias("lower"),
        )
        .filter(F.col("lower") <= F.col("upper"))
        .groupBy("row").agg(F.collect_list(F.struct("goal", "upper", "lower")).alias("goals"))
    )
    shards = in_shards(rows)
    members = materialize(crews(shards).drop("goals").join(windows, "row"), "windows")
    found = search(shards, members, AngleGuide(negatives, False), negatives)
    return (
        near.withColumnsRenamed({"rank": "positive_rank", "positive_score": "goal"})
        .join(found, ["row", "goal"])
        .select(
            F.col("asker").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"),
            F.col("goal").alias("positive_score"), F.col("score").alias("negative_score"),
        )
    )
