"""Exact top-k search by inner product, block at a time.

A vector's terms are its components by sign, so a term's maximum in a block is the
largest component there, or the smallest where the query is negative.  The rows of a
shard are put into an order in which similar ones are next to each other, and each
range of ``BLOCK`` rows is a block, with its term maxima and its vectors (the forward
index).  A query orders the blocks by its summed term maxima and scores blocks through
their forward index until the next bound falls below its k-th score.  The same bound
over whole shards tells which shards a query visits at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort.llm.meetings import Guide, Vectors, crews, in_shards, materialize, scores, search, unit, whole_vectors

SCALE, TOP = 1_024, 10
#: Rows of a block, and blocks that are scored at a time, at most.
BLOCK, AT_ONCE = 32, 64


class Blocks:
    """A shard cut into ranges of similar rows."""

    def __init__(self, rows: pa.StructArray, block: int) -> None:
        self.vectors = Vectors(rows)
        real = self.vectors.real
        near = unit(real)
        heads = near[np.linspace(0, len(near) - 1, -(-len(near) // block)).astype(np.int64)]
        self.order = np.lexsort((self.vectors.row, (near @ heads.T).argmax(axis=1)))
        self.starts = np.arange(0, len(self.order), block)
        self.ends = np.append(self.starts[1:], len(self.order))
        self.most = np.maximum.reduceat(real[self.order], self.starts, axis=0)
        self.least = np.minimum.reduceat(real[self.order], self.starts, axis=0)


class BlockGuide(Guide):
    def __init__(self, k: int, block: int = BLOCK) -> None:
        self.k, self.block = k, block

    def prepare(self, rows: pa.StructArray) -> Blocks:
        return Blocks(rows, self.block)

    def summary(self, state: Blocks) -> tuple[np.ndarray, np.ndarray]:
        return state.most.max(axis=0), state.least.min(axis=0)

    def bounds(self, first: np.ndarray, second: np.ndarray, crew: Vectors) -> np.ndarray:
        summed = np.maximum(crew.real, 0) @ first.T + np.minimum(crew.real, 0) @ second.T
        # Sums beyond 2^53 are rounded.
        wide = np.sqrt(np.maximum(first**2, second**2).sum(axis=1))
        return summed + 1e-12 * crew.length[:, None] * wide[None, :]

    def walk(self, state: Blocks, crew: Vectors, owner, goal, upper, lower) -> Iterator[tuple]:
        bounds = self.bounds(state.most, state.least, crew)
        orders = np.argsort(-bounds, axis=1, kind="stable")
        for g, j in enumerate(owner.tolist()):
            floor = int(lower[g])
            order, bound = orders[j], bounds[j][orders[j]]
            places, best = np.empty(0, np.int64), np.empty(0, np.int64)
            at, step = 0, 1
            while at < len(order) and bound[at] >= floor:
                blocks = order[at : at + step]
                blocks = blocks[bound[at : at + step] >= floor]
                own = np.concatenate([state.order[state.starts[b] : state.ends[b]] for b in blocks.tolist()])
                made = scores(crew, [j], state.vectors, own)[0]
                good = (made >= floor) & (made <= upper[g]) & (state.vectors.row[own] != crew.row[j])
                places, best = np.append(places, own[good]), np.append(best, made[good])
                if len(places) >= self.k:
                    first = np.lexsort((state.vectors.rank[places], -best))[: self.k]
                    places, best = places[first], best[first]
                    floor = max(floor, int(best[-1]))
                at += step
                step = min(2 * step, AT_ONCE)
            if len(places):
                yield g, places, best


def top_k(
    vectors: DataFrame,
    queries: Column | str = "vec_id % 100 = 0",
    k: int = TOP,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of each query.

    Components become floor(scale * x); a score is the inner product of two vectors
    of the same length.  Queries are the rows for which ``queries`` holds; candidates
    are all rows but the query's own.  Ties go to the smaller id, then null ids.

    Vectors that are null or empty, hold null or non-finite components, or are 2^31
    long or longer when scaled take no part.  A row that repeats an id or a vector is
    a row of its own: it is a candidate of the other, and a query with results of its
    own.  A query without candidates has no rows; an empty table gives an empty
    result; other columns are ignored.
    """
    shards = in_shards(whole_vectors(vectors, id_col, vector_col, scale, queries))
    found = search(shards, materialize(crews(shards), "queries"), BlockGuide(k, block), k)
    return found.select(F.col("asker").alias("query_id"), "rank", "vec_id", "score")
