"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and cut into halves.  Each half has a codebook of
its own (k-means on at most ``SAMPLE`` vectors, the ones with the smallest hash);
the pairs of codewords form a grid of cells.  A vector lives in its nearest cell
and visits its nearest cells in the order of multi-sequence traversal, that is by
the sum of its two half distances.  How many cells it visits is measured: so many
that of partners made at exactly the threshold's angle, the hardest links there
are, the target share is met.  Of two cells the one with the larger number visits
the smaller, so each pair is compared once.  Cosines are verified in double
precision.

Equal vectors are one entry with its count.  A cell returns sums of links per
entry and a spanning forest, never its pairs.  A cell with more than ``block``
entries is dealt out: each block of entries meets the visitors and the later
blocks in groups of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.components import components
from cohort.llm.shared import attach, id_type, materialize

THRESHOLD, TARGET_RECALL = 0.95, 0.995
#: Vectors the codebooks are fitted to, and those that calibrate the visits, at most.
SAMPLE, CALIBRATION = 8_192, 512
#: Codewords per half grow with the root of the number of vectors, within these.
FEWEST, MOST, PER_CELL = 4, 256, 128
BLOCK = 4_096
#: Rows that are compared with a block at one time.
ROWS = 512


def _nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances, points x codewords."""
    return (
        (points**2).sum(axis=1)[:, None] - 2 * points @ book.T + (book**2).sum(axis=1)[None, :]
    )


def codebook(points: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means; fewer codewords if there are fewer points."""
    distinct = np.unique(points, axis=0)
    book = distinct[rng.permutation(len(distinct))[:size]]
    for _ in range(rounds):
        nearest = _nearest(points, book).argmin(axis=1)
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, points)
        n = np.bincount(nearest, minlength=len(book))
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


@dataclass
class MultiIndex:
    books: tuple[np.ndarray, np.ndarray]
    visits: int = 1

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.books[0].shape[1]
        return _nearest(unit[:, :half], self.books[0]), _nearest(unit[:, half:], self.books[1])

    def home(self, unit: np.ndarray) -> np.ndarray:
        first, second = self.halves(unit)
        return first.argmin(axis=1) * len(self.books[1]) + second.argmin(axis=1)

    def traverse(self, unit: np.ndarray) -> np.ndarray:
        """The nearest ``visits`` cells of each vector.

        The r-th nearest cell pairs the a-th and b-th nearest halves with
        (a + 1)(b + 1) <= r, so only such pairs are looked at.
        """
        first, second = self.halves(unit)
        k, visits = len(self.books[1]), min(self.visits, self.cells)
        pairs = [
            (a, b)
            for a in range(min(first.shape[1], visits))
            for b in range(min(k, visits // (a + 1)))
        ]
        a, b = np.array(pairs).T
        by_first, by_second = first.argsort(axis=1), second.argsort(axis=1)
        sums = (
            np.take_along_axis(first, by_first, 1)[:, a]
            + np.take_along_axis(second, by_second, 1)[:, b]
        )
        if visits < len(pairs):
            best = np.argpartition(sums, visits - 1, axis=1)[:, :visits]
        else:
            best = np.broadcast_to(np.arange(len(pairs)), sums.shape)
        return np.take_along_axis(by_first, a[best], 1) * k + np.take_along_axis(by_second, b[best], 1)


def unit_rows(column) -> np.ndarray:
    """A list column whose rows have one length as a matrix of unit vectors."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    # Divide by the largest component first: squares of tiny or huge ones are lost.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def fit_index(
    sample: np.ndarray, vectors: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, seed: int = 11
) -> MultiIndex:
    rng = np.random.default_rng(seed)
    size = int(np.clip(round((vectors / PER_CELL) ** 0.5), FEWEST, MOST))
    half = sample.shape[1] // 2
    index = MultiIndex((codebook(sample[:, :half], size, rng), codebook(sample[:, half:], size, rng)))
    probes = sample[rng.permutation(len(sample))[:CALIBRATION]]
    noise = rng.standard_normal(probes.shape)
    noise -= (noise * probes).sum(axis=1, keepdims=True) * probes
    length = np.sqrt((noise**2).sum(axis=1, keepdims=True))
    partners = threshold * probes + (1 - threshold**2) ** 0.5 * noise / np.where(length > 0, length, 1)
    first, second = index.halves(probes)
    sums = first[:, :, None] + second[:, None, :]
    homes = index.home(partners)
    at_home = sums.reshape(len(probes), -1)[np.arange(len(probes)), homes]
    ranks = (sums.reshape(len(probes), -1) < at_home[:, None]).sum(axis=1)
    index.visits = int(np.quantile(ranks, recall, method="higher")) + 1
    return index


def index_rows(entries: DataFrame, index: MultiIndex) -> DataFrame:
    """cell, visitor, rep, n, v: each entry (rep, n, v) at home and as a visitor."""
    shared_index = entries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared_index.value
        for batch in batches:
            # A thousand at a time: each gives up to ``visits`` rows.
            for a in range(0, batch.num_rows, 1_000):
                part = batch.slice(a, 1_000)
                unit = unit_rows(part.column(2))
                home = own.home(unit)
                cells = own.traverse(unit)
                row, col = np.nonzero(cells < home[:, None])
                at = np.concatenate([np.arange(len(home)), row])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([home, cells[row, col]]).astype(np.int64)),
                        pa.array(np.arange(len(at)) >= len(home)),
                        *[c.take(pa.array(at)) for c in part.columns],
                    ],
                    names=["cell", "visitor", "rep", "n", "v"],
                )

    kind = id_type(entries, "rep")
    return entries.select("rep", "n", "v").mapInArrow(
        run, f"cell long, visitor boolean, rep {kind}, n long, v {id_type(entries, 'v')}"
    )


class _Block:
    """The entries of one group, and what its rows have found so far."""

    def __init__(self, key) -> None:
        self.key = key
        self.parts: list[tuple[list, np.ndarray, np.ndarray]] = []
        self.rep: list | None = None

    def add(self, rep: list, n: np.ndarray, unit: np.ndarray) -> None:
        self.parts.append((rep, n, unit))

    def close(self) -> None:
        """No more entries: link them with each other."""
        if self.rep is not None:
            return
        self.rep = [r for rep, _, _ in self.parts for r in rep]
        self.n = np.concatenate([n for _, n, _ in self.parts]) if self.parts else np.empty(0, np.int64)
        self.unit = np.concatenate([u for _, _, u in self.parts]) if self.parts else None
        self.parts = []
        self.root = np.arange(len(self.rep))
        self.sums = np.zeros(len(self.rep), dtype=np.int64)

    def join(self, linked: np.ndarray) -> None:
        roots = np.unique(self.root[linked])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots[1:])] = roots[0]

    def within(self, threshold: float) -> None:
        self.close()
        for a in range(0, len(self.rep), ROWS):
            near = self.unit[a : a + ROWS] @ self.unit.T >= threshold
            near[np.arange(len(near)), np.arange(a, a + len(near))] = False
            self.sums[a : a + ROWS] += near @ self.n
            for k in np.flatnonzero(near.any(axis=1)):
                self.join(np.append(np.flatnonzero(near[k]), a + k))

    def visit(self, rep: list, n: np.ndarray, unit: np.ndarray, threshold: float):
        """Rows (rep, links) and edges of visitors; own sums and roots are updated."""
        sums, edges = [], []
        if not self.rep:
            return sums, edges
        for a in range(0, len(rep), ROWS):
            near = unit[a : a + ROWS] @ self.unit.T >= threshold
            rows = np.flatnonzero(near.any(axis=1))
            if len(rows):
                self.sums += n[a : a + ROWS] @ near
                found = near @ self.n
                for k in rows:
                    linked = np.flatnonzero(near[k])
                    self.join(linked)
                    sums.append((rep[a + k], int(found[k])))
                    edges.append((rep[a + k], self.rep[linked[0]]))
        return sums, edges

    def finish(self):
        used = np.flatnonzero(self.sums)
        child = np.flatnonzero(self.root != np.arange(len(self.rep)))
        return (
            [(self.rep[k], int(self.sums[k])) for k in used],
            [(self.rep[k], self.rep[self.root[k]]) for k in child],
        )


def links(
    entries: DataFrame, index: MultiIndex, threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """a, b, links: rows with b are links that keep components whole; rows with
    links add to the number of vectors that ``a`` is linked with."""
    rows = index_rows(entries, index)
    dealt = rows.withColumn("part", F.lit(0))
    crowded = materialize(
        rows.filter(~F.col("visitor")).groupBy("cell").agg(F.count(F.lit(1)).alias("k"))
        .filter(F.col("k") > block)
        .select("cell", F.ceil(F.col("k") / (block / 2)).cast("int").alias("blocks")),
        "crowded-cells",
    )
    if not crowded.isEmpty():
        # About block / 2 entries each, as hashes deal them unevenly.
        mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
        last = F.when(F.col("visitor"), F.col("blocks") - 1).otherwise(F.col("mine"))
        dealt = (
            rows.join(crowded, "cell", "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("mine", mine)
            .withColumn("part", F.explode(F.sequence(F.lit(0), last)))
            .withColumn("visitor", F.col("visitor") | (F.col("part") < F.col("mine")))
            .select(*dealt.columns)
        )
    kind = id_type(entries, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Block | None = None
        closed = False
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, part = batch.column("cell").to_numpy(), batch.column("part").to_numpy()
            visitor = batch.column("visitor").to_numpy(zero_copy_only=False)
            rep, n = batch.column("rep").to_pylist(), batch.column("n").to_numpy()
            unit = unit_rows(batch.column("v"))
            change = (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (visitor[1:] != visitor[:-1])
            bounds = np.concatenate(([0], np.flatnonzero(change) + 1, [len(cell)]))
            sums, edges = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                key = (cell[a], part[a])
                if current is None or current.key != key:
                    if current is not None:
                        if not closed:
                            current.within(threshold)
                        more = current.finish()
                        sums += more[0]
                        edges += more[1]
                    current, closed = _Block(key), False
                if not visitor[a]:
                    current.add(rep[a:b], n[a:b], unit[a:b])
                    continue
                if not closed:
                    current.within(threshold)
                    closed = True
                more = current.visit(rep[a:b], n[a:b], unit[a:b], threshold)
                sums += more[0]
                edges += more[1]
            yield from _found(sums, edges, batch.schema.field("rep").type)
        if current is not None:
            if not closed:
                current.within(threshold)
            yield from _found(*current.finish(), batch.schema.field("rep").type)

    return (
        dealt.repartition("cell", "part")
        .sortWithinPartitions("cell", "part", "visitor")
        .mapInArrow(run, f"a {kind}, b {kind}, links long")
    )


def _found(sums: list, edges: list, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    if sums or edges:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r for r, _ in sums] + [a for a, _ in edges], kind),
                pa.array([None] * len(sums) + [b for _, b in edges], kind),
                pa.array([s for _, s in sums] + [None] * len(edges), pa.int64()),
            ],
            names=["a", "b", "links"],
        )


def embedding_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = TARGET_RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    Vectors with a cosine of at least ``threshold`` are linked; ``recall`` is the
    share of the hardest links that the index is set to find.  A vector that is
    null, empty, zero, or holds null or non-finite components links with nothing.
    Vectors of different lengths are not compared.  Equal vectors are links too, a
    row that repeats an id included.  A row without an id counts as a link and
    gets the component of its vector.  An empty table gives an empty result; other
    columns are ignored.
    """
    v = F.col("v")
    sound = (F.size(v) > 0) & F.forall(
        v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    ) & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False)))
    rows = materialize(
        vectors.select(quoted(id_col).alias("vec_id"), quoted(vector_col).alias("v")).select(
            "vec_id",
            F.when(F.coalesce(sound, F.lit(False)), v).alias("v"),
            F.xxhash64("v").alias("h1"),
            F.xxhash64(F.lit("vector"), "v").alias("h2"),
        ),
        "vectors",
    )
    entries = materialize(
        rows.filter(F.col("v").isNotNull()).groupBy("h1", "h2").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("v").alias("v")
        ),
        "vector-entries",
    )
    known = entries.filter(F.col("rep").isNotNull())
    found = None
    for row in known.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect():
        alike = known.filter(F.size("v") == row["d"])
        sample = alike.select("v").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toArrow()
        index = fit_index(unit_rows(sample.column("v")), row["n"], threshold, recall)
        more = materialize(links(alike, index, threshold, block), "vector-links")
        found = more if found is None else found.unionByName(more)
    if found is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
        )
    joined = components(found.filter(F.col("b").isNotNull()).select("a", "b"))
    sums = found.filter(F.col("links").isNotNull()).groupBy(F.col("a").alias("rep")).agg(
        F.sum("links").alias("links")
    )
    labelled = materialize(
        entries.drop("v").join(sums, "rep", "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select(
            "h1", "h2", "n",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ),
        "vector-components",
    )
    linked = attach(
        rows.filter(F.col("v").isNotNull()).select("vec_id", "h1", "h2"), labelled, ["h1", "h2"], "n"
    ).select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("v").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
