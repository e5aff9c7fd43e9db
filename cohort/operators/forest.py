"""A random forest for tables of many rows, grown level by level from histograms.

MLlib keeps a draw for each row and tree, 2 KB a row with 500 trees, and adds row by
row to the histograms.  Here a row is stored once, as one byte per feature (the bin its
value lies in), and its draws are a hash of row, tree and seed, made anew when needed.
A pass over these bytes adds up the histograms of all open nodes with numpy, a block of
rows at a time; they are summed by tree, where the best split of each node is found, and
only the splits reach the driver.  A level is one pass, or several where its histograms
would outgrow ``CELLS_PER_PASS``.

The rules are MLlib's: bins between the quantiles of a sample of the rows, Poisson draws
with replacement, a random subset of the features per node, Gini impurity of the weighted
rows, leaves that agree merged.  The result is MLlib's own model.  Scoring gives what that
model gives, a batch of rows and a tree at a time.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import quoted
from cohort.plans.workspace import materialize, shared_folder

#: Wider tables and deeper trees are left to MLlib: bytes per row and nodes per tree grow with them.
MOST_FEATURES, MOST_DEPTH, MOST_BINS = 512, 8, 256
#: Rows whose histograms are made at once, and features that share a count have so many bins together.
BLOCK_ROWS, SHARED_BINS = 65_536, 512
#: Counts that a worker holds in one pass.
CELLS_PER_PASS = 6_000_000
#: MLlib finds bins in so many rows at least.
SAMPLE_ROWS = 10_000
#: Trees whose counts travel in one batch, and what MLlib takes for no impurity.
_TREES_PER_BATCH, _EPSILON = 25, 2.220446049250313e-16

Cuts = list[np.ndarray]

# The executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Node:
    #: Rows drawn, per class.
    rows: tuple[int, int]
    level: int = 0
    feature: int = -1
    #: Rows up to this bin go left.
    cut: int = 0
    gain: float = 0.0
    left: int = -1
    right: int = -1


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=lambda: [Node((0, 0))])
    #: Nodes whose split is still to be found.
    open: list[int] = field(default_factory=lambda: [0])


@dataclass(frozen=True)
class Plan:
    """What a pass does for one tree: the splits so far, and the counts of each open node.

    The features of ``shared`` are counted together, as (cells, features); each entry of
    ``asked`` is (node, features).
    """

    tree: int
    splits: dict[int, tuple[int, int, int, int]]
    asked: list[tuple[int, list[int]]]
    shared: list[list[tuple[int, list[int]]]]

    @property
    def cells(self) -> int:
        return sum(2 * cells for groups in self.shared for cells, _ in groups)


def can_grow(forest: RandomForestClassifier, data: DataFrame, features: str, classes: Iterable[int]) -> bool:
    """Whether the trees are flat and narrow enough, all features are numbers, and class 1 occurs."""
    if forest.getMaxDepth() > MOST_DEPTH or forest.getMaxBins() > MOST_BINS or 1 not in set(classes):
        return False
    known = data.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if "nominal" in known or "binary" in known:
        return False
    first = data.select(quoted(features)).first()
    return first is not None and 0 < len(first[0]) <= MOST_FEATURES


def grow(
    forest: RandomForestClassifier, data: DataFrame, *, label: str, features: str, rows: dict[int, int],
    weights: dict[int, float], key: str | None = None,
) -> RandomForestClassificationModel:
    """The fitted ``forest``; ``rows`` and ``weights`` are those of each class, 0 and 1.

    With a ``key`` a row's draws depend on key and seed alone (rows that share a key are
    drawn together), without one on where the row is stored.
    """
    width = len(data.select(quoted(features)).first()[0])
    by_class = np.array([weights.get(0, 1.0), weights.get(1, 1.0)])
    row = F.monotonically_increasing_id() if key is None else F.xxhash64(quoted(key))
    plain = data.select(
        row.alias("row"), quoted(label).cast("int").alias("label"), vector_to_array(quoted(features)).alias("x")
    )
    cuts = find_cuts(plain, width, sum(rows.values()), by_class, forest)
    used = [f for f in range(width) if len(cuts[f])]
    binned = materialize(plain.mapInArrow(_binner(cuts, used), "row long, cells binary"), "bins")

    trees = [Tree() for _ in range(forest.getNumTrees())]
    per_node, depth, seed = _subset_size(forest, width), forest.getMaxDepth(), forest.getSeed()
    bins = np.array([len(c) + 1 for c in cuts])
    place = {f: k for k, f in enumerate(used)}
    # As in MLlib the draw of a node's features includes those that cannot split it.
    while any(t.open for t in trees):
        plans = []
        for number, tree in enumerate(trees):
            if tree.open:
                drawn = {n: _subset(seed, number, n, width, per_node) for n in tree.open}
                plans.append(_plan(number, tree, {n: [f for f in fs if f in place] for n, fs in drawn.items()}, bins))
        found = {}
        for some in _passes(plans):
            counts = binned.mapInArrow(
                _counter(some, place, bins, len(used), seed, forest.getSubsamplingRate()), "tree int, counts binary"
            )
            best = counts.groupBy("tree").applyInArrow(
                _splitter(some, bins, by_class, forest.getMinInstancesPerNode()),
                "tree int, node int, feature int, cut int, gain double, l0 long, l1 long, r0 long, r1 long",
            )
            found.update({(r["tree"], r["node"]): r for r in best.collect()})
        for number, tree in enumerate(trees):
            asked, tree.open = tree.open, []
            for n in asked:
                _take(tree, n, found.get((number, n)), depth, by_class, forest.getMinInstancesPerNode())
    return _as_model(forest, trees, cuts, by_class, width)


# --- bins --------------------------------------------------------------------


def find_cuts(
    plain: DataFrame, width: int, rows: int, by_class: np.ndarray, forest: RandomForestClassifier
) -> Cuts:
    """Where each feature may be cut, found in a sample as MLlib does."""
    most = max(1, min(forest.getMaxBins(), rows) - 1)
    wanted = max(forest.getMaxBins() ** 2, SAMPLE_ROWS)
    chosen = F.pmod(F.xxhash64("row", F.lit(forest.getSeed())), F.lit(1 << 32)) < math.ceil(2**32 * wanted / rows)
    sample = plain.where(chosen) if rows > wanted else plain
    table = sample.select("label", "x").toArrow().combine_chunks()
    x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    weight = by_class[table["label"].to_numpy()]
    return [cuts_of(x[:, f], weight, most) for f in range(width)]


def cuts_of(x: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` cuts, midway between values; quantiles where there are more values."""
    values, at = np.unique(x, return_inverse=True)
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) <= most:
        return middles
    upto = np.cumsum(np.bincount(at, weights=weight))
    stride = upto[-1] / (most + 1)
    out, target = [], stride
    for k in range(1, len(values)):
        # The value before is the last one below the cut if this one would lead further away.
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            out.append(middles[k - 1])
            target += stride
    return np.array(out)


def _binner(cuts: Cuts, used: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows as bytes: the class, then the bin of each feature that can be cut."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            cells = np.empty((n, 1 + len(used)), np.uint8)
            cells[:, 0] = batch.column("label").to_numpy(zero_copy_only=False)
            for k, f in enumerate(used):
                own = cuts[f]
                cells[:, 1 + k] = x[:, f] > own[0] if len(own) == 1 else np.searchsorted(own, x[:, f])
            ends = np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32)
            packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(cells)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), packed], names=["row", "cells"])

    return binned


# --- passes ------------------------------------------------------------------


def _subset_size(forest: RandomForestClassifier, width: int) -> int:
    """How many features a node draws, by MLlib's rules."""
    named = forest.getFeatureSubsetStrategy()
    if named == "auto":
        named = "all" if forest.getNumTrees() == 1 else "sqrt"
    if named == "all":
        return width
    if named == "sqrt":
        return math.ceil(math.sqrt(width))
    if named == "log2":
        return max(1, math.ceil(math.log2(width)))
    if named == "onethird":
        return math.ceil(width / 3)
    return min(width, int(named)) if named.isdigit() else math.ceil(float(named) * width)


def _subset(seed: int, tree: int, node: int, width: int, size: int) -> list[int]:
    if size >= width:
        return list(range(width))
    draw = np.random.default_rng([tree, node, seed & (2**63 - 1)])
    return sorted(draw.choice(width, size, replace=False).tolist())


def _plan(number: int, tree: Tree, drawn: dict[int, list[int]], bins: np.ndarray) -> Plan:
    splits = {
        i: (n.feature, n.cut, n.left, n.right) for i, n in enumerate(tree.nodes) if n.left >= 0
    }
    shared = []
    for features in drawn.values():
        groups: list[list] = []
        # One count of the joint bins of several features costs less than one for each.
        for f in sorted(features, key=lambda f: -bins[f]):
            for g in groups:
                if g[0] * bins[f] <= SHARED_BINS:
                    g[0] *= int(bins[f])
                    g[1].append(f)
                    break
            else:
                groups.append([int(bins[f]), [f]])
        # A node without features that can be cut still counts its rows.
        shared.append([(n, fs) for n, fs in groups] or [(1, [])])
    return Plan(number, splits, list(drawn.items()), shared)


def _passes(plans: list[Plan]) -> Iterator[list[Plan]]:
    some: list[Plan] = []
    for plan in plans:
        if some and sum(p.cells for p in some) + plan.cells > CELLS_PER_PASS:
            yield some
            some = []
        some.append(plan)
    yield some


def poisson_table(rate: float) -> np.ndarray:
    """The draw for each of 65,536 equally likely numbers."""
    upto, p, k = [], math.exp(-rate), 0
    total = p
    while total < 1 - 2**-18 and k < 40:
        upto.append(total)
        k += 1
        p *= rate / k
        total += p
    return np.searchsorted(np.array(upto), (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


def draws(rows: np.ndarray, group: int, seed: int, table: np.ndarray) -> np.ndarray:
    """How often each of ``rows`` is drawn by the four trees of a group (SplitMix64 of row and seed)."""
    mask = 2**64 - 1
    h = rows * np.uint64(0xD1342543DE82EF95) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & mask)
    h = _mixed(h) + np.uint64((group * 0x9E3779B97F4A7C15) & mask)
    return table.take(_mixed(h).view(np.uint16)).reshape(-1, 4)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, bytes by column), many rows at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def block() -> tuple[np.ndarray, np.ndarray]:
        rows = np.concatenate([r for r, _ in held])
        return rows, np.ascontiguousarray(np.concatenate([c for _, c in held]).T)

    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column("cells")
        ends = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + 1]
        data = np.frombuffer(cells.buffers()[2], np.uint8, batch.num_rows * width, int(ends[0]))
        held.append((batch.column("row").to_numpy().view(np.uint64), data.reshape(-1, width)))
        n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield block()
            held, n = [], 0
    if held:
        yield block()


def _counter(
    plans: list[Plan], place: dict[int, int], bins: np.ndarray, used: int, seed: int, rate: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the open nodes of each tree, by feature, bin and class, over the rows of a task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = poisson_table(rate)
        sums = [[[np.zeros(2 * n) for n, _ in groups] for groups in plan.shared] for plan in plans]
        steps = [
            [[(2 * n, [(1 + place[f], np.uint16(m)) for f, m in _factors(fs, bins)]) for n, fs in groups]
             for groups in plan.shared]
            for plan in plans
        ]
        some = False
        for rows, columns in _blocks(batches, 1 + used):
            some = True
            label = columns[0].astype(np.uint16)
            group, drawn = -1, None
            for plan, own_sums, own_steps in zip(plans, sums, steps):
                if plan.tree // 4 != group:
                    group = plan.tree // 4
                    drawn = draws(rows, group, seed, table)
                times = np.ascontiguousarray(drawn[:, plan.tree % 4])
                at, edges = _dealt(plan, columns, place, times)
                times, labels = times.take(at).astype(np.float64), label.take(at)
                for k, (node_sums, node_steps) in enumerate(zip(own_sums, own_steps)):
                    low, high = edges[k], edges[k + 1]
                    if low == high:
                        continue
                    inside, t, y = at[low:high], times[low:high], labels[low:high]
                    for total, (cells, factors) in zip(node_sums, node_steps):
                        code = y.copy()
                        for column, m in factors:
                            code += columns[column].take(inside) * m
                        total += np.bincount(code, weights=t, minlength=cells)
        if some:
            for start in range(0, len(plans), _TREES_PER_BATCH):
                part = range(start, min(start + _TREES_PER_BATCH, len(plans)))
                packed = [_by_feature(plans[i], sums[i], bins).tobytes() for i in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([plans[i].tree for i in part], pa.int32()), pa.array(packed, pa.binary())],
                    names=["tree", "counts"],
                )

    return counted


def _factors(features: list[int], bins: np.ndarray) -> Iterator[tuple[int, int]]:
    """What each feature's bin is multiplied by in the number of a joint cell; the class is the last digit."""
    m = 2
    for f in features:
        yield f, m
        m *= int(bins[f])


def _dealt(
    plan: Plan, columns: np.ndarray, place: dict[int, int], times: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The rows drawn, by open node, and where those of each node begin."""
    kind = np.uint8 if len(plan.asked) < 255 else np.uint16
    full = np.iinfo(kind).max
    number = {node: kind(k + 1) for k, (node, _) in enumerate(plan.asked)}

    def goes(node: int) -> np.ndarray:
        feature, cut, _, _ = plan.splits[node]
        return (columns[1 + place[feature]] > cut).astype(kind) * full

    below = {node: (left, right) for node, (_, _, left, right) in plan.splits.items()}
    code = _arrived(0, below, number, goes, kind(0)) * (times > 0)
    edges = np.cumsum(np.bincount(code, minlength=len(plan.asked) + 1))
    order = np.argsort(code, kind="stable")
    return order[edges[0] :], edges - edges[0]


def _arrived(
    node: int, below: dict[int, tuple[int, int]], number: dict[int, np.integer],
    goes: Callable[[int], np.ndarray], none: np.integer,
) -> np.ndarray:
    """The number of the last node that each row comes to from ``node``, or ``none``.

    ``goes`` has all bits set where a row goes right.  Each inner node is asked about all
    rows: that takes a few byte operations, less than to sort the rows out.
    """
    if node not in below:
        return number.get(node, none)
    a, b = (_arrived(child, below, number, goes, none) for child in below[node])
    return a ^ ((a ^ b) & goes(node))


def _by_feature(plan: Plan, sums: list[list[np.ndarray]], bins: np.ndarray) -> np.ndarray:
    """Counts (bin, class) of each node and feature in turn, out of those of joint cells."""
    out = []
    for (_, features), groups, totals in zip(plan.asked, plan.shared, sums):
        own = {}
        for (_, fs), total in zip(groups, totals):
            joint = total.reshape([*(int(bins[f]) for f in reversed(fs)), 2])
            last = len(fs) - 1
            for k, f in enumerate(fs):
                own[f] = joint.sum(axis=tuple(a for a in range(len(fs)) if a != last - k))
            if not fs:
                own[-1] = joint
        out += [own[f].ravel() for f in (features or [-1])]
    return np.concatenate(out).astype(np.int64)


# --- splits ------------------------------------------------------------------


def _gini(weights: np.ndarray) -> np.ndarray:
    """Impurity of rows of (class 0, class 1)."""
    total = weights.sum(axis=-1)
    share = weights / np.where(total > 0, total, 1)[..., None]
    return np.where(total > 0, 1 - (share**2).sum(axis=-1), 0.0)


def best_split(
    counts: list[np.ndarray], by_class: np.ndarray, least: int
) -> tuple[int, int, float, np.ndarray, np.ndarray]:
    """(place of the feature, cut, gain, rows left, rows right); place -1 if no cut is allowed."""
    whole = counts[0].sum(axis=0)
    total = (whole * by_class).sum()
    best = (-1, 0, 0.0, whole, np.zeros(2, np.int64))
    if not total:
        return best
    impurity = _gini(whole * by_class)
    for k, own in enumerate(counts):
        left = np.cumsum(own, axis=0)[:-1]
        right = whole - left
        allowed = (left.sum(axis=1) >= least) & (right.sum(axis=1) >= least)
        if not allowed.any():
            continue
        l, r = left * by_class, right * by_class
        gains = impurity - (l.sum(axis=1) * _gini(l) + r.sum(axis=1) * _gini(r)) / total
        gains = np.where(allowed, gains, -np.inf)
        cut = int(gains.argmax())
        if best[0] < 0 or gains[cut] > best[2]:
            best = (k, cut, float(gains[cut]), left[cut], right[cut])
    return best


def _splitter(
    plans: list[Plan], bins: np.ndarray, by_class: np.ndarray, least: int
) -> Callable[[pa.Table], pa.Table]:
    asked = {plan.tree: plan.asked for plan in plans}

    def split(table: pa.Table) -> pa.Table:
        tree = table["tree"][0].as_py()
        total = sum(np.frombuffer(b.as_buffer(), np.int64) for b in table["counts"])
        out: list[tuple] = []
        start = 0
        for node, features in asked[tree]:
            counts = []
            for f in features or [-1]:
                size = 2 * (int(bins[f]) if features else 1)
                counts.append(total[start : start + size].reshape(-1, 2))
                start += size
            k, cut, gain, left, right = best_split(counts, by_class, least)
            feature = features[k] if k >= 0 else -1
            out.append((tree, node, feature, cut, gain, *map(int, left), *map(int, right)))
        names = ["tree", "node", "feature", "cut", "gain", "l0", "l1", "r0", "r1"]
        kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.int64()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return split


def _take(tree: Tree, n: int, found, depth: int, by_class: np.ndarray, least: int) -> None:
    """Note a node's split and open its children, if there is anything to gain."""
    node = tree.nodes[n]
    if found is None:  # no row was drawn
        return
    left, right = (found["l0"], found["l1"]), (found["r0"], found["r1"])
    node.rows = (left[0] + right[0], left[1] + right[1])
    if found["feature"] < 0 or found["gain"] <= 0 or node.level == depth:
        return
    node.feature, node.cut, node.gain = found["feature"], found["cut"], found["gain"]
    node.left, node.right = len(tree.nodes), len(tree.nodes) + 1
    for child, rows in ((node.left, left), (node.right, right)):
        tree.nodes.append(Node(rows, node.level + 1))
        pure = _gini(np.array(rows) * by_class) < _EPSILON
        if not pure and sum(rows) >= 2 * least and node.level + 1 < depth:
            tree.open.append(child)


# --- scoring -----------------------------------------------------------------


@dataclass(frozen=True)
class Votes:
    """A tree for scoring: its inner nodes with the number of their question, its leaves with their votes."""

    below: dict[int, tuple[int, int]]
    question: dict[int, int]
    leaf: dict[int, int]
    #: Shares of class 0 (real) and class 1 (imaginary) in each leaf.
    shares: np.ndarray


def can_score(model: object) -> bool:
    """Whether ``score_rows`` gives what the model's ``transform`` would."""
    return (
        isinstance(model, RandomForestClassificationModel) and model.numClasses == 2
        and 0 < model.numFeatures <= MOST_FEATURES and not model.isDefined(model.thresholds)
        and model.getMaxDepth() <= MOST_DEPTH
    )


def _votes(model: RandomForestClassificationModel) -> tuple[list[tuple[int, float]], list[Votes]] | None:
    """The questions (feature, threshold) of all trees, and the trees; None if a split is no threshold."""
    known = getattr(model, "cohort_votes", None)
    if known is not None:
        return known
    spark = SparkSession.active()
    path = f"{shared_folder(spark)}/cohort-forest-{uuid.uuid4().hex}"
    model.write().save(path)
    trees: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").collect():
        trees.setdefault(r["treeID"], []).append(r["nodeData"])
    asked: dict[tuple[int, float], int] = {}
    out = []
    for number in sorted(trees):
        nodes = trees[number]
        inner = [n for n in nodes if n["leftChild"] >= 0]
        leaves = [n for n in nodes if n["leftChild"] < 0]
        if any(n["split"]["numCategories"] >= 0 for n in inner):
            return None
        at = {n["id"]: (n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]) for n in inner}
        question = {node: asked.setdefault(q, len(asked)) for node, q in at.items()}
        stats = [n["impurityStats"] for n in leaves]
        shares = [complex(a / (a + b), b / (a + b)) if a + b else 0j for a, b in stats]
        below = {n["id"]: (n["leftChild"], n["rightChild"]) for n in inner}
        out.append(Votes(below, question, {n["id"]: k for k, n in enumerate(leaves)}, np.array(shares)))
    model.cohort_votes = list(asked), out
    return model.cohort_votes


def score_rows(
    model: RandomForestClassificationModel, vectors: DataFrame, keep: Iterable[str]
) -> DataFrame | None:
    """Kept columns, ``pred`` and ``score``, the probability of class 1, as MLlib adds up its trees' votes."""
    found = _votes(model)
    if found is None:
        return None
    asked, trees = found
    names = list(keep)
    rows = vectors.select(*[quoted(c) for c in names], vector_to_array(quoted(model.getFeaturesCol())).alias("_x"))
    results = [T.StructField("pred", T.IntegerType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*rows.schema.fields[:-1], *results])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).T
            columns = {f: np.ascontiguousarray(x[f]) for f in {f for f, _ in asked}}
            right = [~(columns[f] <= threshold) * np.uint8(255) for f, threshold in asked]
            votes = np.zeros(n, np.complex128)
            for tree in trees:
                kind = np.uint8 if len(tree.shares) < 256 else np.uint16
                number = {node: kind(k) for node, k in tree.leaf.items()}

                def goes(node: int, tree: Votes = tree, kind: type = kind) -> np.ndarray:
                    mask = right[tree.question[node]]
                    return mask if kind is np.uint8 else mask.astype(kind) * kind(257)

                at = _arrived(0, tree.below, number, goes, kind(0))
                votes += tree.shares.take(at)
            total = votes.real + votes.imag
            share = np.divide(votes.imag, total, out=votes.imag.copy(), where=total != 0)
            pred = (votes.imag > votes.real).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(pred), pa.array(share)], names=[*names, "pred", "score"]
            )

    return rows.mapInArrow(scored, schema)


# --- MLlib's model -----------------------------------------------------------


def _stored_nodes(tree: Tree, cuts: Cuts, by_class: np.ndarray) -> list[tuple]:
    """Nodes as MLlib stores them, parents first; two leaves that predict the same are one."""

    def prediction(n: int) -> float:
        weighted = np.array(tree.nodes[n].rows) * by_class
        return float(weighted[1] > weighted[0])

    leaves: set[int] = set()
    # Children come after their parents.
    for n in reversed(range(len(tree.nodes))):
        node = tree.nodes[n]
        below = (node.left, node.right)
        if node.left < 0 or (leaves.issuperset(below) and prediction(node.left) == prediction(node.right)):
            leaves.add(n)

    out: list[tuple] = []

    def store(n: int) -> int:
        node, own = tree.nodes[n], len(out)
        out.append(())
        weighted = np.array(node.rows) * by_class
        fixed = (own, prediction(n), float(_gini(weighted)), weighted.tolist(), int(sum(node.rows)))
        if n in leaves:
            out[own] = (*fixed, -1.0, -1, -1, (-1, [], -1))
        else:
            at = (node.feature, [float(cuts[node.feature][node.cut])], -1)
            out[own] = (*fixed, node.gain, store(node.left), store(node.right), at)
        return own

    store(0)
    return out


def _as_model(
    forest: RandomForestClassifier, trees: list[Tree], cuts: Cuts, by_class: np.ndarray, width: int
) -> RandomForestClassificationModel:
    """MLlib reads a forest from tables; what else they hold comes from a forest of one tree."""
    spark = SparkSession.active()
    columns = [forest.getLabelCol(), forest.getFeaturesCol()]
    two = [(0.0, Vectors.sparse(width, []), 1.0), (1.0, Vectors.sparse(width, [0], [1.0]), 1.0)]
    if forest.isDefined(forest.weightCol):
        columns.append(forest.getWeightCol())
    few = spark.createDataFrame([r[: len(columns)] for r in two], columns).coalesce(1)
    path = f"{shared_folder(spark)}/cohort-forest-{uuid.uuid4().hex}"
    forest.copy({forest.numTrees: 1}).fit(few).write().save(f"{path}/one")

    said = json.loads(spark.read.text(f"{path}/one/metadata").first()[0])
    said["paramMap"]["numTrees"] = said["numTrees"] = len(trees)
    spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.text(f"{path}/all/metadata")
    one = spark.read.parquet(f"{path}/one/treesMetadata")
    _, about, weight = one.first()
    spark.createDataFrame([(i, about, weight) for i in range(len(trees))], one.schema).coalesce(1).write.parquet(
        f"{path}/all/treesMetadata"
    )
    schema = spark.read.parquet(f"{path}/one/data").schema
    nodes = [(i, node) for i, tree in enumerate(trees) for node in _stored_nodes(tree, cuts, by_class)]
    spark.createDataFrame(nodes, schema).coalesce(1).write.parquet(f"{path}/all/data")
    return RandomForestClassificationModel.load(f"{path}/all")
