"""Near duplicates by SimHash and multi-index hashing.

Fingerprints that differ in at most ``distance`` bits are linked.  The 64 bits
are cut into segments with radii so that sum(radius + 1) = distance + 1: if every
segment differed in more bits than its radius, the whole would differ in more
than ``distance``.  So every link shows in some segment, exactly.  The table
holds each fingerprint under its segments; a probe is a fingerprint under another
segment value within the radius.  Of two values the larger probes for the
smaller, which halves the probes and loses no pair.  Table rows and probes of a
segment value meet in one group, where whole distances are verified.

Equal fingerprints are one entry with its least id, so exact copies cost
nothing.  A group returns a spanning forest of its links, never all its pairs.
A segment value with more than ``block`` entries is dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.components import components
from cohort.llm.shared import attach, documents, id_type, materialize

WORDS, DISTANCE, SEED = 4, 4, 42
#: Entries of one segment value that one task compares.
BLOCK = 50_000
#: Up to so many fingerprints three segments are best, beyond it two.
THREE_SEGMENTS = 1 << 26
#: Groups of up to so many rows are compared all at once.
SMALL = 12


def majority(digests: np.ndarray) -> int:
    """The bits that are set in over half of the digests, rows of 8 bytes each."""
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(digests), 1 << 16):
        ones += np.unpackbits(digests[k : k + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(digests)).tobytes(), "big")


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of UTF-8 text over its word shingles, as an unsigned number."""
    from xxhash import xxh64_digest

    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        digests = xxh64_digest(joined, seed)
    else:
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(found) - words + 1].tolist()
        digests = b"".join(
            [xxh64_digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist())]
        )
    return majority(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8))


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fp (as a signed long) for ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, words, seed) for text in batch.column(1).to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run, f"doc_id {id_type(docs)}, fp long"
    )


def segments(distance: int, pieces: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment."""
    pieces = min(pieces, distance + 1)
    found, shift = [], 0
    for k in range(pieces):
        width = (64 - shift) // (pieces - k)
        radius = (distance + 1) // pieces - 1 + (k < (distance + 1) % pieces)
        found.append((shift, width, radius))
        shift += width
    return found


def segment_count(entries: DataFrame) -> int:
    """Into how many segments the fingerprints of a stored table are best cut."""
    return 3 if entries.count() <= THREE_SEGMENTS else 2


def _masks(width: int, radius: int) -> np.ndarray:
    """All ways to flip 1 to ``radius`` bits of a segment."""
    return np.array(
        [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)],
        dtype=np.uint64,
    )


def _bucket(values: np.ndarray, segment: int) -> np.ndarray:
    """Segment and value in one number; values have at most 32 bits."""
    return (values | np.uint64(segment << 40)).astype(np.int64)


def index_rows(entries: DataFrame, cut: list[tuple[int, int, int]]) -> DataFrame:
    """bucket, probe, fp, rep: each entry (fp, rep) in the table and as probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [_masks(width, radius) for _, width, radius in cut]
        for batch in batches:
            signed = batch.column(0).to_numpy()
            fps = signed.view(np.uint64)
            for k, (shift, width, _) in enumerate(cut):
                own = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                # Some ten thousand rows at a time.
                step = max(1, 50_000 // (len(masks[k]) + 1))
                for a in range(0, len(own), step):
                    near = own[a : a + step, None] ^ masks[k][None, :]
                    row, col = np.nonzero(near < own[a : a + step, None])
                    at = np.concatenate([np.arange(a, min(a + step, len(own))), row + a])
                    values = np.concatenate([own[a : a + step], near[row, col]])
                    n_table = len(at) - len(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_bucket(values, k)),
                            pa.array(np.arange(len(at)) >= n_table),
                            pa.array(signed[at]),
                            batch.column(1).take(pa.array(at)),
                        ],
                        names=["bucket", "probe", "fp", "rep"],
                    )

    return entries.select("fp", "rep").mapInArrow(
        run, f"bucket long, probe boolean, fp long, rep {id_type(entries, 'rep')}"
    )


def forest(fps: np.ndarray, distance: int, direct: bool = False) -> np.ndarray:
    """For each fingerprint the place of the first of its component in this list, or,
    if ``direct``, of the one that it was reached from, which is within ``distance``.

    Breadth first: each reached fingerprint is compared with those not reached yet,
    so a dense group costs little more than one comparison each.
    """
    root = np.full(len(fps), -1, dtype=np.int64)
    left = np.arange(len(fps))
    while len(left):
        seed, left = left[0], left[1:]
        root[seed] = seed
        frontier = [seed]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= distance
            if near.any():
                reached = left[near]
                left = left[~near]
                root[reached] = at if direct else seed
                frontier.extend(reached.tolist())
    return root


def group_links(
    bucket: np.ndarray, probe: np.ndarray, fps: np.ndarray, distance: int, direct: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked rows, a spanning forest at least; rows come sorted by group."""
    n = len(bucket)
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    sizes = np.diff(np.append(starts, n))
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    for lag in range(1, min(SMALL, int(sizes.max()))):
        a = np.flatnonzero((size_of[:-lag] > lag) & (size_of[:-lag] <= SMALL))
        a = a[bucket[a] == bucket[a + lag]]
        a = a[~(probe[a] & probe[a + lag])]
        a = a[np.bitwise_count(fps[a] ^ fps[a + lag]) <= distance]
        left.append(a)
        right.append(a + lag)
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        values = fps[start : start + size]
        tabled = values[~probe[start : start + size]]
        if not len(tabled):
            continue
        if len(tabled) * size <= 1 << 20:
            linked = np.bitwise_count(tabled[:, None] ^ values[None, :]) <= distance
            if linked.sum() == len(tabled):  # each with itself only
                continue
        root = forest(values, distance, direct)
        child = np.flatnonzero(root != np.arange(size))
        left.append(start + child)
        right.append(start + root[child])
    if not left:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Sorted batches regrouped so that no group (equal ``columns``) is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[-1] for c in columns]
        same = np.ones(batch.num_rows, dtype=bool)
        for c, value in zip(columns, last):
            same &= batch.column(c).to_numpy() == value.as_py()
        cut = int(np.argmax(same))
        if held and (cut or any(held[-1].column(c)[-1] != v for c, v in zip(columns, last))):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def links(
    entries: DataFrame, distance: int = DISTANCE, pieces: int = 3, block: int = BLOCK, direct: bool = False
) -> DataFrame:
    """a, b: links between the ids of ``entries`` (fp, rep), components kept whole.

    With ``direct`` each is within ``distance`` itself, else some join by way of others.
    """
    rows = index_rows(entries, segments(distance, pieces)).withColumn("pair", F.lit(0))
    crowded = (
        rows.filter(~F.col("probe")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > block)
        .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    crowded = materialize(crowded, "crowded")
    if not crowded.isEmpty():
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda other: F.least("mine", other) * F.col("blocks") + F.greatest("mine", other),
        )
        dealt = (
            rows.drop("pair").join(crowded, "bucket", "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("mine", mine)
        )
        rows = dealt.withColumn("pair", F.explode(pairs)).select(*rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket", "pair"]):
            bucket = table.column("bucket").to_numpy()
            pair = table.column("pair").to_numpy()
            group = np.cumsum(
                np.append(0, (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1]))
            )
            probe = table.column("probe").to_numpy()
            fps = table.column("fp").to_numpy().view(np.uint64)
            left, right = group_links(group, probe, fps, distance, direct)
            if len(left):
                rep = table.column("rep").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [rep.take(pa.array(left)), rep.take(pa.array(right))], names=["a", "b"]
                )

    kind = id_type(entries, "rep")
    return (
        rows.repartition("bucket", "pair")
        .sortWithinPartitions("bucket", "pair", "probe")
        .mapInArrow(run, f"a {kind}, b {kind}")
    )


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    distance: int = DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, fp (a signed long), component_id for every row of ``docs``.

    Texts get A-Z in lower case and are cut into words at ASCII white space;
    a shingle is ``words`` words, repeats included; a text with fewer words is one
    shingle, a text without any (null too) has fingerprint 0 and is linked like any
    other.  component_id is the least id reachable by links.  A row without an id
    gets the component of its fingerprint, null if all of these lack one.  Rows
    that repeat get the same result.  An empty table gives an empty result; other
    columns are ignored.
    """
    mine = documents(docs, id_col, text_col)
    fps = materialize(fingerprints(mine, words), "fingerprints")
    entries = materialize(
        fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")),
        "fingerprint-entries",
    )
    known = entries.filter(F.col("rep").isNotNull())
    pieces = segment_count(known)
    found = components(links(known, distance, pieces, block))
    labelled = materialize(
        entries.join(found, entries["rep"] == found["node"], "left").select(
            "fp", "n", F.coalesce("component", "rep").alias("component_id")
        ),
        "fingerprint-components",
    )
    return attach(fps, labelled, ["fp"], "n").select("doc_id", "fp", "component_id")
