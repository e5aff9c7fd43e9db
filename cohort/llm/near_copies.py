"""Near copies by SimHash, completed by an exact similarity join of word shingles.

Texts whose sets of shingles have a Jaccard similarity of at least ``threshold``
are linked, every such pair of them: a set's prefix is its first n - ceil(threshold
* n) + 1 shingles in an order common to all texts, and linked sets share a shingle
in both prefixes (prefix filter), the first of which leaves enough shingles behind
it in both (position filter).  The order puts the ``LATE`` most frequent shingles
last.  Any order gives the same links, so these counts are only those seen within
tasks.

Texts with the same shingles are one entry.  Fingerprints of these shingles that are
within ``BITS`` bits, found by operator 1's multi-index hashing, and least members of
MinHash groups are verified and give first components.  At the least similarity a
SimHash of 64 bits differs in about ten, so the join follows for the links it misses.
It passes over pairs within a first component, so a large group of near copies costs
few pairs, and over those whose sketches differ too much: a bit of a sketch is the
parity of the shingles that fall on it, so two sets differ in at least as many
shingles as their sketches in bits, and no link is lost.  A short sketch travels
with the rows of the join; it is full for long texts.  So all pairs found, the first
ones too, then meet sketches as long as the sets, which leave little but links.  Of
these pairs the likeliest of each end are verified first, then those that are still
apart.

Texts are read where they lie and travel only to be verified.  One pass makes the
keys of the sets; one counts the shingles of prefixes, packed by range of hashes;
most are found once and cannot link, so a third pass makes rows only of those that
pass a Bloom filter of the others.  Rows of a shingle with more than ``block`` rows
are dealt out as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.components import components
from cohort.llm.shared import (
    HashFilter, attach, drop_rows, dropping, few_rows, forget_memos, hash_filter, id_type, in_turn, lean, materialize,
    told_apart,
)
from cohort.llm.simhash import links as print_links
from cohort.llm.simhash import majority, segment_count, whole_groups

WORDS, THRESHOLD, SEED = 5, 0.8, 42
#: Bits in which fingerprints of near copies may differ; three segments, one bit of each flipped.
BITS = 5
#: Bits of a short sketch, and of a long one at least.
SKETCH = 256
#: MinHashes of a set, and how many must agree before a pair is verified ahead of the join.
HASHES, AGREE = 8, 4
#: Rows of one frequent shingle that one group holds, about.
BLOCK = 2_000
#: Shingles that a task counts at a time.
COUNTED = 2_000_000
#: Of these, how many it sends on; and how many come last in the order.
SENT, LATE = 20_000, 100_000
#: Shingles of prefixes that meet in one range, about.
RANGE = 1 << 20
#: Groups of up to so many rows are compared all at once.
SMALL = 12
_FACTORS = np.random.default_rng(SEED).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted hashes of the different word shingles of UTF-8 text."""
    from xxhash import xxh64_digest

    found = text.lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    made = [b" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))]
    digests = b"".join([xxh64_digest(s, SEED) for s in made])
    return np.unique(np.frombuffer(digests, dtype=">u8").astype(np.uint64))


def sketch(own: np.ndarray, bits: int = SKETCH) -> bytes:
    """The parity of the shingles that fall on each of ``bits`` places."""
    places = (own % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits).astype(np.uint8) & 1).tobytes()


def long_sketch(own: np.ndarray) -> bytes:
    """A sketch of at least a bit for each shingle, their number a power of two."""
    return sketch(own, max(SKETCH, 1 << max(0, len(own) - 1).bit_length()))


def apart(one: bytes, other: bytes) -> int:
    """In how many shingles sets with these long sketches differ at least."""
    x, y = sorted((np.frombuffer(s, np.uint8) for s in (one, other)), key=len)
    while len(y) > len(x):  # the halves of a sketch make the sketch of half as many places
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def _least_overlap(n, threshold: float):
    """How many of ``n`` shingles, of two sets together, must be common."""
    return threshold / (1 + threshold) * n - 1e-9


def _me(df: DataFrame, id_col: str | None, text_col: str) -> list[Column]:
    """Two hashes that tell a row from all but those with the same id and text."""
    own = [] if id_col is None else [quoted(id_col)]
    text = quoted(text_col).cast("string")
    return told_apart(*own, text)


def sets_of(docs: DataFrame, id_col: str | None, text_col: str, words: int) -> DataFrame:
    """Stored rows of two kinds.  With a key: me, me2, id, digest (of the text), key (of
    the set of shingles), fp (its fingerprint), least (its MinHashes), size and long (its
    long sketch) of each row; without: shingles (tokens) that a task met more than once,
    and how often (counts)."""
    own = F.lit(None).cast("long") if id_col is None else quoted(id_col)
    text = quoted(text_col).cast("string")
    given = docs.select(
        *_me(docs, id_col, text_col), own.alias("id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("digest"),
        F.coalesce(text, F.lit("")).cast("binary").alias("text"),
    )
    names = ["me", "me2", "id", "digest", "key", "fp", "least", "size", "long", "tokens", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_memos()
        held: list[np.ndarray] = []
        total = 0
        schema = None

        def flush() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = np.sort(np.argsort(-n, kind="stable")[:SENT])
            often = often[n[often] > 1]
            return pa.RecordBatch.from_arrays(
                [
                    *[pa.nulls(1, f.type) for f in schema],
                    pa.array([values[often].view(np.int64)], pa.list_(pa.int64())),
                    pa.array([n[often]], pa.list_(pa.int64())),
                ],
                names=names,
            )

        for batch in batches:
            keys, prints, least, sizes, sketches = [], [], [], [], []
            for text in in_turn(batch.column(4)):
                own = shingles(text, words)
                sizes.append(len(own))
                sketches.append(long_sketch(own))
                keys.append(blake2b(own.tobytes(), digest_size=16).digest())
                prints.append(majority(own.astype(">u8").view(np.uint8).reshape(-1, 8)))
                least.append([int((own * f).min().view(np.int64)) for f in _FACTORS] if len(own) else [])
                held.append(own)
                total += len(own)
            fps = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            made = [
                *batch.columns[:4], pa.array(keys, pa.binary()), fps, pa.array(least, pa.list_(pa.int64())),
                pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()),
            ]
            schema = [pa.field(n, c.type) for n, c in zip(names, made)]
            nothing = pa.nulls(len(keys), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*made, nothing, nothing], names=names)
            if total >= COUNTED:
                yield flush()
                held, total = [], 0
        if total:
            yield flush()

    schema = (
        f"me long, me2 long, id {id_type(given, 'id')}, digest string, key binary, fp long, least array<long>, "
        "size int, long binary, tokens array<long>, counts array<long>"
    )
    return materialize(given.mapInArrow(lean(run), schema), "shingle-sets")


def late_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that come last in the order, sorted, with their numbers."""
    counted = sets.filter("key IS NULL").select(F.inline(F.arrays_zip("tokens", "counts")))
    found = (
        counted.groupBy("tokens").agg(F.sum("counts").alias("n")).orderBy(F.desc("n"), "tokens").limit(LATE).toArrow()
    )
    tokens = found["tokens"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found["n"].to_numpy()[order]


def prefix(own: np.ndarray, late: tuple[np.ndarray, np.ndarray], threshold: float) -> np.ndarray:
    """The first shingles of a set in the common order."""
    tokens, counts = late
    often = np.zeros(len(own), dtype=np.int64)
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
        often = np.where(tokens[at] == own, counts[at], 0)
    order = np.lexsort((own, often))
    return own[order[: len(own) - math.ceil(threshold * len(own) - 1e-9) + 1]]


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def repeated(texts: DataFrame, late, words: int, threshold: float, ranges: int) -> DataFrame:
    """hash: the first bits of shingles that are in the prefixes of two rows or more."""
    shared = texts.sparkSession.sparkContext.broadcast(late)
    bits = ranges.bit_length() - 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held)) >> np.uint64(32 - bits)
            # Twice is as good as more often.
            same = np.append(False, found[1:] == found[:-1])
            found = found[~(same & np.append(False, same[:-1]))]
            places = (found >> np.uint64(32)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.append(True, places[1:] != places[:-1])), len(places)).tolist()
            low = found.astype(np.uint32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(places[cuts[:-1]]),
                    pa.array([low[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                ],
                names=["place", "low"],
            )

        for batch in batches:
            for text in in_turn(batch.column(0)):
                if len(own := shingles(text, words)):
                    held.append(prefix(own, shared.value, threshold))
                    total += len(held[-1])
            if total >= COUNTED:
                yield flush()
                held, total = [], 0
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for place, runs in groupby(rows, key=lambda r: r[0]):
            low = np.sort(np.concatenate([np.frombuffer(r[1], np.uint32) for r in runs]))
            found = np.unique(low[1:][low[1:] == low[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64) | np.int64(place << 32))], names=["hash"])

    met = texts.mapInArrow(lean(pack), "place long, low binary").repartition("place").sortWithinPartitions("place")
    return materialize(met.mapInArrow(lean(merge), "hash long"), "repeated-shingles")


def prefix_rows(
    texts: DataFrame, known: DataFrame, late, often: HashFilter, words: int, threshold: float
) -> DataFrame:
    """token, key, size, sketch, rest, first: a stored row for each set and shingle of its prefix
    that others may have; ``rest`` of its ``size`` shingles are not before it in the order.
    ``first`` is the component of the set in ``known`` (node, component), else its key.

    The rows of a set travel as one until they have their component.
    """
    shared = texts.sparkSession.sparkContext.broadcast((late, often))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, passes = shared.value
        for batch in batches:
            keys, sizes, sketches, tokens, rests = [], [], [], [], []
            for text in in_turn(batch.column(0)):
                if not len(own := shingles(text, words)):
                    continue
                begin = prefix(own, late, threshold)
                at = np.flatnonzero(passes(begin))
                if len(at):
                    keys.append(blake2b(own.tobytes(), digest_size=16).digest())
                    sizes.append(len(own))
                    sketches.append(sketch(own))
                    tokens.append(begin[at].view(np.int64))
                    rests.append((len(own) - at).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()),
                    pa.array(tokens, pa.list_(pa.int64())), pa.array(rests, pa.list_(pa.int32())),
                ],
                names=["key", "size", "sketch", "token", "rest"],
            )

    kind = "key binary, size int, sketch binary, token array<long>, rest array<int>"
    sets = texts.mapInArrow(lean(run), kind).dropDuplicates(["key"])
    parted = sets.join(known, F.col("key") == F.col("node"), "left").select(
        "key", "size", "sketch", F.coalesce("component", "key").alias("first"), F.inline(F.arrays_zip("token", "rest"))
    )
    return materialize(parted, "prefixes")


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` with pair, mine, alone: a group is a token and a ``pair`` of blocks;
    ``mine`` is the row's own block, ``alone`` says that the pair is this block with itself.

    Only crowded tokens, with more than ``block`` rows, have several blocks, or none if
    all their rows have one first component and so nothing to find with each other.
    """
    crowded = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    crowded = materialize(crowded, "crowded-tokens")
    if crowded.isEmpty():
        return rows.withColumns({"mine": F.lit(0), "pair": F.lit(0).cast("long"), "alone": F.lit(True)})
    blocks = F.when(F.min("first") < F.max("first"), F.ceil(F.any_value("n") / block)).otherwise(0)
    dealt = rows.join(few_rows(crowded), "token").groupBy("token").agg(blocks.alias("blocks"))
    dealt = few_rows(materialize(dealt, "token-blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return (
        rows.join(dealt, "token", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
        .filter("blocks > 0")
        .withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("other", other)
        .withColumn("pair", F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other"))
        .withColumn("alone", F.col("mine") == F.col("other"))
        .drop("blocks", "other")
    )


def _grouped(
    group: np.ndarray, columns: list[np.ndarray], threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows of one group that may be linked and have different components."""
    mine, alone, size, rest, sketches, first = columns

    def fit(a, b: np.ndarray) -> np.ndarray:
        """Which of the places ``b`` may be linked with ``a``, one for all or one each."""
        fits = (
            (np.minimum(rest[a], rest[b]) >= _least_overlap(size[a] + size[b], threshold))
            & (alone[a] | (mine[a] != mine[b]))
            & (first[a] != first[b])
        )
        at = np.flatnonzero(fits)
        x, y = (a if np.ndim(a) == 0 else a[at]), b[at]
        # Shingles that only one of both has.
        differ = np.bitwise_count(sketches[x] ^ sketches[y]).sum(axis=-1, dtype=np.int64)
        return at[size[x] + size[y] - differ >= 2 * _least_overlap(size[x] + size[y], threshold)]

    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, len(group)))
    size_of = np.repeat(sizes, sizes)
    for lag in range(1, min(SMALL, int(sizes.max()))):
        a = np.flatnonzero((size_of[:-lag] > lag) & (size_of[:-lag] <= SMALL))
        a = a[group[a] == group[a + lag]]
        a = a[fit(a, a + lag)]
        yield a, a + lag
    for start, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        if (first[start : start + n] == first[start]).all():
            continue
        for k in range(start, start + n - 1):
            others = np.arange(k + 1, start + n)
            others = others[fit(k, others)]
            yield np.full(len(others), k), others


def candidates(rows: DataFrame, threshold: float) -> DataFrame:
    """a, b, n: keys that may be linked, every link that is not within a first component,
    and how many shingles of their prefixes they were found by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["token", "pair"]):
            token, pair = table.column("token").to_numpy(), table.column("pair").to_numpy()
            group = np.cumsum(np.append(0, (token[1:] != token[:-1]) | (pair[1:] != pair[:-1])))
            columns = [table.column(c).to_numpy() for c in ("mine", "alone", "size", "rest")]
            packed = b"".join(table.column("sketch").to_pylist())
            columns.append(np.frombuffer(packed, np.uint64).reshape(-1, SKETCH // 64))
            first = table.column("first").combine_chunks().dictionary_encode().indices.to_numpy()
            key = table.column("key").combine_chunks()
            held: list[tuple[np.ndarray, np.ndarray]] = []
            n = 0
            for found in chain(_grouped(group, [*columns, first], threshold), [None]):
                if found is not None:
                    held.append(found)
                    n += len(found[0])
                if n and (found is None or n > 50_000):
                    left, right = (pa.array(np.concatenate(c)) for c in zip(*held))
                    yield pa.RecordBatch.from_arrays([key.take(left), key.take(right)], names=["a", "b"])
                    held, n = [], 0

    found = (
        rows.repartition("token", "pair")
        .sortWithinPartitions("token", "pair")
        .mapInArrow(lean(run), "a binary, b binary")
    )
    return (
        found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    )


def hopeful(pairs: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``pairs`` (a, b, maybe more) that may be linked by their long sketches, every link."""
    columns = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, one, other = (batch.column(c) for c in ("size_a", "size_b", "long_a", "long_b"))
            both = x.to_numpy().astype(np.int64) + y.to_numpy()
            differ = np.array([apart(*p) for p in zip(in_turn(one), in_turn(other))], dtype=np.int64)
            yield batch.select(columns).filter(pa.array(both - differ >= 2 * _least_overlap(both, threshold)))

    met = pairs
    for end in ("a", "b"):
        part = entries.select(F.col("key").alias(end), F.col("size").alias(f"size_{end}"), F.col("long").alias(f"long_{end}"))
        met = met.join(part, end)
    met = met.select(*columns, "size_a", "size_b", "long_a", "long_b")
    return met.mapInArrow(lean(run), pairs.schema)


def best_pairs(pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b, n) the one with the largest n of each end."""
    ends = pairs.select(
        F.explode(F.array(F.struct(F.col("a").alias("own"), "n", F.col("b").alias("other")),
                          F.struct(F.col("b").alias("own"), "n", F.col("a").alias("other")))).alias("e")
    ).select("e.*")
    best = ends.groupBy("own").agg(F.max(F.struct("n", "other"))["other"].alias("other"))
    return best.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).distinct()


def in_other_components(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose ends ``known`` (node, component) does not join."""
    out = pairs
    for end in ("a", "b"):
        part = known.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        out = out.join(part, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return out.filter("of_a <> of_b").select("a", "b")


def texts_of(docs: DataFrame, id_col: str | None, text_col: str, keys: DataFrame, entries: DataFrame) -> DataFrame:
    """key, text of these keys, stored: each once, from the row that stands for it.

    Rows are picked where they lie, by a Bloom filter, before any text travels.
    """
    wanted = materialize(entries.join(keys, "key", "left_semi").select("key", "me", "me2"), "wanted")
    passes = hash_filter(wanted.select(F.col("me").alias("hash")), 64)
    shared = docs.sparkSession.sparkContext.broadcast(passes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value(batch.column(0).to_numpy().view(np.uint64))))

    text = F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary").alias("text")
    picked = docs.select(*_me(docs, id_col, text_col), text).mapInArrow(lean(run), "me long, me2 long, text binary")
    # Of a key one row is wanted, so rows that repeat are alike in me, me2, by which the join has dealt them.
    texts = picked.join(wanted, ["me", "me2"]).dropDuplicates(["me", "me2"]).select("key", "text")
    return materialize(texts, "wanted-texts")


def verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose texts have the similarity, stored; they outlive the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(in_turn(batch.column(2)), in_turn(batch.column(3))):
                x, y = shingles(one, words), shingles(other, words)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= _least_overlap(len(x) + len(y), threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = (
        pairs.join(texts.withColumnsRenamed({"key": "a", "text": "one"}), "a")
        .join(texts.withColumnsRenamed({"key": "b", "text": "other"}), "b")
        .select("a", "b", "one", "other")
        .mapInArrow(lean(run), "a binary, b binary")
    )
    return materialize(found, "near-links", outlives=True)


def print_pairs(entries: DataFrame) -> DataFrame:
    """a, b: entries whose fingerprints are equal or near, each fingerprint by its least key.

    Of a dense group there is a spanning forest of links within ``BITS`` bits.
    """
    prints = materialize(
        entries.groupBy("fp").agg(F.min("key").alias("hub"), F.count(F.lit(1)).alias("n")), "set-fingerprints"
    )
    near = print_links(prints.select("fp", F.col("fp").alias("rep")), BITS, segment_count(prints), direct=True)
    for end in ("a", "b"):
        hubs = prints.select(F.col("fp").alias(end), F.col("hub").alias(f"hub_{end}"))
        near = near.join(hubs, end)
    same = attach(entries.select("key", "fp"), prints.filter("n > 1"), ["fp"], "n").filter("key <> hub")
    return near.select(F.col("hub_a").alias("a"), F.col("hub_b").alias("b")).unionByName(
        same.select(F.col("hub").alias("a"), F.col("key").alias("b"))
    )


def minhash_pairs(entries: DataFrame) -> DataFrame:
    """a, b: entries and the least member of a MinHash group, if more MinHashes agree.

    Of the others some bits tell whether they agree.
    """
    bits = F.transform("least", lambda x: x.bitwiseAND(F.lit(0x7FFF)).cast("short"))
    rows = entries.select("key", bits.alias("bits"), F.posexplode("least").alias("k", "hash"))
    groups = materialize(
        rows.groupBy("k", "hash").agg(F.min(F.struct("key", "bits")).alias("hub"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1"),
        "minhash-groups",
    )
    same = F.aggregate(
        F.arrays_zip("bits", F.col("hub.bits").alias("other")), F.lit(0),
        lambda n, x: n + (x["bits"] == x["other"]).cast("int"),
    )
    met = attach(rows, groups, ["k", "hash"], "n").filter((F.col("key") != F.col("hub.key")) & (same >= AGREE))
    return met.select(F.col("hub.key").alias("a"), F.col("key").alias("b"))


def first_pairs(entries: DataFrame) -> DataFrame:
    """a, b: pairs of entries that SimHash and MinHash take for near copies, not verified."""
    found = print_pairs(entries).unionByName(minhash_pairs(entries))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def grouped_rows(
    docs: DataFrame, id_col: str | None, text_col: str, words: int = WORDS, threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """me, me2, id, digest, near_group of each row of ``docs``, without its text, stored.

    All other tables that are stored on the way are deleted.
    """
    with dropping(docs.sparkSession):
        return _grouped_rows(docs, id_col, text_col, words, threshold, block)


def _grouped_rows(
    docs: DataFrame, id_col: str | None, text_col: str, words: int, threshold: float, block: int
) -> DataFrame:
    sets = sets_of(docs, id_col, text_col, words)
    rows = sets.filter("key IS NOT NULL").drop("tokens", "counts")
    # Equal sets have equal fingerprints.
    entries = materialize(
        rows.groupBy("key").agg(
            F.min(F.struct("me", "me2")).alias("own"), F.count(F.lit(1)).alias("n"),
            *[F.any_value(c).alias(c) for c in ("fp", "least", "size", "long")],
        ).select("key", "own.*", "fp", "least", "size", "long", "n"),
        "set-entries",
    )

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()

    def check(some: DataFrame) -> DataFrame:
        with dropping(docs.sparkSession):  # texts go as soon as they are compared
            return verified(some, texts_of(docs, id_col, text_col, ends(some), entries), words, threshold)

    with dropping(docs.sparkSession):
        pairs = materialize(hopeful(first_pairs(entries), entries, threshold), "first-pairs", outlives=True)
    first = check(pairs)
    known = materialize(components(first), "first-components")

    late, texts = late_shingles(sets), _texts(docs, text_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A prefix has a shingle for every 30 bytes, about.
    ranges = 1 << min(31, (size // 30 // RANGE).bit_length())
    often = hash_filter(repeated(texts, late, words, threshold, ranges), 32 + ranges.bit_length() - 1)
    prefixes = prefix_rows(texts, known, late, often, words, threshold)
    pairs = materialize(hopeful(candidates(in_blocks(prefixes, block), threshold), entries, threshold), "pairs")

    # The likeliest partner of each end comes first: what that joins needs no more pairs.
    best = materialize(best_pairs(pairs), "best-pairs")
    links = first.unionByName(check(best))
    joined = materialize(components(links), "components")
    rest = in_other_components(pairs.join(best, ["a", "b"], "left_anti"), joined)
    rest = materialize(rest, "rest-pairs")
    if not rest.isEmpty():
        joined = components(links.unionByName(check(rest)))
    groups = materialize(
        entries.select("key", "n").join(joined, F.col("key") == F.col("node"), "left").select(
            "key", "n", F.coalesce("component", "key").alias("near_group")
        ),
        "near-groups",
    )
    return materialize(
        attach(rows, groups, ["key"], "n").select("me", "me2", "id", "digest", "near_group"), "near-rows", outlives=True
    )


def near_copies(
    docs: DataFrame,
    text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """All columns of ``docs`` and near_group, equal for rows whose texts are linked.

    Texts get A-Z in lower case and are cut into words at ASCII white space; a
    shingle is ``words`` words; a text with fewer words is one shingle; texts
    without any (null too) are linked with each other.  Texts are linked at a
    Jaccard similarity of their sets of shingles of at least ``threshold``, and
    through links.  Ids play no part.  A column near_group of ``docs`` is replaced.
    An empty table gives an empty result.
    """
    rows = grouped_rows(docs, None, text_col, words, threshold, block)
    groups = rows.groupBy("me", "me2").agg(F.any_value("near_group").alias("g"))
    own = F.struct(*[quoted(c) for c in docs.columns if c != "near_group"]).alias("own")
    return docs.select(own, *_me(docs, None, text_col)).join(groups, ["me", "me2"]).select(
        "own.*", F.col("g").alias("near_group")
    )


def drop_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    threshold: float = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """``docs`` with one row of each group of near copies, the one with the least id.

    Rows without an id come last; of rows that share an id or lack one, the one with
    the least SHA-256 of its text stays, then any.  Only the rows to drop are joined
    with the texts, as nearly all stay.
    """
    rows = grouped_rows(docs, id_col, text_col, words, threshold, block)
    order = F.struct(F.col("id").isNull(), "id", "digest", "me", "me2")
    best = rows.groupBy("near_group").agg(
        F.min_by(F.struct("me", "me2"), order).alias("best"), F.count(F.lit(1)).alias("n")
    )
    best = materialize(best.filter("n > 1"), "near-best")
    own = F.struct("me", "me2")
    gone = materialize(
        attach(rows, best, ["near_group"], "n").groupBy("me", "me2").agg(
            F.max(own == F.col("best")).alias("stays"), F.count(F.lit(1)).alias("copies")
        ).filter("NOT stays OR copies > 1"),
        "near-dropped",
    )
    marked = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("own"), *_me(docs, id_col, text_col))
    return drop_rows(marked, gone)
