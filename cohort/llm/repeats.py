"""Removal of every byte of a long string that also starts anywhere else.

A string of ``length`` bytes has a minimizer: the least hash of its ``GRAM``-byte
grams.  Equal strings have equal minimizers at equal places, so all occurrences
of a repeated string meet under one gram, wherever they are.  Per anchor (a
minimizer's place) its context is the bytes that strings through it can reach.

1. Anchors are listed as hashes of gram and context; grams found once are dropped.
2. A context found twice repeats as a whole: all its bytes go.
3. Different contexts of one gram (where repeats begin and end) are brought
   together as bytes, once each.  In every task they become a run-length index: the
   Burrows-Wheeler transform of the contexts, compressed to runs, with suffix
   samples at the first and last entry of each run.  The length of a match with
   the neighbouring suffix is compared at the samples only; streaming through the
   text it falls by one per byte until the next sample.  That gives the matching
   statistics of every place with all other places, and those of at least
   ``length`` are marked.
4. A gram with more than ``crowd`` contexts does not go to one task: its contexts
   are sorted over all tasks by either side and compared with their neighbours.

Overlapping contexts of one document are joined before they are indexed, so a
place is in an index once and never matches itself.  Texts travel compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.shared import attach, documents, id_type, materialize, slices

LENGTH, GRAM = 200, 32
#: Contexts of one gram that one task indexes.
CROWD = 4_000
#: Bytes that are hashed, and that are indexed, at one time.
UNIT_BYTES, INDEX_BYTES = 1 << 19, 1 << 20
#: What tells a row from all but those with the same id and text: two hashes of both.
_ROW = ["me", "me2"]


def keyed(docs: DataFrame) -> DataFrame:
    """me, me2, text as bytes, doc_id."""
    hashes = [F.xxhash64(F.lit(k), "doc_id", "text").alias(name) for k, name in enumerate(_ROW)]
    return docs.select(*hashes, F.col("text").cast("binary").alias("text"), "doc_id")


# -- anchors ---------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or, with np.maximum, greatest) of each ``width`` values in a row."""
    done = 1
    while done * 2 <= width:
        values = least(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return least(values[: len(values) - rest], values[rest:]) if rest else values


def anchor_places(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Ascending places of the minimizers of all ``length``-byte strings of the texts."""
    n = len(buffer) - gram + 1
    window = length - gram + 1
    if n < window:
        return np.empty(0, dtype=np.int64)
    # A polynomial hash by doubling: of 1, 2, 4, ... bytes.
    mixed = (buffer.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    factor, done = 0x01000193, 1
    while done < gram:
        mixed = mixed[:-done] * np.uint32(factor) + mixed[done:]
        factor, done = factor * factor & 0xFFFFFFFF, done * 2
    mixed ^= mixed >> np.uint32(16)
    mixed *= np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(13)
    np.maximum(mixed, np.uint32(1), out=mixed)
    least = _sliding(mixed, window, np.minimum)
    # Strings that would run over the end of a text do not count.
    flow = np.zeros(len(least) + 1, dtype=np.int32)
    long_enough = ends - starts >= length
    np.add.at(flow, starts[long_enough], 1)
    np.add.at(flow, ends[long_enough] - length + 1, -1)
    least[np.cumsum(flow[:-1]) == 0] = 0
    edge = np.zeros(window - 1, dtype=np.uint32)
    greatest = _sliding(np.concatenate((edge, least, edge)), window, np.maximum)
    return np.flatnonzero(greatest[:n] == mixed)


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """gram_hash, context_hash, me, me2, pos for ``keyed`` documents."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_digest, xxh64_digest

        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in slices([len(t) for t in texts], UNIT_BYTES):
                joined = b"".join(texts[a:b])
                ends = np.cumsum([len(t) for t in texts[a:b]])
                starts = ends - [len(t) for t in texts[a:b]]
                places = anchor_places(np.frombuffer(joined, np.uint8), starts, ends, length, gram)
                if not len(places):
                    continue
                row = np.searchsorted(ends, places, side="right")
                first = np.maximum(starts[row], places - reach)
                last = np.minimum(ends[row], places + length)
                grams = b"".join([xxh64_digest(joined[p : p + gram]) for p in places.tolist()])
                contexts = b"".join(
                    [
                        xxh3_64_digest(joined[f:t], p - f)
                        for p, f, t in zip(places.tolist(), first.tolist(), last.tolist())
                    ]
                )
                at = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(grams, "<i8")),
                        pa.array(np.frombuffer(contexts, "<i8")),
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array((places - starts[row]).astype(np.int32)),
                    ],
                    names=["gram_hash", "context_hash", "me", "me2", "pos"],
                )

    return docs.mapInArrow(
        run, f"gram_hash long, context_hash long, me long, me2 long, pos int"
    )


# -- the run-length index ----------------------------------------------------


def suffix_order(packed: np.ndarray, left: np.ndarray, segment: np.ndarray, step: int) -> np.ndarray:
    """Suffixes in order; a suffix ends with its segment, equal ones by segment.

    ``packed`` orders the first ``step`` bytes, ``left`` is how many bytes follow
    up to and including the mark at the segment's end.  Prefix doubling, each round
    for the suffixes that are still tied only.
    """
    n = len(packed)
    # Ties are all resolved below, so neither sort has to be stable.
    order = np.argsort(packed)
    head = np.append(True, packed[order[1:]] != packed[order[:-1]])
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = first
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    segments = int(segment[-1]) + 1 if n else 0
    while len(tied):
        here = order[tied]
        inside = left[here] >= step
        then = np.minimum(here + step, n - 1)
        second = np.where(inside, rank[then] + segments, segment[here])
        group = rank[here]
        resort = np.argsort(group * (n + segments) + second)
        here, second, group = here[resort], second[resort], group[resort]
        order[tied] = here
        head = np.append(True, (group[1:] != group[:-1]) | (second[1:] != second[:-1]))
        rank[here] = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]
        tied = tied[~(head & np.append(head[1:], True))]
        step *= 2
    return order


def common_lengths(packed: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many bytes the suffixes at ``a`` and ``b`` have in common, pair by pair."""
    most = np.minimum(left[a], left[b])
    found = np.zeros(len(a), dtype=np.int64)
    active = np.arange(len(a))
    while len(active):
        now = found[active]
        active = active[now < most[active]]
        now = found[active]
        same = packed[a[active] + now] == packed[b[active] + now]
        found[active[same]] += step
        rest = active[~same]
        # The bytes before the first one that differs.
        differ = packed[a[rest] + found[rest]] ^ packed[b[rest] + found[rest]]
        for k in range(step):
            found[rest] += differ >> (9 * (step - 1 - k)) == 0
        active = active[same]
    return np.minimum(found, most)


def match_lengths(segments: list[bytes]) -> list[np.ndarray]:
    """Per place of each segment, the longest match with any other place."""
    step = 7
    sizes = np.array([len(s) + 1 for s in segments])
    ends = np.cumsum(sizes)
    n = int(ends[-1])
    # 0 marks an end, bytes are 1 to 256: nine bits each, seven to a number.
    values = np.zeros(n, dtype=np.int64)
    inside = np.ones(n, dtype=bool)
    inside[ends - 1] = False
    values[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + 1
    segment = np.repeat(np.arange(len(segments)), sizes)
    left = ends[segment] - 1 - np.arange(n)
    packed = np.zeros(n, dtype=np.int64)
    for k in range(step):
        shifted = np.zeros(n, dtype=np.int64)
        shifted[: max(0, n - k)] = values[k:]
        packed = (packed << 9) | np.where(left >= k, shifted, 0)
    # The last bytes of a number are followed by the end, never by the next segment.
    order = suffix_order(packed, left, segment, step)
    # The transform: the byte before each suffix; starts of segments match nothing.
    before = np.append(-1, values[:-1])[order]
    starts = left[order] == sizes[segment[order]] - 1
    before[starts] = -1 - segment[order][starts]
    edge = np.flatnonzero(before[1:] != before[:-1])  # between runs
    shared = common_lengths(packed, left, order[edge], order[edge + 1], step)
    longest = np.zeros(n, dtype=np.int64)
    # First entries of runs know the suffix above, last entries the one below.
    for sampled, outer in ((order[edge + 1], order[0]), (order[edge], order[-1])):
        reach = np.full(n, -1, dtype=np.int64)
        reach[sampled] = sampled + shared
        reach[outer] = outer
        latest = np.maximum.accumulate(np.where(reach >= 0, np.arange(n), 0))
        np.maximum(longest, reach[latest] - np.arange(n), out=longest)
    return [longest[e - s : e - 1] for s, e in zip(sizes.tolist(), ends.tolist())]


def joined_segments(rows: list[tuple]) -> list[tuple]:
    """(row key, first byte, bytes) of (row key, first, bytes), overlaps joined."""
    out: list[list] = []
    for key, first, text in sorted(rows):
        if out and out[-1][0] == key and first <= out[-1][1] + len(out[-1][2]):
            more = first + len(text) - out[-1][1] - len(out[-1][2])
            if more > 0:
                out[-1][2] += text[-more:]
        else:
            out.append([key, first, bytearray(text)])
    return [(key, first, bytes(text)) for key, first, text in out]


def index_spans(rows: list[tuple], length: int) -> Iterator[tuple]:
    """(row key, first, end) of the bytes in strings that repeat among the rows."""
    segments = joined_segments(rows)
    for (key, first, _), longest in zip(segments, match_lengths([s for _, _, s in segments])):
        hit = np.flatnonzero(longest >= length)
        if len(hit):
            cut = np.flatnonzero(np.diff(hit) > length) + 1
            begins = hit[np.append(0, cut)]
            lasts = hit[np.append(cut - 1, len(hit) - 1)]
            for b, e in zip(begins.tolist(), lasts.tolist()):
                yield key, first + b, first + e + length


# -- the job -----------------------------------------------------------------


def packed_texts(docs: DataFrame, *more: str) -> DataFrame:
    """me, me2, packed and ``more`` columns: texts, compressed to travel."""
    names = [*_ROW, "packed", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [pack.compress(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), *batch.columns[3:]], names=names
            )

    fields = "".join(f", {c} {id_type(docs, c)}" for c in more)
    return docs.select(*_ROW, "text", *more).mapInArrow(run, f"me long, me2 long, packed binary{fields}")


def _unpack(packed: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packed)


def _same_row(a: DataFrame, b: DataFrame):
    return (a["me"] == b["me"]) & (a["me2"] == b["me2"])


def contexts(docs: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """gram_hash, crowded, me, me2, pos, first, context of wanted anchors."""
    reach = length - gram
    places = wanted.groupBy(*_ROW).agg(
        F.collect_list(F.struct("gram_hash", "crowded", "pos")).alias("places")
    )
    texts = packed_texts(docs.filter(F.octet_length("text") >= length))
    rows = texts.join(places, _same_row(texts, places)).select(
        texts["me"], texts["me2"], "packed", "places"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 100):
                batch = whole.slice(k, 100)
                at, found = [], []
                for row, (packed, listed) in enumerate(
                    zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                ):
                    text = _unpack(packed)
                    for place in listed:
                        first = max(0, place["pos"] - reach)
                        found.append(
                            (place["gram_hash"], place["crowded"], place["pos"], first,
                             text[first : place["pos"] + length])
                        )
                        at.append(row)
                if not found:
                    continue
                grams, crowded, pos, first, context = zip(*found)
                rows_of = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams, pa.int64()),
                        pa.array(crowded, pa.bool_()),
                        batch.column(0).take(rows_of),
                        batch.column(1).take(rows_of),
                        pa.array(pos, pa.int32()),
                        pa.array(first, pa.int32()),
                        pa.array(context, pa.binary()),
                    ],
                    names=["gram_hash", "crowded", "me", "me2", "pos", "first", "context"],
                )

    return rows.mapInArrow(
        run,
        f"gram_hash long, crowded boolean, me long, me2 long, pos int, "
        "first int, context binary",
    )


def indexed_spans(found: DataFrame, length: int) -> DataFrame:
    """me, me2, first, end from contexts that meet by gram in run-length indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            spans = list(index_spans(held, length))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0] for key, _, _ in spans], pa.int64()),
                    pa.array([key[1] for key, _, _ in spans], pa.int64()),
                    pa.array([f for _, f, _ in spans], pa.int32()),
                    pa.array([e for _, _, e in spans], pa.int32()),
                ],
                names=["me", "me2", "first", "end"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("gram_hash", "me", "me2", "first", "context")]
            for gram, me, me2, first, context in zip(*columns):
                if gram != last and size >= INDEX_BYTES:
                    yield flush()
                    held, size = [], 0
                last = gram
                held.append(((me, me2), first, context))
                size += len(context)
        if held:
            yield flush()

    return (
        found.select("gram_hash", "me", "me2", "first", "context")
        .repartition("gram_hash")
        .sortWithinPartitions("gram_hash")
        .mapInArrow(run, f"me long, me2 long, first int, end int")
    )


def shared_length(a: bytes, b: bytes) -> int:
    """How many bytes two strings have in common at their start."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def sorted_neighbours(rows: DataFrame, ahead: str, behind: str) -> DataFrame:
    """``rows`` (gram_hash, left, right, ...) plus what each shares with its neighbours.

    Sorted by gram, ``ahead`` and ``behind``, the row that shares most of ``ahead``
    with a row stands next to it.  ``by_<ahead>`` lists four lengths: what the row
    before shares of ``left`` and of ``right``, then the same of the row after.  They
    are -1 where a partition begins or ends, 0 where another gram does.
    """
    added = f"by_{ahead}"
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    columns = list(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (gram, left, right) of the last row that was seen
        held = None  # its batch of one row
        before = unknown = (-1, -1)

        def out(batch, lengths):
            shared = pa.array(lengths, pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([*batch.columns, shared], names=[*columns, added])

        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = []
            for key in zip(*[batch.column(columns.index(c)).to_pylist() for c in ("gram_hash", "left", "right")]):
                if last is not None:
                    same = last[0] == key[0]
                    common = (
                        (shared_length(last[1], key[1]), shared_length(last[2], key[2])) if same else (0, 0)
                    )
                    lengths.append([*before, *common])
                    before = common
                last = key
            if held is not None:
                yield out(held, lengths[:1])
                lengths = lengths[1:]
            yield out(batch.slice(0, len(lengths)), lengths)
            held = batch.slice(len(lengths))
        if held is not None:
            yield out(held, [[*before, *unknown]])

    return (
        rows.repartitionByRange("gram_hash", ahead, behind)
        .sortWithinPartitions("gram_hash", ahead, behind)
        .mapInArrow(run, f"{kind}, {added} array<int>")
    )


_SIDES = ["left", "right", "by_left", "by_right"]


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names])


def context_strings(
    left: bytes, right: bytes, by_left: list[int], by_right: list[int], span: int, gram: int
) -> tuple[int, int, list[int]]:
    """Least and greatest settled x, and every x that may repeat and is this row's to count."""
    near = [by_left[:2], by_left[2:], by_right[:2], by_right[2:]]
    # Less on the left needs more on the right.
    settled = [(max(0, span + gram - r), min(l, span)) for l, r in near]
    settled = [(a, b) for a, b in settled if a <= b]
    least = min([a for a, _ in settled], default=span + 1)
    most = max([b for _, b in settled], default=-1)
    lefts, rights = (by_left[0], by_left[2]), (by_right[1], by_right[3])
    far_l = len(left) if -1 in lefts else max(lefts)
    far_r = len(right) if -1 in rights else max(rights)
    # The row before has these strings, and so has one that is equal on the right.
    before = range(span + gram - by_left[1], by_left[0] + 1)
    equal = by_right[0] if by_right[1] == len(right) else -1
    possible = range(max(0, span + gram - far_r), min(far_l, span) + 1)
    return least, most, [x for x in possible if x not in before and x > equal]


def string_digest(left: bytes, right: bytes, x: int, length: int) -> int:
    from xxhash import xxh64_digest

    return int.from_bytes(xxh64_digest(left[:x][::-1] + right[: length - x]), "little", signed=True)


def crowded_spans(found: DataFrame, length: int, gram: int) -> DataFrame:
    """me, me2, first, end for grams with too many contexts for one index.

    A string through the gram has x bytes on the left of it and the rest on the
    right.  All strings of one context hold its gram, so they cover what those of
    the least and greatest repeated x cover, and any x between the two is settled.
    Two global sorts, by left and by right, tell for each context how far any other
    agrees on either side, which bounds x, and what its neighbours share of both
    sides, which settles ranges of x.  The open strings between the bounds are counted
    by hash, and with them the settled strings of the same gram and x, which they may
    equal.  One that an earlier neighbour has too is settled and left to that row.
    Earlier means by left, then right, in either sort, so some row counts the string.
    """
    span = length - gram

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            columns = [batch.column(c).to_pylist() for c in ("pos", "first", "context")]
            for pos, first, context in zip(*columns):
                left.append(context[: pos - first][::-1])
                right.append(context[pos - first :])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("gram_hash", "me", "me2", "pos")],
                 pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                names=["gram_hash", "me", "me2", "pos", "left", "right"],
            )

    rows = materialize(
        found.mapInArrow(
            sides,
            f"gram_hash long, me long, me2 long, pos int, left binary, right binary",
        ),
        "crowded-sides",
    )
    by_left = materialize(sorted_neighbours(rows, "left", "right"), "crowded-by-left")
    both = materialize(sorted_neighbours(by_left, "right", "left"), "crowded-by-both")
    string = "gram_hash long, offset int, string_hash long"

    def hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The settled strings of each context as one span, and its open strings."""
        for batch in batches:
            rows_at, spans = [], []
            for row, (pos, *sides_of) in enumerate(_columns(batch, "pos", *_SIDES)):
                least, most, strings = context_strings(*sides_of, span, gram)
                if least <= most:
                    rows_at.append(row)
                    spans.append((pos - most, pos - least + length, None, None))
                for x in strings:
                    if not least <= x <= most:
                        rows_at.append(row)
                        digest = string_digest(*sides_of[:2], x, length)
                        spans.append((pos - x, pos - x + length, x, digest))
            first, end, offset, digests = zip(*spans) if spans else ((), (), (), ())
            at = pa.array(rows_at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(c)).take(at) for c in ("gram_hash", *_ROW)],
                    pa.array(first, pa.int32()), pa.array(end, pa.int32()),
                    pa.array(offset, pa.int32()), pa.array(digests, pa.int64()),
                ],
                names=["gram_hash", *_ROW, "first", "end", "offset", "string_hash"],
            )

    stored = materialize(
        both.mapInArrow(
            hulls,
            f"gram_hash long, me long, me2 long, first int, end int, offset int, "
            "string_hash long",
        ),
        "crowded-spans",
    )
    opened = stored.filter(F.col("offset").isNotNull())

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The settled strings that open ones may equal."""
        for batch in batches:
            found_strings = []
            for gram_hash, offsets, *sides_of in _columns(batch, "gram_hash", "offsets", *_SIDES):
                least, most, strings = context_strings(*sides_of, span, gram)
                for x in set(offsets).intersection(strings):
                    if least <= x <= most:
                        digest = string_digest(*sides_of[:2], x, length)
                        found_strings.append((gram_hash, x, digest))
            grams, offset, digests = zip(*found_strings) if found_strings else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.int64()), pa.array(offset, pa.int32()), pa.array(digests, pa.int64())],
                names=["gram_hash", "offset", "string_hash"],
            )

    # At most span + 1 offsets a gram.
    offsets = opened.groupBy("gram_hash").agg(F.collect_set("offset").alias("offsets"))
    sizes = both.groupBy("gram_hash").agg(F.count(F.lit(1)).alias("n"))
    asked = materialize(sizes.join(offsets, "gram_hash"), "crowded-offsets")
    known = attach(both, asked, ["gram_hash"], "n").select("gram_hash", "offsets", *_SIDES)
    key = ["gram_hash", "offset", "string_hash"]
    strings = opened.select(*key).unionByName(known.mapInArrow(met, string))
    twice = strings.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    counted = opened.join(twice, key).select(*_ROW, "first", "end")
    return stored.filter(F.col("offset").isNull()).select(*_ROW, "first", "end").unionByName(counted)


def cut_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (list of first, end), text: what is left, as bytes."""
    listed = spans.groupBy(*_ROW).agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    texts = packed_texts(docs, "doc_id")
    rows = texts.join(listed, _same_row(texts, listed), "left").select("doc_id", "packed", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for k in range(0, whole.num_rows, 200):
                batch = whole.slice(k, 200)
                sizes, removed, kept = [], [], []
                for packed, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    text = _unpack(packed)
                    runs: list[dict] = []
                    for first, end in sorted((s["first"], min(s["end"], len(text))) for s in listed or ()):
                        if runs and first <= runs[-1]["end"]:
                            runs[-1]["end"] = max(runs[-1]["end"], end)
                        else:
                            runs.append({"first": first, "end": end})
                    cuts = [0, *[x for r in runs for x in (r["first"], r["end"])], len(text)]
                    sizes.append(len(text))
                    removed.append(runs)
                    kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind),
                     pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "removed", "text"],
                )

    return rows.mapInArrow(
        run,
        f"doc_id {id_type(docs)}, n_bytes long, removed array<struct<first:long,end:long>>, text binary",
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    crowd: int = CROWD,
) -> DataFrame:
    """doc_id, n_bytes, removed, text (the bytes that stay) for every row of ``docs``.

    Texts are UTF-8 bytes, null is empty.  A byte goes if it lies in a string of
    ``length`` bytes that starts at another place too, in the same or another
    document; strings are judged on the input.  Matches never cross documents.
    Rows that repeat are repeats of each other.  A null id is an id like any other.
    An empty table gives an empty result; other columns are ignored.  ``gram``, a
    power of two below ``length``, and ``crowd`` do not change the result.
    """
    if gram & (gram - 1) or not 0 < gram < length:
        raise ValueError("gram must be a power of two below length")
    mine = keyed(documents(docs, id_col, text_col))
    listed = materialize(anchors(mine, length, gram), "anchors")
    again = listed.groupBy("gram_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = materialize(again, "shared-grams")
    shared = materialize(attach(listed, again, ["gram_hash"], "n").drop("n"), "shared-anchors")
    by_context = materialize(
        shared.groupBy("gram_hash", "context_hash").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(*_ROW, "pos")).alias("place")
        ),
        "shared-contexts",
    )
    twice = by_context.filter("n > 1").select("gram_hash", "context_hash", "n")
    whole = attach(shared, twice, ["gram_hash", "context_hash"], "n").select(
        *_ROW,
        F.greatest(F.col("pos") - (length - gram), F.lit(0)).alias("first"),
        (F.col("pos") + length).alias("end"),
    )
    several = (
        by_context.groupBy("gram_hash").agg(F.count(F.lit(1)).alias("contexts"))
        .filter("contexts > 1")
        .select("gram_hash", (F.col("contexts") > crowd).alias("crowded"))
    )
    wanted = by_context.join(several, "gram_hash").select("gram_hash", "crowded", "place.*")
    found = materialize(contexts(mine, wanted, length, gram), "contexts")
    spans = indexed_spans(found.filter(~F.col("crowded")), length).unionByName(whole)
    crowded = found.filter("crowded")
    if not crowded.isEmpty():
        spans = spans.unionByName(crowded_spans(crowded, length, gram))
    return cut_spans(mine, materialize(spans, "spans"))
