"""Helpers that several operators use."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.plans.workspace import dropping, materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The six ASCII white space characters, U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: A group is hot when it holds more than this share of all rows.
HOT_SHARE = 1_000
#: Bits of a filter per hash, and at most (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Bytes of a list of rows that may be broadcast, and of one such row.
BROADCAST_BYTES, LISTED_BYTES = 32 << 20, 64
#: Values of a column that are Python objects at one time.
FEW = 256

__all__ = ["ascii_lower", "attach", "documents", "dropping", "materialize", "process_memo"]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is.

    ``lower`` does the same, and faster, where a text has ASCII only.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def documents(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns an operator needs, under names of its own; null text is empty."""
    return df.select(
        quoted(id_col).alias("doc_id"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
        *[quoted(c).alias(c) for c in more],
    )


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join of ``rows`` with one row per group, safe for hot groups.

    Both are stored tables.  ``size`` is the number of rows of a group, so at
    most ``HOT_SHARE`` groups exceed a ``HOT_SHARE``-th of all rows: these few
    fixed-width rows are broadcast, all other groups are joined by a shuffle.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    limit = total // HOT_SHARE
    hot = F.broadcast(groups.filter(F.col(size) > limit))
    cold = groups.filter(F.col(size) <= limit)
    few = F.broadcast(groups.filter(F.col(size) > limit).select(*keys))
    return rows.join(hot, keys).unionByName(
        rows.join(few, keys, "left_anti").join(cold, keys)
    )


def told_apart(*own: Column) -> list[Column]:
    """Two 64-bit hashes, me and me2, that tell a row from all but those with the same values."""
    return [F.xxhash64(F.lit(k), *own).alias(name) for k, name in enumerate(("me", "me2"))]


def few_rows(listed: DataFrame) -> DataFrame:
    """A stored table of short rows, to be broadcast if its size allows it."""
    return F.broadcast(listed) if listed.count() * LISTED_BYTES <= BROADCAST_BYTES else listed


def drop_rows(marked: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows ``own`` of ``marked`` whose me, me2 are not in the stored table ``gone``;
    of those that it lists with ``stays``, one row each.

    Only what goes is joined with whole rows, by broadcast if its size allows it.
    """
    few = gone.count() * LISTED_BYTES <= BROADCAST_BYTES
    listed = F.broadcast(gone) if few else gone
    kept = marked.join(listed, ["me", "me2"], "left_anti").select("own.*")
    if gone.filter("stays").isEmpty():
        return kept
    again = F.broadcast(gone.filter("stays")) if few else gone.filter("stays")
    return kept.unionByName(
        marked.join(again, ["me", "me2"], "left_semi").dropDuplicates(["me", "me2"]).select("own.*")
    )


def process_memo(name: str, make):
    """A value that one Python worker process keeps between its tasks."""
    kept = sys.modules.setdefault("cohort_llm_memo", types.ModuleType("cohort_llm_memo"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def forget_memos() -> None:
    """Free what earlier operators have kept in this worker process."""
    sys.modules.pop("cohort_llm_memo", None)


def in_turn(column: pa.Array) -> Iterator:
    """The values of a column, a few at a time made Python objects."""
    for start in range(0, len(column), FEW):
        yield from column.slice(start, FEW).to_pylist()


def lean(step):
    """A step for ``mapInArrow`` after which its worker gives back the memory that batches took.

    Workers outlive their tasks; Arrow's pool and the C library keep what was freed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
            if trim is not None:
                trim(0)

    return run


def id_type(df: DataFrame, name: str = "doc_id") -> str:
    """The SQL name of a column's type, for the schema of a Python step."""
    return df.schema[name].dataType.simpleString()


def slices(sizes, limit: int):
    """Consecutive ranges (start, end) of items whose sizes add up to about ``limit``."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def in_fold(id_col: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id, written as text, leaves ``part`` modulo ``parts``."""
    return F.coalesce(
        F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False)
    )


def spread(x: np.ndarray) -> np.ndarray:
    """Hashes mixed once more."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class HashFilter:
    """A Bloom filter with two bits for each hash, of which the first ``bits`` count."""

    def __init__(self, words: np.ndarray, bits: int) -> None:
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)
        self.drop = np.uint64(64 - bits)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whether each unsigned hash may be among those of the filter."""
        x = spread((x >> self.drop) << self.drop)
        return self._bit(x & self.mask) & self._bit((x >> np.uint64(32)) & self.mask)

    def _bit(self, at: np.ndarray) -> np.ndarray:
        word = self.words[(at >> np.uint64(6)).astype(np.int64)]
        return (word >> (at & np.uint64(63))) & np.uint64(1) == 1


def hash_filter(hashes: DataFrame, bits: int) -> HashFilter:
    """A filter of bounded size of a stored table ``hash``: the first ``bits`` of hashes."""
    n = hashes.agg(F.approx_count_distinct("hash").alias("n")).first()["n"]
    size = 1 << min(MOST_BITS.bit_length() - 1, max(16, int(n * BITS_EACH).bit_length()))

    def places(batches):
        for batch in batches:
            x = spread(batch.column(0).to_numpy().view(np.uint64) << np.uint64(64 - bits))
            at = np.concatenate([x, x >> np.uint64(32)]) & np.uint64(size - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64))], names=["at"])

    found = (
        hashes.mapInArrow(places, "at long")
        .select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    words = np.zeros(size // 64, dtype=np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return HashFilter(words.view(np.uint64), bits)
