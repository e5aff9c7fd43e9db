"""Lines that many documents share, found by range-partitioned line hashes.

Line hashes are dealt by range and sorted by (hash, slice, document descending,
position).  ``slice`` is a hash of the document: a line that a third of all
documents have is spread over many ranges.  Streaming over the sorted rows marks
the first occurrence of a line in each document; heads of the slices are then
combined into one row per line with its number of documents and the document
that keeps it.  What is returned per document is not text but the run-length
compressed bitmap of its dropped lines, which ``apply_bitmaps`` can replay.

Only DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort.llm.shared import SPACES, ascii_lower, documents, materialize

MIN_CHARS = 20
MIN_DOCS = 3
SLICES = 256
RUNS = "array<struct<first:int,length:int>>"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per line whose key is long enough: two hashes of the key, document,
    position, and a hash of the whole text that tells rows of one id apart."""
    keys = F.transform(
        _lines(ascii_lower(F.col("text"))), lambda line: F.btrim(line, F.lit(SPACES))
    )
    return (
        docs.filter(F.col("doc_id").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(keys).alias("pos", "key"))
        .filter(F.char_length("key") >= min_chars)
        .select(
            "doc_id",
            "version",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("line"), "key").alias("h2"),
        )
    )


def shared_lines(hashes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per line found in ``min_docs`` documents: n_docs and the holder."""
    dealt = hashes.select(
        "h1", "h2", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).alias("slice"), "doc_id", "pos"
    ).repartitionByRange("h1", "h2", "slice")
    stream = Window.partitionBy("h1", "h2", "slice").orderBy(F.desc("doc_id"), "pos")
    first = ~F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))
    return (
        dealt.select("h1", "h2", "doc_id", first.cast("long").alias("first"))
        .groupBy("h1", "h2")
        .agg(F.sum("first").alias("n_docs"), F.max("doc_id").alias("holder"))
        .filter(F.col("n_docs") >= min_docs)
    )


def drop_bitmaps(hashes: DataFrame, shared: DataFrame) -> DataFrame:
    """Per document the dropped lines as runs (first, length), ascending."""
    dropped = (
        hashes.join(shared, ["h1", "h2"])
        .filter(F.col("doc_id") != F.col("holder"))
        .select("doc_id", "version", "pos")
    )
    row = ["doc_id", "version"]
    in_order = Window.partitionBy(*row).orderBy("pos")
    return (
        # Rows that repeat a document repeat its positions.
        dropped.groupBy(*row, "pos").agg(F.count(F.lit(1)).alias("times"))
        .withColumn("island", F.col("pos") - F.row_number().over(in_order))
        .groupBy(*row, "island")
        .agg(F.min("pos").alias("first"), F.count(F.lit(1)).cast("int").alias("length"))
        .groupBy(*row)
        .agg(F.sort_array(F.collect_list(F.struct("first", "length"))).alias("runs"))
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, runs, n_lines, n_dropped and the kept text of every document."""
    marked = docs.withColumn("version", F.xxhash64("text")).join(
        bitmaps, ["doc_id", "version"], "left"
    )
    runs = F.coalesce("runs", F.array().cast(RUNS))

    def flags(run: Column, i: Column) -> Column:
        before = F.get("runs", i - 1)
        gap = run["first"] - F.coalesce(before["first"] + before["length"], F.lit(0))
        return F.concat(
            F.array_repeat(F.lit(False), gap), F.array_repeat(F.lit(True), run["length"])
        )

    pairs = F.arrays_zip(
        _lines(F.col("text")).alias("line"),
        F.coalesce(F.flatten(F.transform("runs", flags)), F.array(F.lit(False))).alias("drop"),
    )
    # Lines after the last run have no flag.
    kept = F.filter(pairs, lambda z: z["line"].isNotNull() & ~F.coalesce(z["drop"], F.lit(False)))
    n_dropped = F.aggregate(runs, F.lit(0).cast("long"), lambda n, run: n + run["length"])
    return marked.select(
        "doc_id",
        runs.alias("runs"),
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        n_dropped.alias("n_dropped"),
        F.array_join(F.transform(kept, lambda z: z["line"]), "\n").alias("text"),
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """doc_id, runs, n_lines, n_dropped and kept text for every row of ``docs``.

    A line's key is the line without white space at its ends and with A-Z in
    lower case.  Keys of at least ``min_chars`` code points found in at least
    ``min_docs`` documents lose all their lines except in the largest id that
    holds them, where all stay.  Null text is one empty line.  Rows without an
    id stay whole and count for nothing.  Rows that repeat an id and its text
    are one document, each row is returned; rows that share an id but not their
    text count as one document too and lose their own lines.  An empty table
    gives an empty result; other columns are ignored.
    """
    mine = documents(docs, id_col, text_col)
    hashes = materialize(line_hashes(mine, min_chars), "line-hashes")
    shared = materialize(shared_lines(hashes, min_docs), "shared-lines")
    return apply_bitmaps(mine, drop_bitmaps(hashes, shared))
