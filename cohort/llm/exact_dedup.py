"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is a run of digests.  In each round the runs of ``fan``
neighbours are merged: run ``r`` hands its digests to run ``r // fan``, split by
digest over the tasks of the round, so the tree has one root but no task ever
holds more than its share of the digests.  A merge keeps, per digest, the
largest (or smallest) id, the number of rows, and the range of a second,
independent check value; two texts under one digest would show as a range and
stop the job.  Digests are combined before each exchange, so a text that a
third of all rows share is one row per run.

Only DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.shared import ascii_lower, attach, documents, drop_rows, dropping, materialize, told_apart

FAN = 8


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest of the normalised text, check values, and the run."""
    text = ascii_lower(F.col("text"))
    return documents(docs, id_col, text_col).select(
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.xxhash64(text).alias("other_hash"),
        F.octet_length(text).alias("n_bytes"),
        F.spark_partition_id().alias("run"),
    )


def merge_runs(runs: DataFrame, rounds: int, keep: str = "largest", fan: int = FAN) -> DataFrame:
    """One row per digest: keep_id, group_size; ``rounds`` levels of the tree."""
    best = F.max if keep == "largest" else F.min
    merged = runs.select(
        "run",
        "digest",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.struct("n_bytes", "other_hash").alias("low"),
        F.struct("n_bytes", "other_hash").alias("high"),
    )
    for _ in range(rounds):
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
            .groupBy("run", "digest")
            .agg(
                best("keep_id").alias("keep_id"),
                F.sum("group_size").alias("group_size"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
            )
        )
    same = F.col("low") == F.col("high")
    verified = F.when(same, F.col("group_size")).otherwise(
        F.raise_error(F.lit("two different texts share a SHA-256 digest")).cast("long")
    )
    return merged.select("digest", "keep_id", verified.alias("group_size"))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fan: int = FAN,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when they are identical after lower-casing A-Z.  Null text
    counts as empty.  A null id is never the one to stay unless the whole group
    has none; then keep_id is null and every row of the group is kept.  Rows
    that repeat an id and its text are rows of one group: they count in
    group_size and share ``kept``.  An empty table gives an empty result; other
    columns are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    runs = materialize(digest_runs(docs, id_col, text_col), "digest-runs")
    last = runs.agg(F.coalesce(F.max("run"), F.lit(0)).alias("run")).first()["run"]
    rounds = 1
    while fan**rounds <= last:
        rounds += 1
    groups = materialize(merge_runs(runs, rounds, keep, fan), "digests")
    found = attach(runs.select("doc_id", "digest"), groups, ["digest"], "group_size")
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest id.

    A row that repeats it goes too; where no row of a group has an id, any one stays.
    The digests say which rows go; only these are joined with the texts.
    """
    with dropping(docs.sparkSession):
        rows = exact_dedup(docs, id_col, text_col).select("kept", *told_apart(F.col("doc_id"), F.col("text_sha256")))
        gone = rows.groupBy("me", "me2").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("copies"))
        gone = materialize(gone.filter("NOT stays OR copies > 1"), "copies-dropped", outlives=True)
    text = ascii_lower(F.coalesce(quoted(text_col).cast("string"), F.lit("")))
    own = F.struct(*[quoted(c) for c in docs.columns]).alias("own")
    return drop_rows(docs.select(own, *told_apart(quoted(id_col), F.sha2(text, 256))), gone)
