"""Stage boundaries: tables written to the folder the cluster shares.

A result that several later jobs depend on (group statistics, numbered rows)
is written once as Parquet and read back.  That cuts the lineage, survives the
loss of any executor, and lets Catalyst see the real size of the table.
``dropping`` deletes such tables again once nothing reads them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Rows that one task trains or scores a forest on, about.
SPREAD_ROWS = 100_000

_local_folder: str | None = None
#: Paths of the tables that each open ``dropping`` deletes, the innermost last.
_stored: ContextVar[tuple[list[str], ...]] = ContextVar("stored", default=())


class NoSharedFolder(RuntimeError):
    """The session names no folder that all executors reach."""


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; a temporary one only in local mode."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise NoSharedFolder(
            f"set {CHECKPOINT_CONF} to a folder that every executor can reach"
        )
    global _local_folder
    if _local_folder is None:
        _local_folder = "file:" + tempfile.mkdtemp(prefix="cohort-")
    return _local_folder


@contextmanager
def dropping(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored within are deleted at the end, also after an error.

    What is read later must be stored with ``outlives``; it then belongs to the
    next ``dropping`` around this one, if any.
    """
    mine: list[str] = []
    before = _stored.set((*_stored.get(), mine))
    try:
        yield
    finally:
        _stored.reset(before)
        for path in mine:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cohort-{label}-{uuid.uuid4().hex}"
    scopes = _stored.get()[:-1] if outlives else _stored.get()
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, each: int = SPREAD_ROWS) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt evenly: a task for each core, more if ``each`` asks for it.

    For work that is heavy per byte: Spark cuts files by bytes, and a file of one row
    group is read by one task whatever is done with its rows.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))
