"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Re-planning at run time: joins by real size, merged and split partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not compile methods over 8000 bytes of bytecode.  A feature
    # table is wide enough to reach that in one generated stage, which would
    # then be interpreted row by row; Spark splits the work instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark
