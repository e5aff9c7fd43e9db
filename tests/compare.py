"""Run queries in Spark and their SQL in DuckDB and compare whole results.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    out = frame.map(lambda v: None if v is None or v != v else (float(v) if isinstance(v, (int, float)) else v))
    return out.sort_values(by=list(out.columns), key=lambda s: s.map(repr)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else a description."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    a, b = _plain(spark_frame), _plain(sql_frame)
    unequal = ~((a == b) | (a.isna() & b.isna())).all(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ:\n{a[unequal].head(3)}\n{b[unequal].head(3)}"
    return None


def kinds(spark_df, sql_relation) -> str | None:
    """Types that disagree beyond their spelling."""
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    ours = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    theirs = dict(zip(sql_relation.columns, map(str, sql_relation.types)))
    off = {c: (ours[c], theirs.get(c)) for c in ours if ours[c] != theirs.get(c)}
    return str(off) if off else None


def main() -> None:
    from conftest import make_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark, con = make_session(), connect(folder)
    bad = 0
    for name in chosen:
        started = time.time()
        df = entry.queries()[name](spark, folder)
        ours = df.toPandas()
        took = time.time() - started
        sql = entry.oracle_sql().get(name)
        if sql is None:
            verdict = f"rows only: {len(ours)}"
        else:
            relation = con.sql(sql)
            verdict = difference(ours, relation.df()) or "same"
            off = kinds(df, relation)
            if off:
                verdict += f" TYPES {off}"
            bad += verdict != "same"
        print(f"{name:28s} {took:6.2f}s {len(ours):7d} {verdict}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
