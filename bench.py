"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and runs on
``local[BENCH_CPUS]``.  Every query is executed in full into a no-op sink; the
time includes the fits a query makes.  The best of ``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohort.checks.queries import QUERIES  # noqa: E402
from cohort.plans.session import tune  # noqa: E402

HEADLINE = (
    "basic_cleanup", "dedup_count", "ensure_id", "csv_source", "schema_profile",
    "income_summary", "income_band", "income_decile", "risk_burden", "mode_safe",
    "impute_social_support", "impute_therapy", "build_features", "split_train",
    "preprocess_matrix", "one_hot", "confusion_matrix", "roc_auc", "log_loss",
    "rf_predict",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohort-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", "file:" + tempfile.mkdtemp(prefix="cohort-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    spark.range(1_000_000).selectExpr("sum(id)").collect()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            seconds[name] = min(took, seconds.get(name, took))
        print(f"{name}: {seconds[name]:.2f}s", file=sys.stderr)

    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
