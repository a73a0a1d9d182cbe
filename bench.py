"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder with the test tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import pathlib
import re
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from arrears_mart.registry.queries import QUERIES  # noqa: E402

HEADLINE = (
    "m1_master_campaign",
    "m1_audit",
    "m2_master_days",
    "w1_latest_per_key",
    "w2_latest_contact",
    "w3_discarded",
    "j6_balance_by_camp2",
    "j8_new_accounts",
    "g5_by_collector",
    "g10_by_age_days",
    "g12_metrics",
    "f22_address",
)
ROUNDS = 2


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_STAGES") or tempfile.mkdtemp(prefix="bench-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    best: dict[str, float] = {}
    for _ in range(ROUNDS):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            best[name] = min(taken, best.get(name, taken))
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": {n: round(t, 3) for n, t in best.items()},
                "sf": float(scale.group(1).rstrip(".")) if scale else None,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
