"""Time the headline queries, and one pair of whole audit runs, on the given tables.

Prints one JSON line. Every query is run once to warm up and then timed with
all its rows produced and dropped.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from grantledger.session import SETTINGS
from workload.audit_runs import two_runs
from workload.registry import queries

HEADLINE = (
    "inst_gather", "inst_revoked", "inst_delta", "principals_dropped", "inst_live_after_upsert",
    "db_role_members", "obj_gather", "obj_revoked", "obj_live_next", "group_members",
    "lookup_objects", "lookup_role_permissions", "lookup_summary", "last_success",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    wanted = sys.argv[1:] or HEADLINE
    known = queries()
    seconds: dict[str, float] = {}
    for name in wanted:
        for _ in range(2):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    if not sys.argv[1:]:
        for run, taken in two_runs(spark, sf_dir).items():
            seconds[run] = round(taken, 3)
    line = {
        "metric": "headline queries and two audit runs, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir).removeprefix("sf")),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
