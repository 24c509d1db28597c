"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_RUNS (default 3; the median is reported per query), BENCH_EVENT_LOG
(optional folder: Spark's event log is written there, for stage and task
times without any web UI).

Each query is run to completion with the ``noop`` sink, so every row is
computed but nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeledger.registry import QUERIES, drop_lakes  # noqa: E402
from lakeledger.session import get_spark  # noqa: E402

HEADLINE = [
    "gold_product",
    "gold_freight",
    "gold_taxes",
    "report_products_all",
    "upsert",
    "backfill_range",
    "upsert_stored",
    "ingest_devolucao",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - t0
    drop_lakes(spark)  # stored-table queries leave a lake each
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    event_log = os.environ.get("BENCH_EVENT_LOG")
    extra = ({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log,
              "spark.eventLog.compress": "false"} if event_log else None)
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app_name="lakeledger-bench",
                      extra_conf=extra)
    # Warm the JVM (class loading, codegen caches) on the smallest query.
    run_once(spark, "gold_taxes", sf_dir)
    per_query = {}
    for name in names:
        times = [run_once(spark, name, sf_dir) for _ in range(runs)]
        per_query[name] = round(statistics.median(times), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
