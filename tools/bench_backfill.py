"""Back-fill of every gold date in one job against one refresh per date.

Usage: python tools/bench_backfill.py [sf_dir]   (default /root/testdata/sf0.1)

Builds the three silver inputs of the product summary once, then times
(a) ``backfill`` over all dates and (b) ``refresh`` called once per date on a
gold table that already exists, and checks that both give the same rows.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeledger.plans import gold as gold_jobs  # noqa: E402
from lakeledger.registry import new_lake  # noqa: E402
from lakeledger.schemas import GOLDS, SOURCES  # noqa: E402
from lakeledger.session import get_spark  # noqa: E402
from lakeledger.sources import tables  # noqa: E402
from lakeledger.sources import testdata as TD  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 8, app_name="lakeledger-backfill-bench")
    lake = new_lake(spark, "bench_backfill")
    spec = GOLDS["produtos"]
    for name in spec.inputs:
        src = SOURCES[name]
        tables.create_table(spark, lake.silver(src), TD.BUILDERS[name](spark, sf_dir), src.date_column)
    days = sorted(d for d in tables.list_partitions(spark, lake.silver(SOURCES["vendas"]), "data_venda")
                  if d is not None)
    lo, hi = days[0], days[-1]

    gold_jobs.backfill(spark, lake, spec, lo, hi)  # creates the gold table (warm-up)
    t0 = time.perf_counter()
    gold_jobs.backfill(spark, lake, spec, lo, hi)
    one_job = time.perf_counter() - t0
    once = sorted(tuple(r) for r in tables.scan_table(spark, lake.gold(spec)).collect())

    t0 = time.perf_counter()
    for d in days:
        gold_jobs.refresh(spark, lake, spec, d)
    per_day = time.perf_counter() - t0
    daily = sorted(tuple(r) for r in tables.scan_table(spark, lake.gold(spec)).collect())
    spark.stop()
    print(json.dumps({"dates": len(days), "backfill_one_job_sec": round(one_job, 2),
                      "refresh_per_date_sec": round(per_day, 2),
                      "speedup": round(per_day / one_job, 1), "same_rows": once == daily,
                      "rows": len(once)}))


if __name__ == "__main__":
    main()
