"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is run to completion (``count`` of its result via a full write to
the no-op sink, so every row is produced) after one warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.plans.catalog import QUERIES  # noqa: E402
from marketlake.session import build_session  # noqa: E402

HEADLINE = [
    "build_fact", "salary_stats", "salary_daily", "salary_cube_cs", "salary_cube_cssy",
    "hot_indicators", "latency_summary", "silver_union", "dq_silver_salary", "skill_popularity",
    "star_fact", "upsert_fact",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), driver_memory="16g")
    names = [q for q in HEADLINE if q in QUERIES]
    # warm-up (JVM, codegen caches)
    QUERIES["salary_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for q in names:
        t0 = time.perf_counter()
        QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[q] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
