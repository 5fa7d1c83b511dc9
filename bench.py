"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1), local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "cold": {name: seconds}, "sf"}.  Each query is
fully executed with a no-op sink (every row and column is produced; nothing is
collected to the driver), twice: "cold" is the first run (includes code
generation and JIT warm-up of that plan), "queries" the second, warm run.
Planning (building and analysing the DataFrame) is included in both.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "item_mart", "adherence_mart", "denormalized_items", "attribute_pivot", "engaged_company",
    "current_items", "version_rank", "sync_upsert", "classify_changes", "cell_diff",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from quillmart.plans.registry import QUERIES
    from quillmart.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    QUERIES["latest_version"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold, times = {}, {}
    for name in HEADLINE:
        for bucket in (cold, times):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            bucket[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "cold": cold,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
