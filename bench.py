"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed in
full with the ``noop`` sink (no collect to the driver).  Each query runs
``$BENCH_REPEATS`` times (default 1) and the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "page_assembly", "clean_text", "metadata_title", "metadata_date", "metadata_journal",
    "alias_extract", "entity_match", "entity_counts", "relations", "relation_counts",
    "upsert_last_wins", "concept_relationships", "parent_edges", "missing_parents",
    "article_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pagewright.plans.registry import QUERIES
    from pagewright.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="pagewright-bench")
    timings: dict[str, float] = {}
    for name in (only or HEADLINE):
        if name not in QUERIES:
            continue
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
