"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully computed through the ``noop`` sink (no collect to the
driver).  Prints one JSON line: total seconds plus per-query seconds.
Headline queries by default (the pipelines, the rule fold and its audits,
routing and delivery); BENCH_QUERIES=all runs every registered query, or
give a comma list.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quorum.queries import QUERIES, STEPS  # noqa: E402
from quorum.session import build_session  # noqa: E402


HEADLINE = [
    "pl1_scored_pipeline", "pl2_negative_pipeline", "ru1_classify", "an1_unit_result",
    "ru4_class_rule_audit", "ru8_incremental_overwrite_audit", "ru9_operator", "ru14_operator_v2",
    "pl3_route_class_counts", "io14_delivery_datasets", "ag8_unit_inspection", "dq3_score_violations",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sel = os.environ.get("BENCH_QUERIES", "")
    only = HEADLINE if not sel else ([] if sel == "all" else [x for x in sel.split(",") if x])
    spark = build_session(master=f"local[{cpus}]", app="quorum-bench",
                          shuffle_partitions=int(cpus) * 2)
    names = [n for n in QUERIES if not only or n in only]
    # warm-up: JVM, codegen caches and file listing, not timed
    QUERIES["sc12_row_score"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    # The tables that several queries read are written first, on lines of their own.
    for name, write in STEPS.items():
        t0 = time.time()
        write(spark, sf_dir)
        times[f"step_{name}"] = round(time.time() - t0, 3)
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
