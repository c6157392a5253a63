"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times (default 1); the median counts. Results
go to Spark's no-op sink, so every row and column is computed. BENCH_QUERIES (comma separated)
picks other registered queries, "all" runs every one.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratalake.session import build_session  # noqa: E402
from stratalake.star.queries import registered  # noqa: E402

HEADLINE = [
    "monthly_appointments", "doctor_performance", "department_summary", "billing_recovery", "patient_analysis",
    "patient_analysis_exact", "dedup_lineitem", "clean_patients", "clean_appointments", "clean_bills", "reject_rows",
    "surrogate_keys", "scd1_treatments", "scd2_patients", "scd2_event_history", "point_in_time_lookup",
    "fact_appointments_upsert", "fact_billing_upsert", "fact_load_misses", "foreign_key_orphans",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    queries = registered()
    wanted = os.environ.get("BENCH_QUERIES")
    names = list(queries) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR"})

    def seconds(name: str) -> float:
        clock = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - clock

    timings = {}
    for name in names:
        seconds(name)
        timings[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(scale)}))


if __name__ == "__main__":
    main()
