"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

One warm-up, then the median of $BENCH_RUNS runs (3 unless set).  A run builds the
query, executes it and takes every column of every row (``noop`` sink).  Prints
one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contrail import spark_session
from contrail.queries import QUERIES

HEADLINE = (
    "fact_states", "silver_states", "dup_ratio", "dedupe_latest", "flight_key", "enrich_airline",
    "enrich_salted", "silver_flights", "fact_flights", "merge_upsert", "manifest_merge",
    "dataset_tree_hash", "export_roundtrip", "kpi_cards", "top_routes", "turnaround",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = spark_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
