"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and print one JSON line."""

import json
import os
import statistics
import time

from rateflow.session import local_session
from suite import queries

HEADLINE = [
    "kpi_by_month", "kpi_overall", "kpi_slice", "top_airports", "cause_breakdown", "rollup_summary", "rollup_carrier",
    "seasonal_index", "seasonal_compare", "dq_violations", "dq_findings", "canonical_airport", "canonicalize",
    "validation_report", "templates_stratified", "scenario", "ingest_strict", "ingest_lenient", "minute_stats",
    "latest_per_key", "live_buffer", "sink_partitioned", "stream_ingest", "stream_sliding_rate",
]
#: A query is timed three times, its median counts; one that has taken so many seconds is not timed again.
LONG = 6


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a fresh JVM pays for class loading; that is not what is measured.
    queries.kpi_by_month(spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        took = []
        while len(took) < 3 and sum(took) < LONG:
            started = time.perf_counter()
            queries.ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(took), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
