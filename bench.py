"""Times the headline queries and prints one JSON line.

Results go to Spark's noop sink, so every row is computed and none is collected.
Each query runs once to warm up and ``BENCH_RUNS`` times (3) for the clock; the
fastest run counts. The raw zone the file queries read is written before the clock starts.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barkeep.session import build_session  # noqa: E402
from workload.inputs import raw_zone  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "bars_normalized",
    "bars_date_range",
    "bars_dedup_latest",
    "bars_csv_roundtrip",
    "bars_csv_pruned",
    "bars_text_load",
    "bars_load_counters",
    "orders_upsert",
    "range_bar_counts",
    "staging_manifest",
    "metrics_52w",
    "metrics_52w_repeated_days",
    "metrics_52w_daily_impacted",
)
# These write tables with a directory per day, so they run once: their time is mostly the
# local file system's time to create some 2,500 directories and files a table.
WRITING = (
    "bars_load",
    "metrics_table",
    "daily_update_metrics",
    "backfill_table",
    "bars_incremental_stream",
)


def seconds(query, spark):
    started = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    spark = build_session(
        "bench",
        extra={
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw_zone(spark, SF_DIR)
    times = {}
    for name in HEADLINE:
        query = QUERIES[name]
        seconds(query, spark)
        times[name] = round(min(seconds(query, spark) for _ in range(RUNS)), 3)
    for name in WRITING:
        times[name] = round(seconds(QUERIES[name], spark), 3)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
