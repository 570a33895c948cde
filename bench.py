"""Time the headline queries and print one JSON line.

All queries run once to warm up; then each runs ``BENCH_RUNS`` times and its
median counts. Results are produced in full, into the ``noop`` writer.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from conformance import QUERIES  # noqa: E402
from conformance.streams import batch_rates  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = [
    "enrich_avg_stats",
    "enrich_avg_stats_shuffled",
    "enrich_lineitem_stats",
    "grouped_stats_batch",
    "grouped_stats_stream",
    "numeric_castable_filter",
    "avg_text_measure",
    "normalize_text_distinct",
    "normalize_all_documents",
    "json_decode_project",
    "json_encode_rows",
    "reject_split",
    "csv_landing_documents",
    "copy_tables",
    "medallion_gold",
    "stream_json_stats",
]


def seconds(spark, query):
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        seconds(spark, QUERIES[name])
    times = {name: [seconds(spark, QUERIES[name]) for _ in range(RUNS)] for name in names}
    batches = [batch_rates(spark, SF_DIR) for _ in range(2)][-1]
    spark.stop()

    median = {name: round(statistics.median(each), 4) for name, each in times.items()}
    result = {
        "metric": "sum of the queries' median times",
        "value": round(sum(median.values()), 4),
        "unit": "sec",
        "queries": median,
        "maxima": {name: round(max(each), 4) for name, each in times.items()},
        "stream": batches,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
