"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then measured, its result written to Spark's noop sink, so all rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from rangelake.plans import catalogue

HEADLINE = ("range_assign", "range_counts", "gap_backfill", "nest_explode", "explode_lineage", "explode_scalar_list", "explode_map", "main_table_list_sizes", "raw_envelope", "decode_payloads", "undo_apply", "stats_rollup", "file_write_read")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rangelake-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            began = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
