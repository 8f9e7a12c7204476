"""Runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
HEADLINE = ("cdc_fold", "cdc_fold_base", "gate_events", "route_events_st", "event_batches", "clone_missing", "compare_summary", "compare_fields", "compare_arrays", "throughput_256", "id_diff", "dispatch_runs")


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from sluice.queries import QUERIES

    took = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):  # the second run has code compiled
            start = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            best = min(best or 1e9, time.time() - start)
        took[name] = round(best, 3)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
