"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

NAMES = ["retime_segments", "source_overlaps", "gap_fill_pieces", "chapter_windows", "asof_hold", "interval_overlap_join", "point_in_interval", "hover_islands", "greedy_change_select", "cue_timing", "normalize_keys", "box_iou_pairs", "median_and_variation"]


def main() -> None:
    from tidemark.queries import QUERIES

    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in NAMES:
        runs = []
        for _ in range(3):  # warm; the median counts
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "sum of medians of 3 runs", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
