"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: a warm run and then the median of three, one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

HERE = str(Path(__file__).resolve().parent)
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = f"{HERE}:{os.environ.get('PYTHONPATH', '')}"

from pyspark.sql import SparkSession  # noqa: E402

from landstat.plans import registry  # noqa: E402

HEADLINE = (
    "D1_merge_labels", "F1_keep_first", "E22_consensus", "D12_label_transitions", "E18_reference_agreement", "D17_confusion", "E8_area_estimate", "E19_estimate_area",
    "E21_intercompare", "D36_ensemble_vote", "D20_roc_auc", "D21_best_f1_threshold", "C6_join_regions", "C7_within_distance", "D26_band_stats",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, times = registry.load()[0], {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            t = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        times[name] = round(median(runs[1:]), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
