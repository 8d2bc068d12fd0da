"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local executor threads (default: all)
BENCH_RUNS    timed runs per query after one warm-up (default 3; the median counts); the training
              searches run once

A run builds the query and writes every row and column to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "ride_filter", "time_features", "daily_timeline", "daily_timeline_demand", "two_ended_counts",
    "label_joinback", "label_histograms", "zone_historical_volumes", "date_split", "stratified_split",
    "factor_counts", "disparity_deciles", "aux_weight_join", "disparity_star_join", "zone_factor_pivot",
    "point_zone_join", "point_in_polygon", "ride_zones_exact", "shape_cells",
    "zone_outcome_volumes", "tuned_threshold", "roc_auc", "pr_curve", "classification_report",
    "threshold_sweep", "fairness_sweep", "intersectional_rates", "fair_fit", "fair_adapt",
    "apply_random_mapping", "vector_udf_score", "train_pipeline", "grid_search", "train_and_record",
    "debiased_outcomes", "score_reattach", "reused_focus", "learned_mapping", "stored_predictions",
)
#: Whole training searches: timed once, without a warm-up.
ONCE = ("grid_search", "train_and_record", "debiased_outcomes", "stored_predictions")


def main() -> None:
    from fairflow.plans import QUERIES
    from fairflow.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        if name not in ONCE:
            once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(1 if name in ONCE else runs)), 3)
        print(f"{name:26s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
