"""Headline timings: prints one JSON line.

The derived tables are written once (timed as `store_tables`), then every query runs to
completion without collecting rows: the warm-up run is untimed, the second run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.catalog import QUERIES  # noqa: E402
from barloom.catalog.tables import stored  # noqa: E402
from barloom.session import build_session  # noqa: E402

HEADLINE = (
    "bars_from_ticks", "scored_fundamentals", "serving_features", "research_features", "trend_features",
    "momentum_features", "volume_features", "relative_features_serving", "exponential_means_with_holes",
    "long_series_rolling", "long_series_running_state", "replay_predictions", "main_frame", "quadrant_summary",
    "compare_best_four", "skew_table",
)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    start = time.time()
    for name in ("bars", "market", "scored", "screening"):
        stored(spark, sf_dir, name)
    times["store_tables"] = round(time.time() - start, 3)
    for name in HEADLINE:
        run(QUERIES[name](spark, sf_dir))
        start = time.time()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
