"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed end to end with the ``noop`` sink (the full plan runs,
nothing is shipped to the driver); one discarded warm-up, then the median of
$BENCH_RUNS runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quantlake.plans.registry import QUERIES  # noqa: E402
from quantlake.session import build_session  # noqa: E402

HEADLINE = (
    "universe_filter",
    "normalize_wide",
    "clean_dedup",
    "all_indicators",
    "indicators_split",
    "v_daily_summary",
    "v_weekly_rollup",
    "v_top_movers",
    "symbol_kpis",
    "market_kpis",
    "rsi_counts",
    "clean_all",
    "tick_decode",
    "v_latest_ticks",
    "latest_ticks_by_hour",
    "live_table_totals",
    "stream_tick_sink",
    "lake_roundtrip",
    "catalog_repair",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(HEADLINE)
    spark = build_session(
        master=f"local[{cpus}]",
        app="quantlake-bench",
        shuffle_partitions=int(cpus),
        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    timings: dict[str, float] = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up, discarded
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
