"""Write PLANS.md: the physical-plan shape of every registered query.

    python tools/plan_report.py [sf_dir]

For each query: hash / single / range exchanges, broadcast and sort-merge
joins, hash- and sort-based aggregates, window nodes, and a check that no
Python evaluation or Cartesian product appears. Full plans of a few headline
queries follow. Writer queries run jobs while building their DataFrame, so for them
the plans of what those jobs write are listed (``written_frames``).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTS = (
    ("hash exch", "Exchange hashpartitioning"),
    ("single exch", "Exchange SinglePartition"),
    ("range exch", "rangepartitioning"),
    ("bcast join", "BroadcastHashJoin"),
    ("smj", "SortMergeJoin"),
    ("hash agg", "HashAggregate("),
    ("sort agg", "SortAggregate("),
    ("window", "Window ["),
)
BAD = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
FULL = ("all_indicators", "v_weekly_rollup", "v_top_movers", "v_latest_ticks", "rsi_counts", "indicators_split", "job: staging -> curated")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


WRITERS = ("raw_partition_scan", "registered_views", "table_statistics", "stream_tick_sink", "lake_roundtrip", "catalog_repair",
           "lake_incremental", "latest_day_bars", "partition_statistics", "stream_latest_ticks", "stream_live_kpis", "stream_dedup_sink")


def written_frames(spark, sf_dir):
    """Name -> DataFrame that the batch and stream jobs write."""
    from quantlake.operators.cleaning import clean, ingested_at_as_text
    from quantlake.operators.indicators import add_all_indicators
    from quantlake.paths import LakePaths
    from quantlake.session import scratch_path
    from quantlake.sources import lake
    from quantlake.sources.kafka import encode_ticks
    from quantlake.sources.testdata import dirty_bars, event_ticks
    from quantlake.streaming.ticks import decode_ticks, landed_columns

    root = scratch_path(spark, "plans")
    paths = LakePaths(root)
    lake.write_raw_runs(dirty_bars(spark, sf_dir), paths)
    for run in lake.landed_runs(spark, paths):
        lake.write_staging(clean(lake.read_raw(spark, paths, run), "2024-02-02 00:00:00"), paths, run)
    encode_ticks(event_ticks(spark, sf_dir)).select("value").write.text(f"{root}/records")
    return {
        "job: raw run -> staging": clean(lake.read_raw(spark, paths, run), "2024-02-02 00:00:00"),
        "job: staging -> curated": ingested_at_as_text(add_all_indicators(lake.history_by_symbol(lake.read_staging(spark, paths)))),
        "job: tick records -> landed ticks": landed_columns(decode_ticks(spark.read.text(f"{root}/records"))),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from quantlake.plans.registry import QUERIES
    from quantlake.session import build_session

    spark = build_session(master="local[8]", conf={"spark.ui.showConsoleProgress": "false"})
    rows, full = [], {}
    frames = {n: fn(spark, sf_dir) for n, fn in QUERIES.items() if n not in WRITERS} | written_frames(spark, sf_dir)
    for name, df in frames.items():
        p = plan_text(df)
        counts = [str(p.count(pat)) for _, pat in COUNTS]
        clean = "yes" if not any(b in p for b in BAD) else "NO"
        rows.append(f"| {name} | " + " | ".join(counts) + f" | {clean} |")
        if name in FULL:
            full[name] = "\n".join(line[:170] for line in p.splitlines())
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], AQE on; plans before AQE re-planning).",
        "Counts are plan nodes (a scalar subquery's plan is printed, and counted, where it is used).",
        "",
        "| query | " + " | ".join(h for h, _ in COUNTS) + " | no Python / Cartesian |",
        "|---|" + "---|" * (len(COUNTS) + 1),
        *rows,
        "",
    ]
    for name in FULL:
        out += [f"## {name}", "", "```", full[name], "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
