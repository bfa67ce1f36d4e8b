"""Job entry points.

    python -m quantlake ingest --root ROOT --wide PATH [--universe FILE] [--run-date YYYY-MM-DD]
    python -m quantlake batch  --root ROOT [--run-date YYYY-MM-DD] [--dynamic-curated | --incremental] [--database DB] [--allow-empty] [--split-rows N]
    python -m quantlake refresh --root ROOT --database DB [--ticks]
    python -m quantlake stream --root ROOT (--kafka BROKERS [--prefix P] | --files DIR)
                               [--trigger "30 seconds"] [--available-now] [--files-per-folder K] [--rejects]
                               [--dedup-within "1 hour"] [--latest]

``ingest`` reshapes a wide vendor history (Parquet) of the tracked universe and lands it as one run;
``refresh`` registers new partitions and replaces the views. ``batch`` runs one daily batch (raw run partition -> staging -> curated) for a
run date (default: today, as the source job); with ``--incremental`` only the bars that the run changes are computed. ``stream`` decodes tick records
from Kafka (connector JAR on the classpath) or from a folder of JSON lines and
lands them in ``ROOT/raw/ticks`` with a checkpoint under ``ROOT/checkpoints``; ``--latest`` also keeps each symbol's
newest tick in ``ROOT/state/latest_ticks``.
The master and cluster settings come from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from quantlake.paths import LakePaths
from quantlake.plans.batch import refresh_catalog, run_batch, run_ingest
from quantlake.plans.incremental import run_incremental
from quantlake.session import DEFAULT_CONF, ensure_checkpoint_dir
from quantlake.sources.kafka import DEFAULT_PREFIX, read_tick_stream
from quantlake.sources.universe import read_universe
from quantlake.streaming.latest import start_latest_ticks
from quantlake.streaming.ticks import decode_ticks, start_reject_sink, start_tick_sink


def _session(app: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quantlake")
    sub = ap.add_subparsers(dest="job", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--root", required=True)
    b.add_argument("--run-date", default=None)
    how = b.add_mutually_exclusive_group()
    how.add_argument("--dynamic-curated", action="store_true")
    how.add_argument("--incremental", action="store_true")
    b.add_argument("--database", default=None)
    b.add_argument("--allow-empty", action="store_true")
    b.add_argument("--split-rows", type=int, default=None)
    i = sub.add_parser("ingest")
    i.add_argument("--root", required=True)
    i.add_argument("--wide", required=True)
    i.add_argument("--universe", default=None)
    i.add_argument("--run-date", default=None)
    r = sub.add_parser("refresh")
    r.add_argument("--root", required=True)
    r.add_argument("--database", required=True)
    r.add_argument("--ticks", action="store_true")
    s = sub.add_parser("stream")
    s.add_argument("--root", required=True)
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka")
    src.add_argument("--files")
    s.add_argument("--prefix", default=DEFAULT_PREFIX)
    s.add_argument("--trigger", default="30 seconds")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--files-per-folder", type=int, default=None)
    s.add_argument("--rejects", action="store_true")
    s.add_argument("--dedup-within", default=None)
    s.add_argument("--latest", action="store_true")
    args = ap.parse_args(argv)

    paths = LakePaths(args.root)
    if args.job == "batch":
        spark = _session("quantlake-batch")
        run_date = args.run_date or dt.date.today().isoformat()
        if args.incremental:
            print(json.dumps(run_incremental(spark, paths, run_date, allow_empty=args.allow_empty, database=args.database).__dict__))
            return 0
        res = run_batch(spark, paths, run_date, dynamic_curated=args.dynamic_curated, allow_empty=args.allow_empty,
                        database=args.database, split_rows=args.split_rows)
        print(json.dumps(res.__dict__))
        return 0
    if args.job == "ingest":
        spark = _session("quantlake-ingest")
        symbols = [r["symbol"] for r in read_universe(spark, args.universe).collect()] if args.universe else None
        rows = run_ingest(spark, paths, spark.read.parquet(args.wide), args.run_date or dt.date.today().isoformat(), symbols)
        print(json.dumps({"rows": rows}))
        return 0
    if args.job == "refresh":
        print(json.dumps(refresh_catalog(_session("quantlake-refresh"), paths, args.database, ticks=args.ticks)))
        return 0

    spark = _session("quantlake-stream")
    if args.kafka:
        records = read_tick_stream(spark, args.kafka, args.prefix)
    else:
        records = spark.readStream.schema("value STRING").text(args.files)
    if args.rejects:
        start_reject_sink(records, paths.rejected_ticks, paths.reject_checkpoint, trigger=args.trigger, available_now=args.available_now)
    q = start_tick_sink(decode_ticks(records, bad_records="quarantine" if args.rejects else "keep"), paths.raw_ticks, paths.tick_checkpoint,
                        trigger=args.trigger, available_now=args.available_now,
                        files_per_folder=args.files_per_folder, dedup_within=args.dedup_within)
    if args.latest:
        start_latest_ticks(decode_ticks(records), paths.latest_ticks, paths.latest_checkpoint, trigger=args.trigger, available_now=args.available_now)
    q.awaitTermination()
    for other in spark.streams.active:
        other.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
