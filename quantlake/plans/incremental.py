"""Curated bars brought up to date by what a run changes, instead of by all history.

A run's cleaned bars are compared with the curated ones of the same symbols and days. Three kinds of symbols follow:

* nothing differs: neither read further nor written;
* all new bars lie behind the last curated one: indicators are computed over the stored tail (the last LOOKBACK bars of
  each symbol) and the new bars, and only the new rows are appended to the symbol's folder;
* anything else (a late correction, a bar in between, a symbol seen first): that symbol's history is computed anew and its
  partition replaced.

Rows equal those of a full run in every column but ``ingested_at``: a bar that a run repeats unchanged keeps its first stamp.

Order of writes: staging, a marker, replaced partitions, appended rows, the tail, away with the marker. Each
is complete or unseen, except that appends reach several folders; so a run that finds a marker, or no tail,
recomputes everything once. A run date staged before, or older than the newest one staged, can take bars away
or be overruled by newer runs: the symbols of its old and new bars are computed anew.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quantlake.operators.cleaning import clean, ingested_at_as_text
from quantlake.operators.indicators import LOOKBACK, add_all_indicators, last_bars
from quantlake.paths import LakePaths
from quantlake.plans.batch import EmptyRunError, publish_run
from quantlake.schemas import CURATED_OHLCV, STAGING_OHLCV
from quantlake.session import scratch_path
from quantlake.sources import versions
from quantlake.sources.lake import (
    RUN_KEY,
    SYMBOL_KEY,
    history_by_symbol,
    land_curated,
    land_staging,
    read_curated,
    read_raw,
    read_staging,
    sweep,
)
from quantlake.sources.versions import Commit

VALUES = ("open", "high", "low", "close", "volume")
TAIL = StructType([f for f in STAGING_OHLCV.fields if f.name != RUN_KEY])
TAIL_KEY = "part"


@dataclass
class IncrementalResult:
    run_date: str
    staging_rows: int
    full: bool
    appended: int
    appended_rows: int
    replaced: int
    replaced_rows: int


def read_tail(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The last LOOKBACK bars of each symbol as staging holds them."""
    return versions.read(spark, paths.tail_ohlcv, StructType([*TAIL.fields, *_part().fields]), TAIL_KEY).drop(TAIL_KEY)


def _part() -> StructType:
    return StructType().add(TAIL_KEY, "string")


def _write_tail(bars: DataFrame, paths: LakePaths) -> None:
    tail = last_bars(bars.select(TAIL.fieldNames()), LOOKBACK)
    versions.write_partitions(tail.withColumn(TAIL_KEY, F.lit("all")), paths.tail_ohlcv, TAIL_KEY, full=True)


def _curated(history: DataFrame) -> DataFrame:
    return ingested_at_as_text(add_all_indicators(history))


def _names(df: DataFrame) -> list[str]:
    """Partition values, as the catalog lists them."""
    return sorted(r[0] for r in df.select(SYMBOL_KEY).distinct().collect())


def _history_of(spark: SparkSession, paths: LakePaths, symbols: DataFrame) -> DataFrame:
    """The newest run's bar of each day, of the given symbols."""
    return history_by_symbol(read_staging(spark, paths).join(symbols.select(SYMBOL_KEY).distinct(), SYMBOL_KEY, "left_semi").select(STAGING_OHLCV.fieldNames()))


def run_incremental(spark: SparkSession, paths: LakePaths, run_date: str | dt.date, ingested_at: dt.datetime | str | Column | None = None,
                    allow_empty: bool = False, database: str | None = None) -> IncrementalResult:
    """One run date through staging into curated, computing changed bars only. Not to be run twice at a time on one lake."""
    run = str(run_date)
    raw = read_raw(spark, paths, run)
    if not allow_empty and raw.isEmpty():
        raise EmptyRunError(f"no raw rows for run date {run}")
    staged_runs = sorted(versions.live(spark, paths.staging_ohlcv, RUN_KEY))
    old = read_staging(spark, paths).where(F.col(RUN_KEY) == run).select(SYMBOL_KEY) if run in staged_runs else None
    dead = versions.children(spark, paths.pending)
    no_tail = not versions.complete(spark, paths.tail_ohlcv, TAIL_KEY)
    _mark(spark, paths, run)
    staged = land_staging(clean(raw, ingested_at), paths, run)
    if dead or no_tail:
        done = _everything(spark, paths, run, staged)
    elif staged_runs and run <= staged_runs[-1]:
        # the old version of the run is still there until the sweep at the end
        touched = read_staging(spark, paths).where(F.col(RUN_KEY) == run).select(SYMBOL_KEY)
        touched = (touched if old is None else touched.unionByName(old)).distinct()
        done = _changes(spark, paths, run, staged, None, touched)
    else:
        appended, replaced = _compare(spark, paths, run)
        done = _changes(spark, paths, run, staged, appended, replaced)
    result, curated = done
    if database:
        publish_run(spark, paths, database, staged, curated, whole=result.full)
    versions.delete(spark, paths.pending)
    sweep(spark, paths)
    versions.sweep(spark, paths.tail_ohlcv, TAIL_KEY)
    return result


def _mark(spark: SparkSession, paths: LakePaths, run: str) -> None:
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("append").text(f"{paths.pending}/{run}")


def _everything(spark: SparkSession, paths: LakePaths, run: str, staged: Commit) -> tuple[IncrementalResult, Commit]:
    curated = land_curated(_curated(history_by_symbol(read_staging(spark, paths))), paths)
    _write_tail(history_by_symbol(read_staging(spark, paths)), paths)
    return IncrementalResult(run, staged.rows, True, 0, 0, len(curated.partitions), curated.rows), curated


def _compare(spark: SparkSession, paths: LakePaths, run: str) -> tuple[DataFrame, DataFrame]:
    """Of a run that is the newest: its new bars behind each symbol's last curated one, and the symbols to compute anew."""
    bars = read_staging(spark, paths).where(F.col(RUN_KEY) == run).select(TAIL.fieldNames())
    first = bars.agg(F.min("date")).first()[0]
    # only the folders of the run's symbols and days from its first one on are read
    known = read_curated(spark, paths).where(F.col("date") >= F.lit(first)).select(
        SYMBOL_KEY, "date", F.struct(*VALUES).alias("now")).join(bars.select(SYMBOL_KEY).distinct(), SYMBOL_KEY, "left_semi")
    changed = bars.join(known, [SYMBOL_KEY, "date"], "left").where(~F.struct(*VALUES).eqNullSafe(F.col("now"))).select(TAIL.fieldNames())
    path = scratch_path(spark, "changed")
    changed.write.parquet(path)
    changed = spark.read.schema(TAIL).parquet(path)
    last = read_tail(spark, paths).groupBy(SYMBOL_KEY).agg(F.max("date").alias("_last"))
    earliest = changed.groupBy(SYMBOL_KEY).agg(F.min("date").alias("_from"))
    kinds = earliest.join(last, SYMBOL_KEY, "left").select(SYMBOL_KEY, F.coalesce(F.col("_from") > F.col("_last"), F.lit(False)).alias("behind"))
    return changed.join(kinds.where("behind"), SYMBOL_KEY, "left_semi"), kinds.where(~F.col("behind")).select(SYMBOL_KEY)


def _changes(spark: SparkSession, paths: LakePaths, run: str, staged: Commit, appended: DataFrame | None, replaced: DataFrame) -> tuple[IncrementalResult, Commit]:
    tail = read_tail(spark, paths)
    again, behind = _names(replaced), _names(appended) if appended is not None else []
    redone = spark.createDataFrame([(s,) for s in again], f"{SYMBOL_KEY} string")
    moved = spark.createDataFrame([(s,) for s in behind], f"{SYMBOL_KEY} string")
    kept = tail.join(redone.unionByName(moved), SYMBOL_KEY, "left_anti").select(TAIL.fieldNames())
    pieces, added, curated = [kept], 0, Commit("", 0)
    new = None
    if behind:
        before = tail.join(moved, SYMBOL_KEY, "left_semi").select(TAIL.fieldNames())
        new = before.withColumn("_new", F.lit(False)).unionByName(appended.select(*TAIL.fieldNames(), F.lit(True).alias("_new")))
    if again:
        curated = land_curated(_curated(_history_of(spark, paths, redone)), paths, dynamic=True)
        gone = sorted(set(again) - set(curated.partitions))
        for s in gone:  # the run took a symbol's last bar away
            empty = versions.write_one(spark.createDataFrame([], StructType([f for f in CURATED_OHLCV.fields if f.name != SYMBOL_KEY])), paths.curated_ohlcv, SYMBOL_KEY, s)
            curated = Commit(curated.path, curated.rows, curated.partitions | empty.partitions)
        pieces.append(_history_of(spark, paths, redone).select(TAIL.fieldNames()))
    if behind:
        rows = _curated(new).where("_new").select(CURATED_OHLCV.fieldNames())
        added = versions.append(rows, paths.curated_ohlcv, SYMBOL_KEY, behind)
        pieces.append(new.select(TAIL.fieldNames()))
    if again or behind:
        bars = pieces[0]
        for p in pieces[1:]:
            bars = bars.unionByName(p)
        _write_tail(bars, paths)
    return IncrementalResult(run, staged.rows, False, len(behind), added, len(again), curated.rows), curated
