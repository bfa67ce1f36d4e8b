"""The daily jobs: landing a vendor history, and raw run partition -> staging -> curated with indicators.

One action per zone write; row counts come from the same pass
(``Observation``). Staging is read back from its files before the indicator
step, which cuts the lineage between the two halves. The history is shuffled
once by symbol and sorted once by (symbol, date): the newest run of each bar is
picked, and all indicator windows evaluated, on that one order.

Every write lands in a version folder of its own (``sources.versions``), so a run that fails leaves what readers
see as it was; catalog partitions are moved after success, from the write's own report, and replaced versions are
swept at the end. ``plans.incremental`` computes the bars only that a run changes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from quantlake.operators.cleaning import clean, ingested_at_as_text
from quantlake.operators.indicators import add_all_indicators
from quantlake.paths import LakePaths
from quantlake.sources import catalog, versions
from quantlake.sources.lake import (
    history_by_symbol,
    land_curated,
    land_raw,
    land_staging,
    latest_per_bar,
    read_raw,
    read_staging,
    sweep,
)
from quantlake.sources.versions import Commit
from quantlake.sources.wide import EmptyHistoryError, normalize_wide


class EmptyRunError(RuntimeError):
    """The raw zone holds no row for the run date; nothing was written."""


@dataclass
class BatchResult:
    run_date: str
    staging_rows: int
    curated_rows: int
    split_rows: int | None


def run_ingest(spark: SparkSession, paths: LakePaths, wide: DataFrame, run_date: str | dt.date,
               symbols: Sequence[str] | None = None, date_col: str = "Date", database: str | None = None) -> int:
    """Reshape a wide vendor history of the requested symbols and land it as one run; returns its rows.

    Nothing is replaced by an empty history: the rows are looked for before the run partition is written.
    With ``database`` the run's partition of the raw table is registered there.
    """
    bars = normalize_wide(wide, symbols, date_col)
    if wide.isEmpty():
        raise EmptyHistoryError("the vendor history has no rows")
    done = land_raw(bars, paths, str(run_date))
    if database:
        catalog.create_database(spark, database, use=False)
        catalog.publish(spark, catalog.create_raw_table(spark, paths, database), done.partitions)
    return done.rows


def run_batch(
    spark: SparkSession,
    paths: LakePaths,
    run_date: str | dt.date,
    ingested_at: dt.datetime | str | Column | None = None,
    split_rows: int | None = None,
    dynamic_curated: bool = False,
    allow_empty: bool = False,
    database: str | None = None,
) -> BatchResult:
    """One run date through staging into curated.

    A run date without raw rows raises ``EmptyRunError`` before any write, unless ``allow_empty``.
    ``split_rows`` evaluates series in ranges of about that many rows, whatever symbol they are of (for intraday bars;
    see ``ranged_series``). With
    ``database`` the curated table is registered there, its new partitions included, and its views refreshed.
    """
    run = str(run_date)
    raw = read_raw(spark, paths, run)
    if not allow_empty and raw.isEmpty():
        raise EmptyRunError(f"no raw rows for run date {run}")
    staged = land_staging(clean(raw, ingested_at), paths, run)
    staging = read_staging(spark, paths)
    # in ranges a symbol's bars are never together, so runs are reduced per bar in every input task instead
    history = history_by_symbol(staging) if split_rows is None else latest_per_bar(staging)
    enriched = add_all_indicators(history, split_rows=split_rows)
    versions.delete(spark, paths.tail_ohlcv)  # an incremental run that follows starts anew
    curated = land_curated(ingested_at_as_text(enriched), paths, dynamic=dynamic_curated)
    if database:
        publish_run(spark, paths, database, staged, curated, whole=not dynamic_curated)
    sweep(spark, paths)
    return BatchResult(run, staged.rows, curated.rows, split_rows)


def publish_run(spark: SparkSession, paths: LakePaths, database: str, staged: Commit, curated: Commit, whole: bool) -> None:
    """Register in ``database`` what a run's two writes report, and replace the views."""
    catalog.create_database(spark, database, use=False)
    catalog.publish(spark, catalog.create_staging_table(spark, paths, database), staged.partitions)
    table = catalog.create_curated_table(spark, paths, database)
    if catalog.partitions(spark, table).isEmpty():
        catalog.repair(spark, table)
    else:
        catalog.publish(spark, table, curated.partitions, whole=whole)
    catalog.create_views(spark, database)


def refresh_catalog(spark: SparkSession, paths: LakePaths, database: str, ticks: bool = False) -> list[str]:
    """Create what is missing in ``database``, register all that the zones hold, replace the views; returns the view names."""
    catalog.create_database(spark, database, use=False)
    curated = catalog.create_curated_table(spark, paths, database)
    catalog.repair(spark, curated)
    spark.catalog.refreshTable(curated)
    if ticks:
        table = catalog.create_ticks_table(spark, paths, database)
        catalog.repair(spark, table)
    return catalog.create_views(spark, database, ticks=ticks)
