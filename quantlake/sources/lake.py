"""Raw, staging and curated zones.

Reads always pass an explicit schema, so partition values keep their declared
types and no file footers are sampled for inference. Writes go to partition
directories of a new version folder (``versions``), so a write that fails leaves the zone as it was; its
row count is taken with an ``Observation`` on the same pass instead of a second execution of the plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quantlake.operators.cleaning import BAR_KEY
from quantlake.operators.dedup import keep_max_per_key
from quantlake.paths import LakePaths
from quantlake.schemas import CURATED_OHLCV, RAW_OHLCV, STAGING_OHLCV
from quantlake.sources import versions
from quantlake.sources.footers import footer_range
from quantlake.sources.versions import Commit

RUN_KEY, SYMBOL_KEY = "date_partition", "symbol"


def _data_cols(schema: StructType, *partition_cols: str) -> list[str]:
    return [f.name for f in schema.fields if f.name not in partition_cols]


def land_raw(df: DataFrame, paths: LakePaths, run_date: str) -> Commit:
    """Land raw bars in ``date_partition=<run_date>`` (that partition only is replaced)."""
    return versions.write_one(df.select(*_data_cols(RAW_OHLCV, RUN_KEY)), paths.raw_ohlcv, RUN_KEY, run_date)


def write_raw(df: DataFrame, paths: LakePaths, run_date: str) -> int:
    """``land_raw``, giving the rows only."""
    return land_raw(df, paths, run_date).rows


def write_raw_runs(df: DataFrame, paths: LakePaths) -> Commit:
    """Land several runs at once: each row in its own ``date_partition``; only those partitions are replaced."""
    return versions.write_partitions(df.select(*RAW_OHLCV.fieldNames()), paths.raw_ohlcv, RUN_KEY)


def landed_runs(spark: SparkSession, paths: LakePaths) -> list[str]:
    """The run dates that the raw zone holds, oldest first."""
    return sorted(versions.live(spark, paths.raw_ohlcv, RUN_KEY))


def read_raw(spark: SparkSession, paths: LakePaths, run_date: str | None = None) -> DataFrame:
    """The raw zone, pruned to one run date when given (PartitionFilters)."""
    return select_run(versions.read(spark, paths.raw_ohlcv, RAW_OHLCV, RUN_KEY), run_date)


def select_run(df: DataFrame, run_date) -> DataFrame:
    """Keep one run-date partition; ``"latest"`` picks the greatest one present."""
    if run_date is None:
        return df
    if isinstance(run_date, str) and run_date == "latest":
        run_date = df.agg(F.max("date_partition")).scalar()
    return df.filter(F.col("date_partition") == run_date)


def land_staging(df: DataFrame, paths: LakePaths, run_date: str) -> Commit:
    """Replace one staging partition and report its rows."""
    return versions.write_one(df.select(*_data_cols(STAGING_OHLCV, RUN_KEY)), paths.staging_ohlcv, RUN_KEY, run_date)


def write_staging(df: DataFrame, paths: LakePaths, run_date: str) -> int:
    """``land_staging``, giving the rows only."""
    return land_staging(df, paths, run_date).rows


def read_staging(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return versions.read(spark, paths.staging_ohlcv, STAGING_OHLCV, RUN_KEY)


def latest_per_bar(staging: DataFrame) -> DataFrame:
    """Across run dates the same (symbol, date) repeats; the newest run wins."""
    rest = [c for c in staging.columns if c not in BAR_KEY and c != "date_partition"]
    return keep_max_per_key(staging, BAR_KEY, ["date_partition", *rest])


def history_by_symbol(staging: DataFrame) -> DataFrame:
    """``latest_per_bar`` for windows over symbols: shuffled by symbol and sorted by (symbol, date) once.

    Bars are unique within a run, so combining before the shuffle would reduce nothing; the windows that
    follow reuse this partitioning and order.
    """
    rest = [c for c in staging.columns if c not in BAR_KEY and c != "date_partition"]
    newest = Window.partitionBy(*BAR_KEY).orderBy(*[F.desc(c) for c in ["date_partition", *rest]])
    ranked = staging.repartition("symbol").withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def read_staging_history(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """All staging partitions, one row per (symbol, date)."""
    return latest_per_bar(read_staging(spark, paths))


def land_curated(df: DataFrame, paths: LakePaths, dynamic: bool = False) -> Commit:
    """Curated bars partitioned by symbol.

    Static overwrite (default) replaces the whole table, so symbols absent from
    ``df`` disappear, as in the source pipeline; ``dynamic=True`` replaces only
    the symbols present.
    """
    return versions.write_partitions(df.select(*CURATED_OHLCV.fieldNames()), paths.curated_ohlcv, SYMBOL_KEY, full=not dynamic)


def write_curated(df: DataFrame, paths: LakePaths, dynamic: bool = False) -> int:
    """``land_curated``, giving the rows only."""
    return land_curated(df, paths, dynamic).rows


def read_curated(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return versions.read(spark, paths.curated_ohlcv, CURATED_OHLCV, SYMBOL_KEY)


def curated_days(spark: SparkSession, paths: LakePaths) -> tuple[dt.date | None, dt.date | None]:
    """The first and last day of the curated zone, from the footers of its live folders."""
    folders = list(versions.live(spark, paths.curated_ohlcv, SYMBOL_KEY).values())
    schema = StructType([f for f in CURATED_OHLCV.fields if f.name != SYMBOL_KEY])
    return footer_range(spark, folders, "date", schema) if folders else (None, None)


def read_latest_day(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The curated bars of the last day; the day comes from footers, and the scan skips row groups by it."""
    return read_curated(spark, paths).where(F.col("date") == F.lit(curated_days(spark, paths)[1]).cast("date"))


def sweep(spark: SparkSession, paths: LakePaths, keep: int = 1) -> list[str]:
    """Delete what newer writes have replaced in the three zones, but for the last ``keep`` versions of each."""
    zones = ((paths.raw_ohlcv, RUN_KEY), (paths.staging_ohlcv, RUN_KEY), (paths.curated_ohlcv, SYMBOL_KEY))
    return [path for zone, key in zones for path in versions.sweep(spark, zone, key, keep)]
