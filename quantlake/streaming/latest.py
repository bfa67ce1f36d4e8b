"""The latest tick of each symbol and day as running state (W11, V06, M16 and M17 on a stream).

A streaming aggregate keeps, for each (day, symbol), the greatest tick by the total order of the batch view; it is
combined in every input task before the shuffle, so a hot symbol moves one row per task. Its state
holds one tick a symbol for the days that the watermark has not passed, and nothing older.

Each micro-batch merges the keys that it has touched into a table of latest ticks, whose changed days are replaced as versions
(``sources.versions``): readers see a batch as a whole or not at all. The merge keeps the greater tick, so a
batch that is run again after a restart changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from quantlake.functions.exprs import utc_day
from quantlake.operators.dedup import keep_max_per_key
from quantlake.plans.views import TICK_ORDER
from quantlake.schemas import RAW_TICKS
from quantlake.sources import versions

DAY_KEY = "day"
COLUMNS = RAW_TICKS.fieldNames()
STORED = StructType([*RAW_TICKS.fields, StructField(DAY_KEY, StringType())])


def latest_per_day(ticks: DataFrame, late: str) -> DataFrame:
    """The latest tick of each (day, symbol) of a stream whose ticks arrive at most ``late`` after newer ones."""
    fields = [c for c in COLUMNS if c not in ("symbol", "date_partition")]
    timed = ticks.withWatermark("event_time", late)
    best = timed.groupBy(F.window("event_time", "1 day"), "symbol").agg(
        F.max_by(F.struct(*fields), F.struct(*TICK_ORDER)).alias("t"))
    return best.select("symbol", utc_day("window.start").alias("date_partition"), "t.*").select(COLUMNS)


def merge_latest(batch: DataFrame, path: str) -> int:
    """Merge ticks into the table at ``path``; returns the rows of the days that it has rewritten (0: nothing changed)."""
    spark = batch.sparkSession
    new = batch.select(COLUMNS).withColumn(DAY_KEY, F.col("date_partition").cast("string"))
    days = [r[0] for r in new.select(DAY_KEY).distinct().collect()]
    if not days:
        return 0
    old = versions.read(spark, path, STORED, DAY_KEY).where(F.col(DAY_KEY).isin(days))
    rows = keep_max_per_key(old.unionByName(new.select(old.columns)), ["symbol", DAY_KEY], [*TICK_ORDER])
    done = versions.write_partitions(rows, path, DAY_KEY)
    versions.sweep(spark, path, DAY_KEY)
    return done.rows


def start_latest_ticks(ticks: DataFrame, path: str, checkpoint: str, late: str = "1 day", trigger: str = "30 seconds",
                       available_now: bool = False) -> StreamingQuery:
    """Keep the table of latest ticks at ``path`` up to date with a stream of decoded ticks.

    Ticks without a readable time belong to no day and are left out; those more than ``late`` older than the newest seen are
    dropped, which is what bounds the state.
    """
    w = latest_per_day(ticks, late).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    w = w.foreachBatch(lambda batch, _: merge_latest(batch, path) and None)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def read_latest_ticks(spark: SparkSession, path: str) -> DataFrame:
    """One tick per (day, symbol), in the landed layout: ``v_latest_ticks`` and the live measures read it like landed ticks."""
    return versions.read(spark, path, STORED, DAY_KEY).select(COLUMNS)
