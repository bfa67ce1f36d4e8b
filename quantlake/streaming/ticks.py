"""Live ticks: decode and land with Structured Streaming.

``decode_ticks`` is a pure DataFrame function used by the stream and by batch
code alike: bytes -> text -> ``from_json`` with the fixed tick schema ->
flattened columns, then ``event_time`` and the ``date_partition`` day. It is
stateless and narrow, so a micro-batch does not shuffle (unless the sink is
asked to bound its file count, see ``start_tick_sink``).

Repeated records can be dropped within a watermark (``once_within``); ``latest`` keeps the newest tick of each symbol.

The sink is Spark's file sink: each micro-batch is committed in the
checkpoint and in ``_spark_metadata``, so a restarted query neither loses nor
repeats files, and readers of the folder see committed files only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from quantlake.functions.exprs import utc_day, utc_instant
from quantlake.schemas import RAW_TICKS, TICK_JSON

BAD_RECORDS = ("keep", "quarantine")


def decode_ticks(records: DataFrame, value_col: str = "value", bad_records: str = "keep",
                 lenient_volume: bool = False) -> DataFrame:
    """Kafka-style records (``value`` as binary or text) -> tick rows.

    ``bad_records="keep"`` keeps an unparseable payload as an all-NULL row (the
    source pipeline's behaviour); ``"quarantine"`` leaves it to ``start_reject_sink``,
    which lands the other side. ``lenient_volume`` accepts
    ``3.0`` for the integer volume field instead of yielding NULL.
    """
    if bad_records not in BAD_RECORDS:
        raise ValueError(f"bad_records must be one of {BAD_RECORDS}")
    schema = TICK_JSON
    if lenient_volume:
        schema = StructType([
            f if f.name != "volume" else f.__class__("volume", StringType(), True) for f in TICK_JSON.fields
        ])
    parsed = records.select(F.from_json(F.col(value_col).cast("string"), schema).alias("t"))
    if bad_records == "quarantine":
        parsed = parsed.filter(_good(F.col("t")))
    ticks = parsed.select("t.*")
    if lenient_volume:
        ticks = ticks.withColumn("volume", F.col("volume").try_cast("double").try_cast("bigint"))
    return ticks.withColumn("event_time", utc_instant("timestamp")).withColumn("date_partition", utc_day("event_time"))


def bad_tick_records(records: DataFrame, value_col: str = "value") -> DataFrame:
    """The other side of ``quarantine``: payloads without a symbol or a readable timestamp."""
    t = F.from_json(F.col(value_col).cast("string"), TICK_JSON)
    return records.filter(~_good(t))


def _good(t: Column) -> Column:
    return F.coalesce(t.isNotNull() & t.symbol.isNotNull() & utc_instant(t.timestamp).isNotNull(), F.lit(False))


def start_reject_sink(records: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds",
                      available_now: bool = False, value_col: str = "value") -> StreamingQuery:
    """Land what ``bad_records="quarantine"`` keeps out, as text with the time it was seen."""
    bad = bad_tick_records(records, value_col).select(
        F.col(value_col).cast("string").alias("value"), F.current_timestamp().alias("rejected_at"))
    w = bad.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def once_within(ticks: DataFrame, delay: str) -> DataFrame:
    """A stream's ticks without repeats: rows equal in every field are one record, however often it is delivered.

    The state holds records until the watermark, ``delay`` behind the newest event time, has passed them; ticks older than
    the watermark are late and are dropped, as nothing is known any more about whether they were landed. Rows
    without a readable time can't be placed and are left out (``bad_tick_records`` has them).
    """
    fields = ["symbol", "timestamp", "price", "volume", "open", "high", "low", "prev_close"]
    timed = ticks.where(F.col("event_time").isNotNull()).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(fields)


def landed_columns(ticks: DataFrame) -> DataFrame:
    """Order columns as the landed table (partition columns last)."""
    return ticks.select(*[f.name for f in RAW_TICKS.fields])


def start_tick_sink(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "30 seconds",
    available_now: bool = False,
    query_name: str | None = None,
    files_per_folder: int | None = None,
    dedup_within: str | None = None,
) -> StreamingQuery:
    """Append ticks to Parquet partitioned by day and symbol.

    ``available_now=True`` processes everything available and stops (tests,
    catch-up runs); otherwise a processing-time trigger every ``trigger``.

    By default every micro-batch task writes its own file into each (day,
    symbol) folder it holds. ``files_per_folder=k`` shuffles each micro-batch
    by the folder keys plus a deterministic salt (hash of the tick time mod k):
    at most k files per folder per batch, and a hot symbol still spreads over
    k tasks.

    The feed delivers at least once. ``dedup_within`` (such as ``"1 hour"``) lands a record that is sent again within
    that event time once, also across micro-batches and restarts (see ``once_within``).
    """
    out = landed_columns(ticks if dedup_within is None else once_within(ticks, dedup_within))
    if files_per_folder:
        salt = F.pmod(F.hash("event_time", "timestamp"), F.lit(files_per_folder))
        out = out.repartition("date_partition", "symbol", salt)
    w = (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date_partition", "symbol")
        .outputMode("append")
    )
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def read_landed_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Landed ticks by path; the sink's metadata log limits this to committed files."""
    return spark.read.schema(RAW_TICKS).parquet(path)
