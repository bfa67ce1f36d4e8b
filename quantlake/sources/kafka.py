"""Tick records on Kafka.

``encode_ticks`` turns tick rows into (topic, key, value) records: one topic
per symbol, the symbol as key, the tick as JSON (NULL fields written as
``null``, like a plain JSON serializer). ``write_ticks_kafka`` and
``read_tick_stream`` use Spark's Kafka connector; it is not bundled with
PySpark, so they need ``spark-sql-kafka`` on the classpath at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.functions.exprs import topic_for
from quantlake.schemas import TICK_JSON

DEFAULT_PREFIX = "ticks"
JSON_OPTIONS = {"ignoreNullFields": "false"}


def encode_ticks(ticks: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    payload = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TICK_JSON.fields])
    return ticks.select(
        topic_for("symbol", prefix).alias("topic"),
        F.col("symbol").alias("key"),
        F.to_json(payload, JSON_OPTIONS).alias("value"),
    )


def write_ticks_kafka(records: DataFrame, brokers: str) -> None:
    """Publish encoded records (batch). Topic comes from the ``topic`` column."""
    records.write.format("kafka").option("kafka.bootstrap.servers", brokers).save()


def read_tick_stream(
    spark: SparkSession,
    brokers: str,
    prefix: str = DEFAULT_PREFIX,
    starting_offsets: str = "latest",
    group_id: str | None = None,
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Every ``<prefix>.*`` topic as a stream of Kafka records.

    ``max_offsets_per_trigger`` bounds one micro-batch, so catching up after an
    outage proceeds in steady batches instead of one batch holding the backlog.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribePattern", prefix.replace(".", r"\.") + r"\..*")
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()
