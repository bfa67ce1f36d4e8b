"""The place of every row in one order over a whole table, without a task that sees all rows.

Rows are range-partitioned on the order and sorted inside each range; a row's index within its range plus the
rows of all ranges before it is its place. Only one count per range reaches the driver, and there are at most
as many ranges as shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quantlake.session import scratch_path

#: monotonically_increasing_id() puts the partition above this many bits and the row's index below
INDEX_BITS = 33


def with_place(df: DataFrame, order: Sequence[str | Column], name: str = "place", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 1) in ``order``.

    Equal rows of ``order`` take consecutive places; to make the choice among them fixed, every further column that can be
    sorted decides ties in turn. The ranged rows are written under the shared scratch folder once, so places
    stay the same however often they are read and whichever executors are lost. An empty table gives no rows.
    """
    spark, cols = df.sparkSession, df.columns
    at = "_at"
    while at in cols:
        at = "_" + at
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant", "array", "struct")]
    total = [F.col(c) if isinstance(c, str) else c for c in order] + ties
    ranged = df.repartitionByRange(ranges, *total) if ranges else df.repartitionByRange(*total)
    path = scratch_path(spark, "places")
    ranged.sortWithinPartitions(*total).withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.schema(StructType([*df.schema.fields, StructField(at, LongType())])).parquet(path)
    span = F.shiftright(at, INDEX_BITS)
    before, offsets = 0, []
    for s, n in sorted(tuple(r) for r in numbered.groupBy(span.alias("s")).count().collect()):
        offsets.append((s, before))
        before += n
    spans = spark.createDataFrame(offsets, "_span long, _before long")
    # one row per range is broadcast
    placed = numbered.join(F.broadcast(spans), span == F.col("_span"))
    index = F.col(at).bitwiseAND(F.lit((1 << INDEX_BITS) - 1))
    return placed.select(*[F.col(f"`{c}`") for c in cols], (F.col("_before") + index + 1).alias(name))
