"""The greatest or least value of a column from Parquet footers.

Spark's built-in Parquet reader answers an aggregate from row-group statistics, without reading any column, if aggregate push-down
is on and the file source is planned as a DataSource V2 scan. Both are settings; they are made in a session of
their own, which shares the context and the catalog but leaves the caller's settings alone. Numbers, booleans and dates
can be answered so; for other types (timestamps, texts) Spark reads the column instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
#: what the reader says where a file's footer lacks statistics of a column
NO_STATISTICS = "No min/max found for Parquet file"


def footer_frame(spark: SparkSession, paths: str | Sequence[str], column: str, schema: StructType | None = None) -> DataFrame:
    """One row: ``least`` and ``greatest`` of ``column``, planned as a push-down into the footers."""
    own = spark.newSession()
    for k, v in SETTINGS.items():
        own.conf.set(k, v)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    reader = own.read.schema(schema) if schema is not None else own.read
    df = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    return df.agg(F.min(column).alias("least"), F.max(column).alias("greatest"))


def footer_range(spark: SparkSession, paths: str | Sequence[str], column: str, schema: StructType | None = None) -> tuple:
    """(least, greatest) of a column; the column is scanned only where a footer has no statistics."""
    try:
        return tuple(footer_frame(spark, paths, column, schema).first())
    except (PySparkException, Py4JJavaError) as e:
        if NO_STATISTICS not in str(e):
            raise
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return tuple(reader.parquet(*([paths] if isinstance(paths, str) else paths)).agg(F.min(column), F.max(column)).first())
