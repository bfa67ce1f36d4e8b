"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.session import scratch_path

#: Rows and bytes of one Arrow batch handed to Python: texts can be long, so batches stay small.
ARROW_ROWS, ARROW_BYTES = 400, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under spark.checkpoint.dir and read it back: lineage ends at files that every
    executor can read, and later steps read only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(col: str | Column = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key of (id, text). Rows that agree in both are one document for every decision;
    a null id is a value of its own."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("\0null")), whole_text(text_col))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
