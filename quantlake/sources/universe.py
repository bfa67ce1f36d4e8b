"""The tracked symbol universe."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.schemas import UNIVERSE


def universe_frame(spark: SparkSession, symbols: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in symbols], UNIVERSE)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """One symbol per line under any URI; blank lines and ``#`` comments are skipped, case is upper, repeats count once."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(F.upper(line).alias("symbol")).filter(F.col("symbol") != "").distinct()


def in_universe(df: DataFrame, universe: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose ``key`` is in the universe (left semi join; duplicates in the universe are harmless).

    Whether the universe is broadcast is Spark's decision, from sizes it measures.
    """
    return df.join(universe.select(F.col(key)).distinct(), key, "left_semi")
