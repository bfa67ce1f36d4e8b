"""Raw -> staging cleaning.

Steps of the source pipeline: drop incomplete rows, keep positive closes and
non-negative volumes, parse the date, round prices to 4 dp, stamp the
ingestion time, de-duplicate on (symbol, date). Two fixes: values are cast to
the declared types and the date is parsed *first*, with ``try_cast`` /
``try_to_date`` (D8, D9), so a bad value or date becomes NULL and is dropped by
the completeness check instead of reaching staging; and de-duplication is
deterministic (D6). All steps are narrow except the de-dup, one aggregation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from quantlake.operators.dedup import keep_max_per_key
from quantlake.schemas import PRICE_COLS

KEY_FIELDS = ("symbol", "date", "close", "volume")
BAR_KEY = ("symbol", "date")


def cast_declared(df: DataFrame) -> DataFrame:
    """Prices to DOUBLE, volume to BIGINT; unparseable values become NULL."""
    casts = {c: F.col(c).try_cast("double") for c in PRICE_COLS if c in df.columns}
    if "volume" in df.columns:
        casts["volume"] = F.col("volume").try_cast("bigint")
    return df.withColumns(casts)


def drop_incomplete(df: DataFrame, subset: Sequence[str] = KEY_FIELDS) -> DataFrame:
    """Drop rows with NULL (or NaN, for floating columns) in any key field."""
    return df.dropna(subset=list(subset))


def positive_close(df: DataFrame, col: str = "close") -> DataFrame:
    """C02."""
    return df.filter(F.col(col) > 0)


def non_negative_volume(df: DataFrame, col: str = "volume") -> DataFrame:
    """C03."""
    return df.filter(F.col(col) >= 0)


def parse_date(df: DataFrame, col: str = "date") -> DataFrame:
    """DATE from text (unparseable -> NULL, D9) or from a timestamp."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, DateType):
        return df
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return df.withColumn(col, F.to_date(col))
    src = F.col(col) if isinstance(dtype, StringType) else F.col(col).cast("string")
    return df.withColumn(col, F.try_to_date(src))


def round_prices(df: DataFrame, cols: Sequence[str] = PRICE_COLS, scale: int = 4) -> DataFrame:
    """HALF_UP rounding of the price columns."""
    return df.withColumns({c: F.round(c, scale) for c in cols if c in df.columns})


def stamp_ingestion(df: DataFrame, at: dt.datetime | str | Column | None = None) -> DataFrame:
    """``ingested_at``; wall clock unless a fixed instant is given (tests, backfills)."""
    if at is None:
        ts = F.current_timestamp()
    elif isinstance(at, Column):
        ts = at
    else:
        ts = F.lit(at).cast("timestamp")
    return df.withColumn("ingested_at", ts)


def dedup_bars(df: DataFrame, keys: Sequence[str] = BAR_KEY,
               order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per (symbol, date), the greatest by ``order`` (default: row content)."""
    return keep_max_per_key(df, keys, order)


def clean(raw: DataFrame, ingested_at: dt.datetime | str | Column | None = None,
          dedup_order: Sequence[str | Column] | None = None,
          keys: Sequence[str] = BAR_KEY) -> DataFrame:
    """The composed raw -> staging stage.

    ``keys`` is the de-dup key; a frame holding several run dates at once uses
    ``("symbol", "date", "date_partition")`` so that each run is cleaned on its own.
    """
    return (
        raw.transform(cast_declared)
        .transform(parse_date)
        .transform(drop_incomplete)
        .transform(positive_close)
        .transform(non_negative_volume)
        .transform(round_prices)
        .transform(lambda d: stamp_ingestion(d, ingested_at))
        .transform(lambda d: dedup_bars(d, keys, dedup_order))
    )


def ingested_at_as_text(df: DataFrame) -> DataFrame:
    """The BI-facing string form of the ingestion stamp."""
    return df.withColumn("ingested_at", F.col("ingested_at").cast("string"))
