"""Explicit schemas for every zone; nothing relies on inference."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICE_COLS = ("open", "high", "low", "close")
OHLCV_COLS = ("date", "symbol", "open", "high", "low", "close", "volume")

INDICATOR_COLS = (
    "sma_20",
    "sma_50",
    "ema_20",
    "rsi_14",
    "macd_line",
    "macd_signal",
    "macd_hist",
    "bb_upper",
    "bb_mid",
    "bb_lower",
)


def _f(name: str, dtype, comment: str | None = None) -> StructField:
    meta = {"comment": comment} if comment else {}
    return StructField(name, dtype, True, meta)


# raw zone: one directory per run date (date_partition=YYYY-MM-DD)
RAW_OHLCV = StructType(
    [
        _f("date", DateType()),
        _f("symbol", StringType()),
        _f("open", DoubleType()),
        _f("high", DoubleType()),
        _f("low", DoubleType()),
        _f("close", DoubleType()),
        _f("volume", LongType()),
        _f("date_partition", StringType()),
    ]
)

# staging zone: raw + ingestion stamp, still partitioned by run date
STAGING_OHLCV = StructType(
    RAW_OHLCV.fields[:-1] + [_f("ingested_at", TimestampType()), _f("date_partition", StringType())]
)

# curated zone: bars + indicators, partitioned by symbol; column comments carried as metadata
CURATED_OHLCV = StructType(
    [_f("date", DateType(), "date")]
    + [_f(c, DoubleType(), c) for c in PRICE_COLS]
    + [_f("volume", LongType(), "volume")]
    + [_f(c, DoubleType(), c) for c in INDICATOR_COLS]
    + [_f("ingested_at", StringType(), "ingested_at"), _f("symbol", StringType())]
)

# one tick as published on the wire (JSON)
TICK_JSON = StructType(
    [
        _f("symbol", StringType()),
        _f("timestamp", StringType()),
        _f("price", DoubleType()),
        _f("volume", LongType()),
        _f("open", DoubleType()),
        _f("high", DoubleType()),
        _f("low", DoubleType()),
        _f("prev_close", DoubleType()),
    ]
)

# landed ticks: partitioned by date_partition then symbol
RAW_TICKS = StructType(
    [
        _f("timestamp", StringType(), "time text as the feed sent it"),
        _f("price", DoubleType(), "price of the trade"),
        _f("volume", LongType(), "shares in the trade, may be absent"),
        _f("open", DoubleType(), "first price of that day"),
        _f("high", DoubleType(), "dearest price of that day so far"),
        _f("low", DoubleType(), "cheapest price of that day so far"),
        _f("prev_close", DoubleType(), "close of the trading day before"),
        _f("event_time", TimestampType(), "the time text as an instant"),
        _f("date_partition", DateType()),
        _f("symbol", StringType()),
    ]
)

UNIVERSE = StructType([_f("symbol", StringType())])


def ddl(schema: StructType, exclude: tuple[str, ...] = ()) -> str:
    """Column list for CREATE TABLE, with comments."""
    parts = []
    for f in schema.fields:
        if f.name in exclude:
            continue
        comment = f.metadata.get("comment")
        text = f"`{f.name}` {f.dataType.simpleString().upper()}"
        if comment:
            text += " COMMENT '" + comment.replace("'", "\\'") + "'"
        parts.append(text)
    return ", ".join(parts)
