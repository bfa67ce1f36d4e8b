from quantlake.operators.cleaning import (
    cast_declared,
    clean,
    dedup_bars,
    drop_incomplete,
    ingested_at_as_text,
    non_negative_volume,
    parse_date,
    positive_close,
    round_prices,
    stamp_ingestion,
)
from quantlake.operators.dedup import keep_max_per_key
from quantlake.operators.indicators import (
    LOOKBACK,
    add_all_indicators,
    add_bollinger,
    add_ema,
    add_gain_loss,
    add_macd,
    add_rsi,
    add_sma,
    split_series,
    trailing_window,
)

__all__ = [
    "LOOKBACK",
    "add_all_indicators",
    "add_bollinger",
    "add_ema",
    "add_gain_loss",
    "add_macd",
    "add_rsi",
    "add_sma",
    "cast_declared",
    "clean",
    "dedup_bars",
    "drop_incomplete",
    "ingested_at_as_text",
    "keep_max_per_key",
    "non_negative_volume",
    "parse_date",
    "positive_close",
    "round_prices",
    "split_series",
    "stamp_ingestion",
    "trailing_window",
]
