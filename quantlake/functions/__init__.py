from quantlake.functions.exprs import (
    iso_timestamp,
    market_status,
    pct_change,
    rsi_label,
    stable_round,
    topic_for,
    week_start,
)

__all__ = [
    "iso_timestamp",
    "market_status",
    "pct_change",
    "rsi_label",
    "stable_round",
    "topic_for",
    "week_start",
]
