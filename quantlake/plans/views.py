"""The seven serving views (V01-V07) as DataFrame functions.

Views never sort (D19); ``presentation`` helpers do. "Today" for the tick views
is a parameter (D12): ``None`` = the session's current date (the source
behaviour), ``"latest"`` = the greatest day present, or any date / string.
The day filter is on the partition column, so a lake-backed tick table is
pruned to that one folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantlake.functions.exprs import market_status, pct_change, rsi_label, week_start

AsOf = str | dt.date | Column | None


def _trade_date(col: str = "date") -> Column:
    return F.col(col).cast("string").alias("trade_date")


def v_daily_summary(curated: DataFrame) -> DataFrame:
    """Bars with the day's change and the main indicators (14 columns)."""
    return curated.select(
        "symbol",
        _trade_date(),
        "open",
        "high",
        "low",
        "close",
        "volume",
        pct_change("close", "open").alias("daily_change_pct"),
        "sma_20",
        "sma_50",
        "rsi_14",
        "macd_line",
        "bb_upper",
        "bb_lower",
    )


def daily_moves(bars: DataFrame) -> DataFrame:
    """The part of V01 that needs no indicators."""
    return bars.select("symbol", _trade_date(), "open", "high", "low", "close", "volume", pct_change("close", "open").alias("daily_change_pct"))


def v_weekly_rollup(curated: DataFrame, week: str = "monday") -> DataFrame:
    """Per (symbol, week): low, high, volume, first open and last close of the week.

    First/last come from ``min_by``/``max_by`` inside the aggregate: partial
    aggregation map-side, no window sort (the source needed two ROW_NUMBERs).
    """
    ws = week_start("date", week)
    return curated.groupBy("symbol", ws.cast("string").alias("week_start")).agg(
        F.min("low").alias("week_low"),
        F.max("high").alias("week_high"),
        F.sum("volume").alias("week_volume"),
        F.min_by("open", "date").alias("week_open"),
        F.max_by("close", "date").alias("week_close"),
    )


def latest_date(df: DataFrame, col: str = "date") -> Column:
    """Scalar subquery: the greatest ``col`` in ``df`` (A02), evaluated once."""
    return df.agg(F.max(col)).scalar()


def v_top_movers(curated: DataFrame) -> DataFrame:
    """Every symbol's move on the last trading day in the table (A02 + J01)."""
    day = curated.filter(F.col("date") == latest_date(curated))
    change = pct_change("close", "open")
    return day.select(
        "symbol",
        _trade_date(),
        "open",
        "close",
        change.alias("change_pct"),
        F.abs(change).alias("abs_change_pct"),
    )


def v_rsi_signals(curated: DataFrame) -> DataFrame:
    """RSI with its overbought / oversold / neutral label."""
    return curated.filter(F.col("rsi_14").isNotNull()).select(
        "symbol", _trade_date(), "close", "rsi_14", rsi_label("rsi_14").alias("rsi_signal")
    )


def v_bollinger_squeeze(curated: DataFrame) -> DataFrame:
    """Band width per bar (the first bar of each symbol has no band)."""
    return curated.filter(F.col("bb_upper").isNotNull()).select(
        "symbol",
        _trade_date(),
        "close",
        "bb_upper",
        "bb_lower",
        F.round(F.col("bb_upper") - F.col("bb_lower"), 4).alias("band_width"),
    )


def _day_value(ticks: DataFrame, as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str) and as_of == "latest":
        return latest_date(ticks, "date_partition")
    return F.lit(as_of).cast("date")


def ticks_of_day(ticks: DataFrame, as_of: AsOf = None) -> DataFrame:
    """today's partition of the landed ticks."""
    return ticks.filter(F.col("date_partition") == _day_value(ticks, as_of))


TICK_ORDER = ("event_time", "timestamp", "price", "volume", "prev_close", "open", "high", "low")


def latest_ticks(ticks: DataFrame, keys: Sequence[str | Column] = ("symbol",)) -> DataFrame:
    """The most recent tick per key, ties broken by the full tick content.

    Spark limits each key to one row in every input task before the shuffle (window group limit), so a
    hot key moves one row per task.
    """
    plain = {k for k in keys if isinstance(k, str)}
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]   # derived keys must be aliased
    keyed = ticks.select(*key_cols, *[c for c in ticks.columns if c not in plain])
    newest = Window.partitionBy(*keyed.columns[: len(key_cols)]).orderBy(*[F.desc(c) for c in TICK_ORDER])
    return keyed.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def _live_columns(t: DataFrame, keys: Sequence[str], tz: str, trading_dow: tuple[int, int]) -> DataFrame:
    high = F.coalesce(F.col("high"), F.col("price"))
    low = F.coalesce(F.col("low"), F.col("price"))
    return t.select(
        *keys,
        F.col("timestamp").alias("tick_time"),
        "price",
        F.coalesce(F.col("volume"), F.lit(0)).alias("volume"),
        F.coalesce(F.col("open"), F.col("price")).alias("open"),
        high.alias("high"),
        low.alias("low"),
        "prev_close",
        pct_change("price", "prev_close").alias("change_pct"),
        F.round(F.try_divide(high - low, F.col("prev_close")) * F.lit(100), 2).alias("intraday_range_pct"),
        market_status("event_time", "volume", tz=tz, trading_dow=trading_dow).alias("market_status"),
    )


def v_latest_ticks(ticks: DataFrame, as_of: AsOf = None, tz: str = "UTC",
                   trading_dow: tuple[int, int] = (2, 6)) -> DataFrame:
    """Latest tick per symbol for the day, with change, range and market status."""
    day = ticks_of_day(ticks, as_of)
    return _live_columns(latest_ticks(day, ("symbol",)), ["symbol"], tz, trading_dow)


def latest_ticks_by_hour(ticks: DataFrame, tz: str = "UTC", trading_dow: tuple[int, int] = (2, 6)) -> DataFrame:
    """V06 per (symbol, day, hour) over all days: the same reduction at a finer key."""
    hour = F.hour("event_time").alias("tick_hour")
    latest = latest_ticks(ticks, ("symbol", "date_partition", hour))
    return _live_columns(latest, ["symbol", "date_partition", "tick_hour"], tz, trading_dow)


def v_tick_history(ticks: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every tick of the day with its change from the previous close."""
    return ticks_of_day(ticks, as_of).select(
        "symbol",
        F.col("timestamp").alias("tick_time"),
        "price",
        "volume",
        pct_change("price", "prev_close").alias("change_pct"),
    )


VIEW_NAMES = (
    "v_daily_summary",
    "v_weekly_rollup",
    "v_top_movers",
    "v_rsi_signals",
    "v_bollinger_squeeze",
    "v_latest_ticks",
    "v_tick_history",
)


def register_views(spark: SparkSession, curated: DataFrame, ticks: DataFrame | None = None,
                   as_of: AsOf = None, week: str = "monday") -> list[str]:
    """Create-or-replace the views as session temp views, one by one."""
    views = {
        "v_daily_summary": v_daily_summary(curated),
        "v_weekly_rollup": v_weekly_rollup(curated, week),
        "v_top_movers": v_top_movers(curated),
        "v_rsi_signals": v_rsi_signals(curated),
        "v_bollinger_squeeze": v_bollinger_squeeze(curated),
    }
    if ticks is not None:
        views["v_latest_ticks"] = v_latest_ticks(ticks, as_of)
        views["v_tick_history"] = v_tick_history(ticks, as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def presentation(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sorted output for a client (O02/O04); kept out of the views themselves."""
    return df.orderBy(*order)
