"""Dashboard datasets and KPI measures.

A measure is a filter (the page slicer) followed by one aggregation; per-symbol
cards are evaluated for every symbol at once with ``groupBy("symbol")``.
"Latest" values use ``max_by(value, date)`` over rows where the value is not
NULL (D14), a partial+final aggregate rather than a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.functions.exprs import LIVE, CLOSED, RSI_CARD_LABELS, rsi_label
from quantlake.operators.ranking import with_place
from quantlake.plans.views import presentation

TOTAL_LABEL = "Total"


# ---- slicers (C15) --------------------------------------------------------

def slice_date(df: DataFrame, day=None, col: str = "trade_date", latest_from: DataFrame | None = None) -> DataFrame:
    """One trading day; ``None`` = the latest day of the page (the slicer default).

    The slicer is page-level: ``latest_from`` is the frame whose latest day the
    page defaults to (e.g. the daily summary for a page that also shows RSI
    signals); by default ``df`` itself. Reading it from plain bars lets Catalyst
    prune window columns out of the scalar subquery.
    """
    if day is not None:
        value = F.lit(str(day))
    else:
        value = (latest_from if latest_from is not None else df).agg(F.max(col)).scalar()
    return df.filter(F.col(col) == value)


def slice_symbols(df: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    """One or many symbols; ``None`` or empty = whole market."""
    return df if not symbols else df.filter(F.col("symbol").isin(list(symbols)))


def _latest(col: str, by: str = "trade_date") -> Column:
    """LASTNONBLANK by date: the value on the latest date where it is not NULL."""
    return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(by)))


# ---- market overview ------------------------------------------------------

def market_kpis(daily: DataFrame) -> DataFrame:
    """M01 (A04, A05): tracked symbols, total volume, average daily change."""
    return daily.agg(
        F.countDistinct("symbol").alias("tracked_symbols"),
        F.sum("volume").alias("total_volume"),
        F.avg("daily_change_pct").alias("avg_change_pct"),
    )


def rsi_counts(signals: DataFrame) -> DataFrame:
    """M02 (A06): overbought / oversold / neutral counts in one pass."""
    s = F.col("rsi_signal")
    return signals.agg(
        F.count_if(s == "overbought").alias("overbought_count"),
        F.count_if(s == "oversold").alias("oversold_count"),
        F.count_if(s == "neutral").alias("neutral_count"),
    )


def rsi_distribution(signals: DataFrame) -> DataFrame:
    """Symbols per signal."""
    return signals.groupBy("rsi_signal").agg(F.count(F.lit(1)).alias("symbols"))


def volume_by_symbol(daily: DataFrame) -> DataFrame:
    """Volume per symbol, largest first."""
    agg = daily.groupBy("symbol").agg(F.sum("volume").alias("total_volume"))
    return presentation(agg, F.desc("total_volume"), "symbol")


def change_ranking(daily: DataFrame) -> DataFrame:
    """Daily change per symbol with a gain / loss flag, smallest change first."""
    out = daily.select(
        "symbol",
        "daily_change_pct",
        F.when(F.col("daily_change_pct") < 0, F.lit("loss")).otherwise(F.lit("gain")).alias("direction"),
    )
    return presentation(out, "daily_change_pct", "symbol")


def market_summary(daily: DataFrame) -> DataFrame:
    """The summary grid, largest change first."""
    out = daily.select("symbol", "open", "close", "daily_change_pct", "volume")
    return presentation(out, F.desc("daily_change_pct"), "symbol")


# ---- symbol detail --------------------------------------------------------

def symbol_kpis(daily: DataFrame) -> DataFrame:
    """M07 (A07, F20): latest close, change and RSI per symbol, with the RSI card label."""
    agg = daily.groupBy("symbol").agg(
        _latest("close").alias("latest_close"),
        _latest("daily_change_pct").alias("latest_change_pct"),
        _latest("rsi_14").alias("latest_rsi"),
    )
    return agg.withColumn("rsi_signal", rsi_label("latest_rsi", RSI_CARD_LABELS))


def high_low_52w(daily: DataFrame, lookback_days: int | None = None) -> DataFrame:
    """High / low per symbol over all history (D15) or the last ``lookback_days``."""
    src = daily
    if lookback_days is not None:
        last = daily.agg(F.max(F.col("trade_date").cast("date"))).scalar()
        src = daily.filter(F.col("trade_date").cast("date") >= F.date_sub(last, lookback_days))
    return src.groupBy("symbol").agg(F.max("high").alias("high_52w"), F.min("low").alias("low_52w"))


def bb_position(daily: DataFrame) -> DataFrame:
    """M09 (F19): (latest close - lower) / (upper - lower) * 100, blank when the band is flat."""
    agg = daily.groupBy("symbol").agg(
        _latest("close").alias("latest_close"),
        _latest("bb_upper").alias("latest_bb_upper"),
        _latest("bb_lower").alias("latest_bb_lower"),
    )
    pos = F.try_divide(
        F.col("latest_close") - F.col("latest_bb_lower"),
        F.col("latest_bb_upper") - F.col("latest_bb_lower"),
    ) * F.lit(100)
    return agg.select("symbol", pos.alias("bb_position_pct"))


SERIES_COLS = ("close", "sma_20", "sma_50", "bb_upper", "bb_lower", "macd_line", "rsi_14")


def symbol_series(daily: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """The chart series of the symbol page (price, SMAs, bands, MACD, RSI)."""
    return slice_symbols(daily, symbols).select("symbol", "trade_date", *SERIES_COLS)


def volume_history(daily: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Volume per symbol and day."""
    return slice_symbols(daily, symbols).groupBy("symbol", "trade_date").agg(F.sum("volume").alias("volume"))


# ---- signals and risk -----------------------------------------------------

def rsi_screen(signals: DataFrame) -> DataFrame:
    """RSI table with the 70 / 30 reference flags."""
    return signals.select(
        "symbol",
        "close",
        "rsi_14",
        "rsi_signal",
        (F.col("rsi_14") >= 70).alias("above_70"),
        (F.col("rsi_14") <= 30).alias("below_30"),
    )


#: The orders of the dashboard's listings
LISTINGS = {
    "volume": ("total_volume", "desc"),
    "losers": ("daily_change_pct", "asc"),
    "movers": ("daily_change_pct", "desc"),
    "widest": ("band_width", "desc"),
    "narrowest": ("band_width", "asc"),
    "symbols": ("symbol", "asc"),
}


def placed(listing: DataFrame, order: str) -> DataFrame:
    """A listing with each row's place in one of LISTINGS, ties by symbol; ranked in ranges, not in one task."""
    column, way = LISTINGS[order]
    return with_place(listing, [F.desc(column) if way == "desc" else F.asc(column), "symbol"])


def band_width_rank(squeeze: DataFrame) -> DataFrame:
    """Widest bands first."""
    return presentation(squeeze.select("symbol", "close", "band_width"), F.desc("band_width"), "symbol")


def risk_scatter(daily: DataFrame) -> DataFrame:
    """RSI x daily change, sized by volume."""
    return daily.select("symbol", "rsi_14", "daily_change_pct", "volume")


def market_risk_score(signals: DataFrame) -> DataFrame:
    """M15 (A08): sum of |RSI - 50| (no fixed maximum is claimed, D20)."""
    return signals.agg(F.sum(F.abs(F.col("rsi_14") - 50)).alias("risk_score"))


def top_n_movers(movers: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest absolute moves, ties by symbol (TakeOrderedAndProject)."""
    return movers.orderBy(F.desc("abs_change_pct"), "symbol").limit(n)


# ---- live ticks -----------------------------------------------------------

def live_kpis(latest: DataFrame) -> DataFrame:
    """M16 (A09): average change, summed price and volume, LIVE if any symbol is live."""
    return latest.agg(
        F.avg("change_pct").alias("avg_change_pct"),
        F.sum("price").alias("total_price"),
        F.sum("volume").alias("total_volume"),
        F.when(F.bool_or(F.col("market_status") == LIVE), F.lit(LIVE)).otherwise(F.lit(CLOSED)).alias(
            "market_status"
        ),
    )


def live_table_totals(latest: DataFrame) -> DataFrame:
    """M17 (A10): the ticker table plus a totals row (rollup); totals sum price/volume, average percentages."""
    agg = latest.rollup("symbol").agg(
        F.sum("price").alias("price"),
        F.avg("change_pct").alias("change_pct"),
        F.sum("volume").alias("volume"),
        F.avg("intraday_range_pct").alias("intraday_range_pct"),
        F.grouping("symbol").alias("_g"),
    )
    out = agg.select(
        F.when(F.col("_g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("symbol")).alias("symbol"),
        (F.col("_g") == 1).alias("is_total"),
        "price",
        "change_pct",
        "volume",
        "intraday_range_pct",
    )
    return presentation(out, "is_total", "symbol")


def intraday_series(history: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Price by tick time for the selected symbols."""
    return slice_symbols(history, symbols).select("symbol", "tick_time", "price")
