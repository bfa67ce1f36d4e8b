"""Column expressions shared by views, measures and jobs.

All of them are built-in Spark expressions (codegen, no Python at run time).
Data-dependent denominators use ``try_divide`` so that ANSI mode (on by
default in Spark 4) yields NULL rather than failing the query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that define the reference's results --------------------
RSI_OVERBOUGHT = 70.0
RSI_OVERSOLD = 30.0
RSI_LABELS = ("overbought", "oversold", "neutral")          # view labels
RSI_CARD_LABELS = ("Overbought", "Oversold", "Neutral")     # KPI card labels
MARKET_OPEN_UTC_MIN = 7 * 60          # 07:00 UTC
MARKET_CLOSE_UTC_MIN = 12 * 60 + 30   # 12:30 UTC, inclusive
TRADING_DOW = (2, 6)                  # Spark dayofweek, 1 = Sunday: Monday..Friday
TRADING_DOW_SUN_THU = (1, 5)          # preset for a Sunday..Thursday exchange week
LIVE, CLOSED = "LIVE", "CLOSED"
# ---------------------------------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct_change(new: Column | str, base: Column | str, scale: int | None = 2) -> Column:
    """round((new - base) / base * 100, scale); NULL when base is 0 or NULL."""
    new, base = _c(new), _c(base)
    v = F.try_divide(new - base, base) * F.lit(100)
    return F.round(v, scale) if scale is not None else v


def rsi_label(rsi: Column | str, labels: tuple[str, str, str] = RSI_LABELS,
              hi: float = RSI_OVERBOUGHT, lo: float = RSI_OVERSOLD) -> Column:
    rsi = _c(rsi)
    return (
        F.when(rsi >= hi, F.lit(labels[0]))
        .when(rsi <= lo, F.lit(labels[1]))
        .otherwise(F.lit(labels[2]))
    )


def week_start(d: Column | str, start: str = "monday") -> Column:
    """First day of the week containing ``d`` (DATE). ``start`` is monday or sunday."""
    d = _c(d)
    if start == "monday":
        return F.trunc(d, "week")
    if start == "sunday":
        return F.date_sub(F.trunc(F.date_add(d, 1), "week"), 1)
    raise ValueError(f"week start must be monday or sunday, not {start!r}")


def market_status(
    event_time: Column | str,
    volume: Column | str,
    tz: str = "UTC",
    open_min: int = MARKET_OPEN_UTC_MIN,
    close_min: int = MARKET_CLOSE_UTC_MIN,
    trading_dow: tuple[int, int] = TRADING_DOW,
) -> Column:
    """LIVE when minute-of-day is within [open, close], weekday in range and volume > 0.

    ``event_time`` is an instant, read on the clock of ``tz`` whatever the session time zone is.
    """
    t = _c(event_time)
    if tz != "UTC":
        t = F.from_utc_timestamp(t, tz)  # shifts the instant, so that its UTC reading is the clock of ``tz``
    minute_of_day = F.pmod(F.floor(F.unix_seconds(t) / 60), F.lit(1440))
    live = (
        minute_of_day.between(open_min, close_min)
        & F.dayofweek(utc_day(t)).between(trading_dow[0], trading_dow[1])
        & (F.coalesce(_c(volume), F.lit(0)) > 0)
    )
    return F.when(live, F.lit(LIVE)).otherwise(F.lit(CLOSED))


def utc_day(ts: Column | str) -> Column:
    """The UTC date of an instant, whatever the session time zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_c(ts)) / 86400).cast("int"))


def utc_instant(text: Column | str) -> Column:
    """ISO-8601 text as an instant; text without an offset is UTC. NULL if it can't be read."""
    text = _c(text)
    bare = text.rlike(r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{1,2}:[0-9:.]*\s*$")
    return F.try_to_timestamp(F.when(bare, F.concat(F.trim(text), F.lit("Z"))).otherwise(text))


def iso_timestamp(ts: Column | str) -> Column:
    """ISO-8601 text of an instant in UTC, with microseconds and the offset, as the tick feed sends."""
    ts = _c(ts).cast("timestamp")
    seconds = F.pmod(F.unix_seconds(ts), F.lit(86400))
    # one number whose digits, behind a leading 1, are hhmmss
    clock = (F.lit(1000000) + F.floor(seconds / 3600) * 10000 + F.floor(F.pmod(seconds, F.lit(3600)) / 60) * 100 + F.pmod(seconds, F.lit(60))).cast("string")
    micros = (F.lit(1000000) + F.pmod(F.unix_micros(ts), F.lit(1000000))).cast("string")
    return F.concat(
        utc_day(ts).cast("string"), F.lit("T"), F.substring(clock, 2, 2), F.lit(":"), F.substring(clock, 4, 2), F.lit(":"), F.substring(clock, 6, 2),
        F.lit("."), F.substring(micros, 2, 6), F.lit("+00:00"))


def topic_for(symbol: Column | str, prefix: str) -> Column:
    """Kafka topic per symbol: ``<prefix>.<symbol lower-cased, dots as underscores>``."""
    return F.concat(F.lit(prefix + "."), F.lower(F.replace(_c(symbol), F.lit("."), F.lit("_"))))


def stable_round(x: Column | str, scale: int = 4) -> Column:
    """Round an averaged double so that summation-order noise cannot flip the last digit.

    Goes through DECIMAL(38,12) first (absorbs 1-ulp differences), then HALF_UP.
    Used for published indicator values, where two engines summing a window in
    different orders must still agree.
    """
    return F.round(_c(x).cast("decimal(38,12)"), scale).cast("double")
