"""Vendor "wide" history -> long OHLCV rows (S15, S2.7).

A download of several tickers at once arrives as one row per date with a
column group per ticker (``<SYM>_Open``, ``<SYM>_High``, ``<SYM>_Low``,
``<SYM>_Close``, ``<SYM>_Volume``) and a capitalised ``Date``. The reshape is a
single ``stack`` projection: narrow, no shuffle, one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.operators.cleaning import parse_date

FIELDS = (("open", "Open"), ("high", "High"), ("low", "Low"), ("close", "Close"), ("volume", "Volume"))


class EmptyHistoryError(RuntimeError):
    """No ticker of the requested universe had any data."""


def column_symbols(wide: DataFrame) -> list[str]:
    """Every symbol that has at least one column group field, in column order."""
    ends = tuple(f"_{suffix}" for _, suffix in FIELDS)
    return list(dict.fromkeys(c.rsplit("_", 1)[0] for c in wide.columns if c.endswith(ends)))


def normalize_wide(wide: DataFrame, symbols: Sequence[str] | None = None, date_col: str = "Date") -> DataFrame:
    """Long rows ``date, symbol, open, high, low, close, volume``; a plan only, no job runs here.

    ``symbols``: the requested tickers; ``None`` = every one that the columns name. Tickers without any
    column group are skipped (the vendor returned nothing for them); a missing single field becomes
    NULL. None of the requested present raises ``EmptyHistoryError``; a history without rows is
    found by the landing job, which counts what it writes.
    """
    there = column_symbols(wide)
    wanted = there if symbols is None else [s for s in dict.fromkeys(symbols) if s in set(there)]
    if not wanted:
        raise EmptyHistoryError("none of the requested symbols is present")
    cols = set(wide.columns)

    def field(sym: str, suffix: str, dtype: str):
        name = f"{sym}_{suffix}"
        return F.col(f"`{name}`").try_cast(dtype) if name in cols else F.lit(None).cast(dtype)

    def group(sym: str):
        values = [field(sym, suffix, "bigint" if long == "volume" else "double").alias(long) for long, suffix in FIELDS]
        return F.struct(F.lit(sym).alias("symbol"), *values)

    out = wide.select(F.col(date_col).alias("date"), F.inline(F.array(*[group(s) for s in wanted])))
    return parse_date(out, "date").select("date", "symbol", *[long for long, _ in FIELDS])
