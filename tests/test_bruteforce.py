"""Spark operators against plain Python/pandas brute force on random small fixtures."""

import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest

from quantlake.operators.cleaning import clean
from quantlake.operators.indicators import add_all_indicators
from quantlake.plans import measures as M
from quantlake.plans import views as V

BARS = "date date, symbol string, open double, high double, low double, close double, volume bigint"


def brute_indicators(closes):
    s = pd.Series(closes, dtype="float64")
    mean = lambda n: s.rolling(n, min_periods=1).mean()
    delta = s.diff()
    gain = delta.where(delta > 0, 0.0)
    loss = (-delta).where(delta < 0, 0.0)
    ag, al = gain.rolling(14, min_periods=1).mean(), loss.rolling(14, min_periods=1).mean()
    rsi = pd.Series([100.0 if l == 0 else 100.0 - 100.0 / (1.0 + g / l) for g, l in zip(ag, al)])
    macd = mean(12) - mean(26)
    signal = macd.rolling(9, min_periods=1).mean()
    sd = s.rolling(20, min_periods=2).std(ddof=1)
    mid = mean(20)
    return {
        "sma_20": mean(20), "sma_50": mean(50), "ema_20": mean(20), "rsi_14": rsi, "macd_line": macd,
        "macd_signal": signal, "macd_hist": macd - signal, "bb_mid": mid, "bb_upper": mid + 2 * sd,
        "bb_lower": mid - 2 * sd,
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_indicator_bundle_vs_pandas(spark, seed):
    rnd = random.Random(seed)
    rows, series = [], {}
    for s in range(4):
        day, px, closes = 0, 50.0, []
        for _ in range(rnd.randint(1, 180)):
            day += rnd.choice([1, 1, 2, 5])
            px = max(0.5, px + rnd.uniform(-3, 3))
            c = round(px, 4)
            closes.append(c)
            rows.append((dt.date(2020, 1, 1) + dt.timedelta(days=day), f"S{s}", c, c, c, c, 1))
        series[f"S{s}"] = closes
    out = add_all_indicators(spark.createDataFrame(rows, BARS)).orderBy("symbol", "date").collect()
    by_sym = {}
    for r in out:
        by_sym.setdefault(r["symbol"], []).append(r)
    for sym, closes in series.items():
        expect = brute_indicators(closes)
        got = by_sym[sym]
        assert len(got) == len(closes)
        for col, values in expect.items():
            for i, v in enumerate(values):
                g = got[i][col]
                if v is None or (isinstance(v, float) and math.isnan(v)):
                    assert g is None, (sym, col, i)
                else:
                    assert g == pytest.approx(v, rel=1e-9, abs=1e-9), (sym, col, i)


def r4(x):
    """HALF_UP to 4 dp on the shortest decimal text of the double (Spark's ``round``)."""
    return None if x is None else float(Decimal(repr(x)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP))


def brute_clean(rows):
    """The cleaning rules applied row by row; de-dup keeps the greatest row content."""
    kept = {}
    for d, sym, o, h, lo, c, v, run in rows:
        if sym is None or d is None or c is None or math.isnan(c) or v is None:
            continue
        if not c > 0 or not v >= 0:
            continue
        try:
            day = dt.date.fromisoformat(d)
        except ValueError:
            continue
        rec = (r4(o), r4(h), r4(lo), r4(c), v, run)
        key = (sym, day)
        if key not in kept or rec > kept[key]:
            kept[key] = rec
    return kept


def test_clean_vs_python(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(400):
        d = rnd.choice(["2024-01-0%d" % rnd.randint(1, 9), None, "bad"])
        sym = rnd.choice(["A", "B", None])
        c = rnd.choice([round(rnd.uniform(-2, 10), 5), None, float("nan"), 0.0])
        v = rnd.choice([rnd.randint(-5, 50), None])
        o, h, lo = (round(rnd.uniform(0, 10), 5) for _ in range(3))
        rows.append((d, sym, o, h, lo, c, v, rnd.choice(["r1", "r2"])))
    df = spark.createDataFrame(rows, "date string, symbol string, open double, high double, low double, "
                                     "close double, volume bigint, date_partition string")
    got = {(r["symbol"], r["date"]): (r["open"], r["high"], r["low"], r["close"], r["volume"], r["date_partition"])
           for r in clean(df, "2024-02-02 00:00:00").collect()}
    assert got == brute_clean(rows)


def test_high_low_lookback(spark):
    rows = [(dt.date(2023, 1, 1), "A", 1.0, 99.0, 0.1, 1.0, 1), (dt.date(2024, 1, 1), "A", 1.0, 5.0, 0.5, 1.0, 1),
            (dt.date(2024, 6, 1), "A", 1.0, 6.0, 0.7, 1.0, 1)]
    cur = spark.createDataFrame(rows, BARS)
    for c in ("sma_20", "sma_50", "rsi_14", "macd_line", "bb_upper", "bb_lower"):
        cur = cur.withColumn(c, cur["close"])
    daily = V.v_daily_summary(cur)
    assert tuple(M.high_low_52w(daily).first()[1:]) == (99.0, 0.1)
    assert tuple(M.high_low_52w(daily, lookback_days=364).first()[1:]) == (6.0, 0.5)
