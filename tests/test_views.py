"""Views and measures on the FIXTURES.md "views" and "ticks" cases."""

import datetime as dt

import pytest

from quantlake.plans import measures as M
from quantlake.plans import views as V

CUR = ("date date, symbol string, open double, high double, low double, close double, volume bigint, "
       "sma_20 double, sma_50 double, ema_20 double, rsi_14 double, macd_line double, macd_signal double, "
       "macd_hist double, bb_upper double, bb_mid double, bb_lower double")

TICKS = ("symbol string, timestamp string, price double, volume bigint, open double, high double, low double, "
         "prev_close double, event_time timestamp, date_partition date")


def cur_row(day, sym, o, c, rsi=50.0, up=None, lo=None, vol=10, hi=None, low=None):
    return (day, sym, o, hi if hi is not None else max(o, c), low if low is not None else min(o, c), c, vol,
            c, c, c, rsi, 0.0, 0.0, 0.0, up, c, lo)


def curated(spark, rows):
    return spark.createDataFrame(rows, CUR)


D = dt.date


def test_daily_change_and_zero_open(spark):
    df = curated(spark, [cur_row(D(2024, 1, 2), "A", 0.0, 5.0), cur_row(D(2024, 1, 2), "B", 8.0, 8.01)])
    out = {r["symbol"]: r for r in V.v_daily_summary(df).collect()}
    assert out["A"]["daily_change_pct"] is None
    assert out["B"]["daily_change_pct"] == 0.12
    assert out["B"]["trade_date"] == "2024-01-02"
    assert len(V.v_daily_summary(df).columns) == 14


def test_rsi_labels_at_thresholds(spark):
    rows = [cur_row(D(2024, 1, 2), s, 1.0, 1.0, rsi=v) for s, v in
            [("A", 70.0), ("B", 30.0), ("C", 69.999), ("D", 30.001), ("E", 100.0), ("F", 0.0)]]
    out = {r["symbol"]: r["rsi_signal"] for r in V.v_rsi_signals(curated(spark, rows)).collect()}
    assert out == {"A": "overbought", "B": "oversold", "C": "neutral", "D": "neutral",
                   "E": "overbought", "F": "oversold"}


def test_weekly_rollup_across_year_boundary(spark):
    days = [D(2024, 12, 30), D(2024, 12, 31), D(2025, 1, 2), D(2025, 1, 6)]
    rows = [cur_row(d, "A", 10.0 + i, 11.0 + i, vol=100 + i, hi=20.0 + i, low=1.0 + i) for i, d in enumerate(days)]
    out = {r["week_start"]: r for r in V.v_weekly_rollup(curated(spark, rows)).collect()}
    assert set(out) == {"2024-12-30", "2025-01-06"}
    w = out["2024-12-30"]
    assert (w["week_open"], w["week_close"], w["week_low"], w["week_high"], w["week_volume"]) == (10.0, 13.0, 1.0, 22.0, 303)
    sun = {r["week_start"] for r in V.v_weekly_rollup(curated(spark, rows), week="sunday").collect()}
    assert sun == {"2024-12-29", "2025-01-05"}


def test_top_movers_latest_day_only_and_symbol_missing(spark):
    rows = [cur_row(D(2024, 1, 2), "A", 10.0, 11.0), cur_row(D(2024, 1, 3), "B", 10.0, 9.0),
            cur_row(D(2024, 1, 3), "C", 10.0, 10.5)]
    out = {r["symbol"]: r for r in V.v_top_movers(curated(spark, rows)).collect()}
    assert set(out) == {"B", "C"}          # A has no bar on the latest day
    assert (out["B"]["change_pct"], out["B"]["abs_change_pct"]) == (-10.0, 10.0)


def test_top_n_ties_by_symbol(spark):
    rows = [cur_row(D(2024, 1, 3), s, 10.0, c) for s, c in [("Z", 11.0), ("A", 9.0), ("M", 10.5), ("B", 11.0)]]
    top = [r["symbol"] for r in M.top_n_movers(V.v_top_movers(curated(spark, rows)), 3).collect()]
    assert top == ["A", "B", "Z"]


def test_bollinger_squeeze_drops_first_row(spark):
    rows = [cur_row(D(2024, 1, 2), "A", 1.0, 1.0), cur_row(D(2024, 1, 3), "A", 1.0, 1.0, up=1.23456, lo=1.0)]
    out = V.v_bollinger_squeeze(curated(spark, rows)).collect()
    assert len(out) == 1 and out[0]["band_width"] == 0.2346


def ts(s):
    return dt.datetime.fromisoformat(s)


def tick(sym, when, price=10.0, volume=5, prev=8.0, o=None, h=None, lo=None):
    t = ts(when)
    return (sym, t.isoformat() + "+00:00", price, volume, o, h, lo, prev, t, t.date())


def ticks(spark, rows):
    return spark.createDataFrame(rows, TICKS)


@pytest.mark.parametrize(
    "when,volume,status",
    [
        ("2024-01-08 06:59:00", 5, "CLOSED"),   # Monday, before the window
        ("2024-01-08 07:00:00", 5, "LIVE"),
        ("2024-01-08 12:30:59", 5, "LIVE"),
        ("2024-01-08 12:31:00", 5, "CLOSED"),
        ("2024-01-08 10:00:00", 0, "CLOSED"),   # zero volume = heartbeat
        ("2024-01-08 10:00:00", None, "CLOSED"),
        ("2024-01-07 10:00:00", 5, "CLOSED"),   # Sunday
        ("2024-01-09 10:00:00", 5, "LIVE"),     # Tuesday
        ("2024-01-10 10:00:00", 5, "LIVE"),
        ("2024-01-11 10:00:00", 5, "LIVE"),
        ("2024-01-12 10:00:00", 5, "LIVE"),     # Friday
        ("2024-01-13 10:00:00", 5, "CLOSED"),   # Saturday
    ],
)
def test_market_status_window(spark, when, volume, status):
    out = V.v_latest_ticks(ticks(spark, [tick("A", when, volume=volume)]), as_of="latest").first()
    assert out["market_status"] == status


def test_sunday_to_thursday_preset(spark):
    t = ticks(spark, [tick("A", "2024-01-07 10:00:00")])
    assert V.v_latest_ticks(t, as_of="latest", trading_dow=(1, 5)).first()["market_status"] == "LIVE"


def test_latest_tick_fields_and_ties(spark):
    rows = [
        tick("A", "2024-01-08 10:00:00", price=10.0, prev=8.0, volume=None),
        tick("A", "2024-01-08 11:00:00", price=12.0, prev=8.0, h=13.0, lo=9.0, volume=3),
        tick("B", "2024-01-08 11:00:00", price=5.0, prev=0.0),
        tick("B", "2024-01-08 11:00:00", price=6.0, prev=0.0),       # equal timestamps: larger price wins
        tick("C", "2024-01-08 09:00:00", price=5.0, prev=None),
        tick("A", "2024-01-07 23:00:00", price=99.0),                 # previous day: not today
    ]
    out = {r["symbol"]: r for r in V.v_latest_ticks(ticks(spark, rows), as_of="2024-01-08").collect()}
    a = out["A"]
    assert (a["price"], a["open"], a["high"], a["low"], a["volume"]) == (12.0, 12.0, 13.0, 9.0, 3)
    assert a["change_pct"] == 50.0 and a["intraday_range_pct"] == 50.0
    assert out["B"]["price"] == 6.0 and out["B"]["change_pct"] is None      # prev_close 0
    assert out["C"]["change_pct"] is None and out["C"]["intraday_range_pct"] is None
    again = {r["symbol"]: r["price"] for r in V.v_latest_ticks(ticks(spark, rows).repartition(4), "2024-01-08").collect()}
    assert again == {"A": 12.0, "B": 6.0, "C": 5.0}


def test_tick_history_today_only(spark):
    rows = [tick("A", "2024-01-08 10:00:00"), tick("A", "2024-01-07 10:00:00")]
    out = V.v_tick_history(ticks(spark, rows), as_of="latest").collect()
    assert len(out) == 1 and out[0]["change_pct"] == 25.0


def test_live_measures_and_totals(spark):
    rows = [tick("A", "2024-01-08 10:00:00", price=10.0, prev=8.0, volume=5),
            tick("B", "2024-01-08 13:00:00", price=20.0, prev=25.0, volume=7)]
    latest = V.v_latest_ticks(ticks(spark, rows), as_of="latest")
    k = M.live_kpis(latest).first()
    assert (k["avg_change_pct"], k["total_price"], k["total_volume"], k["market_status"]) == (2.5, 30.0, 12, "LIVE")
    table = M.live_table_totals(latest).collect()
    assert [r["symbol"] for r in table] == ["A", "B", "Total"]
    total = table[-1]
    assert total["is_total"] and (total["price"], total["volume"], total["change_pct"]) == (30.0, 12, 2.5)


def test_symbol_kpis_latest_non_null(spark):
    rows = [cur_row(D(2024, 1, 2), "A", 10.0, 11.0, rsi=75.0, up=12.0, lo=10.0),
            cur_row(D(2024, 1, 3), "A", 11.0, 12.0, rsi=None, up=None, lo=None)]
    daily = V.v_daily_summary(curated(spark, rows))
    k = M.symbol_kpis(daily).first()
    assert (k["latest_close"], k["latest_rsi"], k["rsi_signal"]) == (12.0, 75.0, "Overbought")
    pos = M.bb_position(daily).first()["bb_position_pct"]
    assert pos == pytest.approx((12.0 - 10.0) / (12.0 - 10.0) * 100)


def test_bb_position_flat_band_is_blank(spark):
    rows = [cur_row(D(2024, 1, 2), "A", 10.0, 10.0, up=10.0, lo=10.0)]
    assert M.bb_position(V.v_daily_summary(curated(spark, rows))).first()["bb_position_pct"] is None


def test_market_kpis_and_counts_on_latest_day(spark):
    rows = [cur_row(D(2024, 1, 2), "A", 10.0, 11.0, rsi=80.0, vol=1),
            cur_row(D(2024, 1, 3), "A", 10.0, 11.0, rsi=20.0, vol=2),
            cur_row(D(2024, 1, 3), "B", 10.0, 9.0, rsi=50.0, vol=3)]
    cur = curated(spark, rows)
    daily = M.slice_date(V.v_daily_summary(cur))
    k = M.market_kpis(daily).first()
    assert (k["tracked_symbols"], k["total_volume"], k["avg_change_pct"]) == (2, 5, 0.0)
    c = M.rsi_counts(M.slice_date(V.v_rsi_signals(cur))).first()
    assert (c["overbought_count"], c["oversold_count"], c["neutral_count"]) == (0, 1, 1)
    score = M.market_risk_score(M.slice_date(V.v_rsi_signals(cur))).first()["risk_score"]
    assert score == 30.0
    hl = {r["symbol"]: (r["high_52w"], r["low_52w"]) for r in M.high_low_52w(V.v_daily_summary(cur)).collect()}
    assert hl["A"] == (11.0, 10.0)


def test_register_views_and_query_by_name(spark):
    from quantlake.sources.catalog import query_view

    rows = [cur_row(D(2024, 1, 2), "A", 10.0, 11.0, up=12.0, lo=9.0)]
    t = ticks(spark, [tick("A", "2024-01-08 10:00:00")])
    names = V.register_views(spark, curated(spark, rows), t, as_of="latest")
    assert names == list(V.VIEW_NAMES)
    assert query_view(spark, "v_daily_summary").count() == 1
    assert query_view(spark, "v_latest_ticks").first()["market_status"] == "LIVE"
    assert spark.sql("SELECT count(*) AS n FROM v_weekly_rollup").first()["n"] == 1


def test_dashboard_listing_orders(spark):
    """The sort orders of the dashboard listings, ties broken by symbol."""
    day = D(2024, 1, 3)
    rows = [cur_row(day, "C", 10.0, 11.0, vol=5, up=14.0, lo=10.0),
            cur_row(day, "A", 10.0, 9.0, vol=7, up=12.0, lo=10.0),
            cur_row(day, "B", 10.0, 11.0, vol=7, up=11.0, lo=10.0)]
    cur = curated(spark, rows)
    daily = V.v_daily_summary(cur)
    assert [r["symbol"] for r in M.volume_by_symbol(daily).collect()] == ["A", "B", "C"]       # volume desc
    assert [r["symbol"] for r in M.change_ranking(daily).collect()] == ["A", "B", "C"]         # change asc
    assert [r["direction"] for r in M.change_ranking(daily).collect()] == ["loss", "gain", "gain"]
    assert [r["symbol"] for r in M.market_summary(daily).collect()] == ["B", "C", "A"]         # change desc
    assert [r["symbol"] for r in M.band_width_rank(V.v_bollinger_squeeze(cur)).collect()] == ["C", "A", "B"]
    t = ticks(spark, [tick("B", "2024-01-08 10:00:00"), tick("A", "2024-01-08 11:00:00"),
                      tick("A", "2024-01-08 09:00:00")])
    hist = V.presentation(V.v_tick_history(t, "2024-01-08"), "symbol", "tick_time").collect()
    assert [(r["symbol"], r["tick_time"][11:13]) for r in hist] == [("A", "09"), ("A", "11"), ("B", "10")]
