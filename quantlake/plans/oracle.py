"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code, from the same semantics. Two
rounding helpers keep both engines on the same digits:

* ``SR(x, d)`` reproduces Spark's ``round`` on a DOUBLE: HALF_UP applied to the
  shortest decimal text of the value (DuckDB's own ``round`` on DOUBLE works on
  the binary value, so 1.005 would go down instead of up);
* ``ST(x, d)`` is ``stable_round``: the decimal text rounded to 12 dp first, then
  HALF_UP to ``d``, for means whose last bits depend on summation order.
"""

from __future__ import annotations


def SR(x: str, d: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


def ST(x: str, d: int = 4) -> str:
    return f"CAST(round(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 12), {d}) AS DOUBLE)"


def _with(*ctes: tuple[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in ctes) + "\n" + body


# ---- adapters -------------------------------------------------------------

def E(price: str = "value") -> str:
    return f"""SELECT CAST(ts AS DATE) AS date, event_type AS symbol,
       arg_min({price}, row(ts, event_id)) AS open, max({price}) AS high, min({price}) AS low,
       arg_max({price}, row(ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY 1, 2"""


_TORD = "row(l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_quantity, l.l_partkey, l.l_suppkey)"
_TPX = "(l.l_extendedprice / l.l_quantity)"
T = f"""SELECT CAST(l.l_shipdate AS DATE) AS date, p.p_brand AS symbol,
       arg_min({_TPX}, {_TORD}) AS open, max({_TPX}) AS high, min({_TPX}) AS low,
       arg_max({_TPX}, {_TORD}) AS close, CAST(sum(l.l_quantity) AS BIGINT) AS volume
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2"""

D_CTES = (
    ("e3", E("value / 3.0")),
    ("dh", "SELECT *, date_diff('day', DATE '2024-01-01', date) AS h FROM e3"),
    (
        "dd",
        """SELECT date, symbol, open, high, low,
       CASE WHEN h % 13 = 0 THEN NULL WHEN h % 17 = 0 THEN -close ELSE close END AS close,
       CASE WHEN h % 19 = 0 THEN -volume ELSE volume END AS volume, h
FROM dh""",
    ),
    (
        "d",
        """SELECT date, symbol, open, high, low, close, volume,
       CAST(DATE '2024-02-01' AS VARCHAR) AS date_partition FROM dd
UNION ALL
SELECT date, symbol, open, high, low, close, volume,
       CAST(DATE '2024-02-01' + 1 AS VARCHAR) AS date_partition FROM dd WHERE h % 7 = 0""",
    ),
)

K_CTES = (
    ("eb", E()),
    ("kb", "SELECT symbol, date, open, high, low, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM eb"),
    (
        "k",
        """SELECT ev.event_type AS symbol,
       strftime(ev.ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       ev.value AS price,
       TRY_CAST(json_extract_string(ev.props, '$.k') AS BIGINT) AS volume,
       CASE WHEN ev.event_id % 5 = 0 THEN NULL ELSE kb.open END AS open,
       CASE WHEN ev.event_id % 5 = 0 THEN NULL ELSE kb.high END AS high,
       CASE WHEN ev.event_id % 5 = 0 THEN NULL ELSE kb.low END AS low,
       kb.prev_close,
       ev.ts AS event_time,
       CAST(ev.ts AS DATE) AS date_partition
FROM events ev JOIN kb ON kb.symbol = ev.event_type AND kb.date = CAST(ev.ts AS DATE)""",
    ),
)

# cleaning (C01-C08) of the dirty bars, each run on its own, fixed ingestion stamp
_CLEANED = f"""SELECT date, symbol, {SR('open', 4)} AS open, {SR('high', 4)} AS high,
       {SR('low', 4)} AS low, {SR('close', 4)} AS close, volume, date_partition,
       CAST(TIMESTAMP '2024-02-02 00:00:00' AS VARCHAR) AS ingested_at
FROM d
WHERE symbol IS NOT NULL AND date IS NOT NULL AND close IS NOT NULL AND NOT isnan(close)
  AND volume IS NOT NULL AND close > 0 AND volume >= 0"""

_NEWEST = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY date_partition DESC) AS rn FROM {src}
) WHERE rn = 1"""


# ---- indicators -----------------------------------------------------------

def _w(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def IND_CTES(src: str, prefix: str = "i") -> tuple[tuple[str, str], ...]:
    """The indicator bundle over bars CTE ``src``; the last CTE is ``<prefix>_ind``."""
    p = prefix
    return (
        (f"{p}_l1", f"SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM {src}"),
        (
            f"{p}_l2",
            f"""SELECT *,
       CASE WHEN close - prev_close > 0 THEN close - prev_close ELSE 0.0 END AS gain,
       CASE WHEN close - prev_close < 0 THEN -(close - prev_close) ELSE 0.0 END AS loss
FROM {p}_l1""",
        ),
        (
            f"{p}_l3",
            f"""SELECT *,
       avg(close) OVER {_w(20)} AS sma_20,
       avg(close) OVER {_w(50)} AS sma_50,
       avg(close) OVER {_w(20)} AS ema_20,
       avg(gain) OVER {_w(14)} AS avg_gain,
       avg(loss) OVER {_w(14)} AS avg_loss,
       avg(close) OVER {_w(12)} - avg(close) OVER {_w(26)} AS macd_line,
       avg(close) OVER {_w(20)} AS bb_mid,
       stddev_samp(close) OVER {_w(20)} AS sd
FROM {p}_l2""",
        ),
        (
            f"{p}_l4",
            f"""SELECT *,
       CASE WHEN avg_loss = 0 THEN CAST(100.0 AS DOUBLE)
            ELSE CAST(100.0 AS DOUBLE) - CAST(100.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + avg_gain / avg_loss) END AS rsi_14,
       avg(macd_line) OVER {_w(9)} AS macd_signal
FROM {p}_l3""",
        ),
        (
            f"{p}_ind",
            f"""SELECT *, macd_line - macd_signal AS macd_hist,
       bb_mid + 2.0 * sd AS bb_upper, bb_mid - 2.0 * sd AS bb_lower
FROM {p}_l4""",
        ),
    )


IND_COLS = ("sma_20", "sma_50", "ema_20", "rsi_14", "macd_line", "macd_signal", "macd_hist",
            "bb_upper", "bb_mid", "bb_lower")


def _ind_select(src: str, extra: str = "") -> str:
    cols = ", ".join(f"{ST(c)} AS {c}" for c in IND_COLS)
    return f"SELECT date, symbol, open, high, low, close, volume, {cols}{extra} FROM {src}"


def _chg(new: str, base: str) -> str:
    return SR(f"(({new} - {base}) / NULLIF({base}, 0)) * 100", 2)


TI = (("t", T),) + IND_CTES("t")

V01 = f"""SELECT symbol, CAST(date AS VARCHAR) AS trade_date, open, high, low, close, volume,
       {_chg('close', 'open')} AS daily_change_pct,
       sma_20, sma_50, rsi_14, macd_line, bb_upper, bb_lower
FROM i_ind"""

V04 = """SELECT symbol, CAST(date AS VARCHAR) AS trade_date, close, rsi_14,
       CASE WHEN rsi_14 >= 70 THEN 'overbought' WHEN rsi_14 <= 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal
FROM i_ind WHERE rsi_14 IS NOT NULL"""

V05 = f"""SELECT symbol, CAST(date AS VARCHAR) AS trade_date, close, bb_upper, bb_lower,
       {SR('bb_upper - bb_lower', 4)} AS band_width
FROM i_ind WHERE bb_upper IS NOT NULL"""

V03 = f"""SELECT symbol, CAST(date AS VARCHAR) AS trade_date, open, close,
       {_chg('close', 'open')} AS change_pct, abs({_chg('close', 'open')}) AS abs_change_pct
FROM i_ind WHERE date = (SELECT max(date) FROM i_ind)"""

DAILY = TI + (("v01", V01), ("sl", "SELECT * FROM v01 WHERE trade_date = (SELECT max(trade_date) FROM v01)"))
# page slicer default: the latest day of the page's data (the daily summary)
SIGNALS = TI + (("v04", V04), ("rsl", "SELECT * FROM v04 WHERE trade_date = (SELECT CAST(max(date) AS VARCHAR) FROM i_ind)"))


def _latest(col: str, by: str = "trade_date") -> str:
    return f"arg_max({col}, CASE WHEN {col} IS NOT NULL THEN {by} END)"


# ---- ticks ----------------------------------------------------------------

_STATUS = """CASE WHEN hour(event_time) * 60 + minute(event_time) BETWEEN 420 AND 750
           AND dayofweek(event_time) + 1 BETWEEN 2 AND 6
           AND COALESCE(volume, 0) > 0 THEN 'LIVE' ELSE 'CLOSED' END"""


def _live(src: str, keys: str) -> str:
    return f"""SELECT {keys}, timestamp AS tick_time, price, COALESCE(volume, 0) AS volume,
       COALESCE(open, price) AS open, COALESCE(high, price) AS high, COALESCE(low, price) AS low,
       prev_close, {_chg('price', 'prev_close')} AS change_pct,
       {SR('((COALESCE(high, price) - COALESCE(low, price)) / NULLIF(prev_close, 0)) * 100', 2)} AS intraday_range_pct,
       {_STATUS} AS market_status
FROM {src}"""


KD = K_CTES + (("kd", "SELECT * FROM k WHERE date_partition = (SELECT max(date_partition) FROM k)"),)
LATEST = KD + (
    (
        "lt",
        """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC) AS rn FROM kd
) WHERE rn = 1""",
    ),
    ("v06", _live("lt", "symbol")),
)
V07 = f"SELECT symbol, timestamp AS tick_time, price, volume, {_chg('price', 'prev_close')} AS change_pct FROM kd"

_TICK_COLS = "symbol, timestamp, price, volume, open, high, low, prev_close, event_time, date_partition"
_JSON = ("to_json({'symbol': symbol, 'timestamp': timestamp, 'price': price, 'volume': volume, "
         "'open': open, 'high': high, 'low': low, 'prev_close': prev_close})")

_RAW_COLS = "date, symbol, open, high, low, close, volume"
LAKE = D_CTES + (("cl", _CLEANED), ("cn", _NEWEST.format(src="cl"))) + IND_CTES("cn")


# three overlapping runs of E, the last with late corrections of one symbol; the newest run of a bar counts
RUNS = (
    ("e", E()),
    ("eo", "SELECT *, date_diff('day', DATE '2024-01-01', date) AS off FROM e"),
    ("er", """SELECT *, '2024-03-01' AS date_partition FROM eo WHERE off <= 17
UNION ALL SELECT *, '2024-03-02' FROM eo WHERE off BETWEEN 15 AND 23
UNION ALL SELECT * REPLACE (CASE WHEN off < 3 THEN close * 2 ELSE close END AS close), '2024-03-03' FROM eo
  WHERE off > 20 OR (off < 3 AND symbol = 'click')"""),
    ("d", "SELECT * EXCLUDE (off) FROM er"),
    ("cl", _CLEANED),
    ("cn", _NEWEST.format(src="cl")),
    # what the last run does to each symbol: bars of it that differ from those before, and where they lie
    ("bf", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY date_partition DESC) AS rn FROM cl "
           "WHERE date_partition < '2024-03-03') WHERE rn = 1"),
    ("df", """SELECT n.symbol, n.date FROM cl n LEFT JOIN bf o ON o.symbol = n.symbol AND o.date = n.date WHERE n.date_partition = '2024-03-03'
  AND row(n.open, n.high, n.low, n.close, n.volume) IS DISTINCT FROM row(o.open, o.high, o.low, o.close, o.volume)"""),
    ("kinds", "SELECT symbol, coalesce(min(date) <= (SELECT max(date) FROM bf WHERE bf.symbol = df.symbol), true) AS anew FROM df GROUP BY symbol"),
) + IND_CTES("cn")

ORACLE_SQL: dict[str, str] = {
    # sources
    "raw_partition_scan": _with(
        ("e", E()), body=f"SELECT {_RAW_COLS}, CAST(date AS VARCHAR) AS date_partition FROM e "
                         "WHERE date = (SELECT max(date) FROM e)"
    ),
    "universe_filter": _with(
        ("e", E()), body=f"SELECT {_RAW_COLS} FROM e WHERE symbol IN ('click', 'purchase', 'view', 'refund')"
    ),
    "normalize_wide": _with(("e", E()), body=f"SELECT {_RAW_COLS} FROM e"),
    # cleaning
    "clean_dropna": _with(
        *D_CTES,
        body="SELECT * FROM d WHERE symbol IS NOT NULL AND date IS NOT NULL AND close IS NOT NULL "
             "AND NOT isnan(close) AND volume IS NOT NULL",
    ),
    "clean_price_volume_filters": _with(*D_CTES, body="SELECT * FROM d WHERE close > 0 AND volume >= 0"),
    "clean_round": _with(
        *D_CTES,
        body=f"SELECT date, symbol, {SR('open', 4)} AS open, {SR('high', 4)} AS high, {SR('low', 4)} AS low, "
             f"{SR('close', 4)} AS close, volume, date_partition FROM d",
    ),
    "clean_dedup": _with(*D_CTES, body=_NEWEST.format(src="d")),
    "clean_all": _with(*D_CTES, ("cl", _CLEANED), body=_NEWEST.format(src="cl")),
    "staging_history_dedup": _with(*D_CTES, ("cl", _CLEANED), body=_NEWEST.format(src="cl")),
    # indicators
    "sma_20": _with(*TI, body=f"SELECT symbol, date, close, {ST('sma_20')} AS sma_20 FROM i_ind"),
    "sma_50": _with(*TI, body=f"SELECT symbol, date, close, {ST('sma_50')} AS sma_50 FROM i_ind"),
    "ema_20": _with(*TI, body=f"SELECT symbol, date, close, {ST('ema_20')} AS ema_20 FROM i_ind"),
    "lag_gain_loss": _with(
        *TI, body="SELECT symbol, date, close, prev_close, close - prev_close AS delta, gain, loss FROM i_ind"
    ),
    "rsi_14": _with(*TI, body=f"SELECT symbol, date, close, {ST('rsi_14')} AS rsi_14 FROM i_ind"),
    "macd": _with(
        *TI,
        body=f"SELECT symbol, date, {ST('macd_line')} AS macd_line, {ST('macd_signal')} AS macd_signal, "
             f"{ST('macd_hist')} AS macd_hist FROM i_ind",
    ),
    "bollinger": _with(
        *TI,
        body=f"SELECT symbol, date, {ST('bb_mid')} AS bb_mid, {ST('bb_upper')} AS bb_upper, "
             f"{ST('bb_lower')} AS bb_lower FROM i_ind",
    ),
    "all_indicators": _with(*TI, body=_ind_select("i_ind")),
    "indicators_split": _with(*TI, body=_ind_select("i_ind")),
    # views
    "v_daily_summary": _with(
        *TI, ("v01", V01),
        body="SELECT symbol, trade_date, open, high, low, close, volume, daily_change_pct, "
             + ", ".join(f"{ST(c)} AS {c}" for c in ("sma_20", "sma_50", "rsi_14", "macd_line", "bb_upper", "bb_lower"))
             + " FROM v01",
    ),
    "v_weekly_rollup": _with(
        *TI,
        body="""SELECT symbol, CAST(CAST(date_trunc('week', date) AS DATE) AS VARCHAR) AS week_start,
       min(low) AS week_low, max(high) AS week_high, CAST(sum(volume) AS BIGINT) AS week_volume,
       arg_min(open, date) AS week_open, arg_max(close, date) AS week_close
FROM i_ind GROUP BY 1, 2""",
    ),
    "registered_views": _with(
        *TI, ("v01", V01), ("v03", V03), ("v04", V04), ("v05", V05),
        ("wk", """SELECT symbol, date_trunc('week', date) AS w, sum(volume) AS week_volume FROM i_ind GROUP BY 1, 2"""),
        *LATEST, ("v07", V07),
        body=" UNION ALL ".join(
            f"SELECT '{name}' AS view_name, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, "
            f"coalesce({ST(f'sum({col})', 2)}, 0.0) AS check_sum FROM {src}"
            for name, src, col in (
                ("v_daily_summary", "v01", "volume"), ("v_weekly_rollup", "wk", "week_volume"), ("v_top_movers", "v03", "change_pct"),
                ("v_rsi_signals", "v04", "close"), ("v_bollinger_squeeze", "v05", "close"), ("v_latest_ticks", "v06", "price"),
                ("v_tick_history", "v07", "price"))),
    ),
    "v_top_movers": _with(*TI, body=V03),
    "v_rsi_signals": _with(
        *TI, ("v04", V04), body=f"SELECT symbol, trade_date, close, {ST('rsi_14')} AS rsi_14, rsi_signal FROM v04"
    ),
    "v_bollinger_squeeze": _with(
        *TI, ("v05", V05),
        body=f"SELECT symbol, trade_date, close, {ST('bb_upper')} AS bb_upper, {ST('bb_lower')} AS bb_lower, "
             "band_width FROM v05",
    ),
    "top_n_movers": _with(
        *TI, ("v03", V03), body="SELECT * FROM v03 ORDER BY abs_change_pct DESC NULLS LAST, symbol LIMIT 5"
    ),
    # measures, market overview (latest day)
    "market_kpis": _with(
        *DAILY,
        body=f"SELECT count(DISTINCT symbol) AS tracked_symbols, CAST(sum(volume) AS BIGINT) AS total_volume, "
             f"{ST('avg(daily_change_pct)')} AS avg_change_pct FROM sl",
    ),
    "rsi_counts": _with(
        *SIGNALS,
        body="""SELECT count(*) FILTER (WHERE rsi_signal = 'overbought') AS overbought_count,
       count(*) FILTER (WHERE rsi_signal = 'oversold') AS oversold_count,
       count(*) FILTER (WHERE rsi_signal = 'neutral') AS neutral_count FROM rsl""",
    ),
    "rsi_distribution": _with(*SIGNALS, body="SELECT rsi_signal, count(*) AS symbols FROM rsl GROUP BY rsi_signal"),
    "volume_by_symbol": _with(
        *DAILY, body="SELECT symbol, CAST(sum(volume) AS BIGINT) AS total_volume FROM sl GROUP BY symbol"
    ),
    "change_ranking": _with(
        *DAILY,
        body="SELECT symbol, daily_change_pct, CASE WHEN daily_change_pct < 0 THEN 'loss' ELSE 'gain' END "
             "AS direction FROM sl",
    ),
    "market_summary": _with(*DAILY, body="SELECT symbol, open, close, daily_change_pct, volume FROM sl"),
    # measures, symbol detail (every symbol)
    "symbol_kpis": _with(
        *DAILY,
        ("k0", f"""SELECT symbol, {_latest('close')} AS latest_close,
       {_latest('daily_change_pct')} AS latest_change_pct, {_latest('rsi_14')} AS latest_rsi
FROM v01 GROUP BY symbol"""),
        body=f"""SELECT symbol, latest_close, latest_change_pct, {ST('latest_rsi')} AS latest_rsi,
       CASE WHEN latest_rsi >= 70 THEN 'Overbought' WHEN latest_rsi <= 30 THEN 'Oversold' ELSE 'Neutral' END
       AS rsi_signal FROM k0""",
    ),
    "high_low_52w": _with(
        *DAILY, body="SELECT symbol, max(high) AS high_52w, min(low) AS low_52w FROM v01 GROUP BY symbol"
    ),
    "bb_position": _with(
        *DAILY,
        ("b0", f"""SELECT symbol, {_latest('close')} AS c, {_latest('bb_upper')} AS u, {_latest('bb_lower')} AS l
FROM v01 GROUP BY symbol"""),
        body=f"SELECT symbol, {ST('((c - l) / NULLIF(u - l, 0)) * 100')} AS bb_position_pct FROM b0",
    ),
    "symbol_series": _with(
        *DAILY,
        body="SELECT symbol, trade_date, close, "
             + ", ".join(f"{ST(c)} AS {c}" for c in ("sma_20", "sma_50", "bb_upper", "bb_lower", "macd_line", "rsi_14"))
             + " FROM v01",
    ),
    "volume_history": _with(
        *DAILY,
        body="SELECT symbol, trade_date, CAST(sum(volume) AS BIGINT) AS volume FROM v01 GROUP BY symbol, trade_date",
    ),
    # measures, signals and risk (latest day)
    "rsi_screen": _with(
        *SIGNALS,
        body=f"SELECT symbol, close, {ST('rsi_14')} AS rsi_14, rsi_signal, rsi_14 >= 70 AS above_70, "
             "rsi_14 <= 30 AS below_30 FROM rsl",
    ),
    "band_width_rank": _with(
        *TI, ("v05", V05),
        body="SELECT symbol, close, band_width FROM v05 WHERE trade_date = (SELECT CAST(max(date) AS VARCHAR) FROM i_ind)",
    ),
    "risk_scatter": _with(
        *DAILY, body=f"SELECT symbol, {ST('rsi_14')} AS rsi_14, daily_change_pct, volume FROM sl"
    ),
    "market_risk_score": _with(*SIGNALS, body=f"SELECT {ST('sum(abs(rsi_14 - 50))')} AS risk_score FROM rsl"),
    # ticks
    "tick_decode": _with(*K_CTES, body=f"SELECT {_TICK_COLS} FROM k"),
    "tick_encode": _with(
        *K_CTES,
        body=f"SELECT 'ticks.' || lower(replace(symbol, '.', '_')) AS topic, symbol AS key, "
             f"CAST({_JSON} AS VARCHAR) AS value FROM k",
    ),
    "v_latest_ticks": _with(*LATEST, body="SELECT * FROM v06"),
    "v_tick_history": _with(*KD, body=V07),
    "latest_ticks_by_hour": _with(
        *K_CTES,
        ("kh", "SELECT *, CAST(hour(event_time) AS INTEGER) AS tick_hour FROM k"),
        ("lh", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date_partition, tick_hour ORDER BY event_time DESC) AS rn
  FROM kh
) WHERE rn = 1"""),
        body=_live("lh", "symbol, date_partition, tick_hour"),
    ),
    "live_kpis": _with(
        *LATEST,
        body=f"""SELECT {ST('avg(change_pct)')} AS avg_change_pct, {ST('sum(price)')} AS total_price,
       CAST(sum(volume) AS BIGINT) AS total_volume,
       CASE WHEN bool_or(market_status = 'LIVE') THEN 'LIVE' ELSE 'CLOSED' END AS market_status
FROM v06""",
    ),
    "live_table_totals": _with(
        *LATEST,
        body=f"""SELECT CASE WHEN grouping(symbol) = 1 THEN 'Total' ELSE symbol END AS symbol,
       grouping(symbol) = 1 AS is_total,
       {ST('sum(price)')} AS price, {ST('avg(change_pct)')} AS change_pct,
       CAST(sum(volume) AS BIGINT) AS volume, {ST('avg(intraday_range_pct)')} AS intraday_range_pct
FROM v06 GROUP BY ROLLUP (symbol)""",
    ),
    "intraday_series": _with(*KD, ("v07", V07), body="SELECT symbol, tick_time, price FROM v07"),
    # writers
    "stream_tick_sink": _with(*K_CTES, body=f"SELECT {_TICK_COLS} FROM k"),
    "lake_roundtrip": _with(*LAKE, body=_ind_select("i_ind", ", ingested_at, (SELECT count(*) FROM "
        "(SELECT DISTINCT symbol, date FROM cl WHERE date_partition = (SELECT max(date_partition) FROM cl))) AS staging_rows")),
    "table_statistics": _with(
        *TI, body="SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, count(*) AS analyzed_rows FROM i_ind"),
    "latest_ticks_zoned": _with(
        *LATEST, ("lz", "SELECT * REPLACE (event_time + INTERVAL 5 HOUR AS event_time) FROM lt"),
        body=_live("lz", "symbol").replace("BETWEEN 2 AND 6", "BETWEEN 1 AND 5")),
    "ticks_today": _with(*KD, body=V07),
    "ingestion_stamp": _with(
        *D_CTES, ("cl", _CLEANED), body="SELECT count(*) AS n_rows, count(*) AS stamped_now FROM (SELECT DISTINCT symbol, date FROM cl)"),
    "movers_ranked": _with(
        *DAILY, body="SELECT symbol, open, close, daily_change_pct, volume, "
                     "CAST(row_number() OVER (ORDER BY daily_change_pct DESC NULLS LAST, symbol) AS INTEGER) AS place FROM sl"),
    "losers_ranked": _with(
        *DAILY, body="SELECT symbol, daily_change_pct, CASE WHEN daily_change_pct < 0 THEN 'loss' ELSE 'gain' END AS direction, "
                     "CAST(row_number() OVER (ORDER BY daily_change_pct ASC NULLS FIRST, symbol) AS INTEGER) AS place FROM sl"),
    "volume_ranked": _with(
        *DAILY, body="SELECT symbol, total_volume, CAST(row_number() OVER (ORDER BY total_volume DESC NULLS LAST, symbol) AS INTEGER) AS place "
                     "FROM (SELECT symbol, CAST(sum(volume) AS BIGINT) AS total_volume FROM sl GROUP BY symbol)"),
    "widest_ranked": _with(
        *TI, ("v05", V05),
        body="SELECT symbol, close, band_width, CAST(row_number() OVER (ORDER BY band_width DESC NULLS LAST, symbol) AS INTEGER) AS place "
             "FROM v05 WHERE trade_date = (SELECT CAST(max(date) AS VARCHAR) FROM i_ind)"),
    "narrowest_ranked": _with(
        *TI, ("v05", V05),
        body="SELECT symbol, trade_date, band_width, "
             "CAST(row_number() OVER (ORDER BY band_width ASC NULLS FIRST, symbol, trade_date) AS INTEGER) AS place FROM v05"),
    "live_ranked": _with(*LATEST, body="SELECT *, CAST(row_number() OVER (ORDER BY symbol) AS INTEGER) AS place FROM v06"),
    "ticks_ordered": _with(
        *K_CTES, body="SELECT symbol, timestamp AS tick_time, price, "
                      "row_number() OVER (ORDER BY symbol, timestamp, price NULLS FIRST) AS place FROM k"),
    "latest_day_bars": _with(("e", E()), *IND_CTES("e"), body=_ind_select("i_ind") + " WHERE date = (SELECT max(date) FROM i_ind)"),
    "lake_incremental": _with(*RUNS, body=_ind_select("i_ind", ", ingested_at, "
        "(SELECT count(*) FROM kinds WHERE NOT anew) AS appended, (SELECT count(*) FROM kinds WHERE anew) AS replaced")),
    "partition_statistics": _with(
        ("e", E()), body="SELECT symbol, count(*) AS n_rows, count(*) AS analyzed_rows FROM e "
                         "WHERE symbol <> 'click' OR day(date) > 3 GROUP BY symbol"),
    "stream_latest_ticks": _with(
        *K_CTES, body=f"""SELECT {_TICK_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date_partition ORDER BY event_time DESC, timestamp DESC, price DESC) AS rn FROM k) WHERE rn = 1"""),
    "stream_live_kpis": _with(
        *LATEST,
        body=f"""SELECT {ST('avg(change_pct)')} AS avg_change_pct, {ST('sum(price)')} AS total_price,
       CAST(sum(volume) AS BIGINT) AS total_volume,
       CASE WHEN bool_or(market_status = 'LIVE') THEN 'LIVE' ELSE 'CLOSED' END AS market_status
FROM v06"""),
    "stream_dedup_sink": _with(*K_CTES, body=f"SELECT DISTINCT {_TICK_COLS} FROM k"),
    "symbol_slice": _with(
        ("t", T), body=f"SELECT symbol, CAST(date AS VARCHAR) AS trade_date, open, high, low, close, volume, {_chg('close', 'open')} AS daily_change_pct "
                       "FROM t WHERE symbol IN ('Brand#11', 'Brand#23', 'Brand#55')"),
    "catalog_repair": _with(*D_CTES, body="SELECT date, symbol, open, high, low, close, volume, date_partition FROM d"),
}
