"""Named queries over the test tables: one per operator of SURVEY §2 / §7.4.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the *whole*
input tables. Inputs: T = trade bars (lineitem x part), E = event bars,
K = ticks from events, D = dirty raw bars, W = wide history (see
``sources.testdata``). Published values that are means of doubles go through
``stable_round`` (4 dp) so that another engine summing in a different order
gets the same digits; raw prices are never rounded.

Queries that exercise writers (lake, catalog, stream sink) write under the
session's shared checkpoint folder and return the table read back.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from quantlake.functions.exprs import TRADING_DOW_SUN_THU, stable_round
import quantlake.operators.cleaning as C
from quantlake.operators.indicators import (
    add_all_indicators,
    add_bollinger,
    add_ema,
    add_gain_loss,
    add_macd,
    add_rsi,
    add_sma,
    LOOKBACK,
    last_bars,
)
from quantlake.operators.ranking import with_place
from quantlake.paths import LakePaths
from quantlake.plans import measures as M
from quantlake.plans import views as V
from quantlake.plans.batch import run_batch
from quantlake.plans.incremental import run_incremental
from quantlake.schemas import INDICATOR_COLS, OHLCV_COLS
from quantlake.session import scratch_path
from quantlake.sources import catalog as CAT
from quantlake.sources import lake
from quantlake.sources.kafka import encode_ticks
from quantlake.sources.testdata import (
    dirty_bars,
    event_ticks,
    events_bars,
    latest_event_day,
    latest_trade_day,
    trade_bars,
    wide_history,
)
from quantlake.sources.universe import in_universe, universe_frame
from quantlake.sources.wide import normalize_wide
from quantlake.streaming.latest import read_latest_ticks, start_latest_ticks
from quantlake.streaming.ticks import decode_ticks, landed_columns, read_landed_ticks, start_tick_sink

Query = Callable[[SparkSession, str], DataFrame]

# ---- fixed parameters of the registered queries ---------------------------
UNIVERSE = ["click", "purchase", "view", "refund"]                 # tracked list; "refund" has no data
FIXED_INGESTED_AT = "2024-02-02 00:00:00"                          # stands in for the wall clock
TOP_N = 5
OTHER_ZONE = "Asia/Karachi"                                        # UTC+5 all year
SLICED_SYMBOLS = ["Brand#11", "Brand#23", "Brand#55"]
SPLIT_TEST_ROWS = 64                                               # forces many chunks at test scale
RUNS_FROM, CORRECTED_DAYS, CORRECTED_SYMBOL = "2024-01-01", 3, "click"   # the incremental lake's runs
FEED_PARTS, FEED_DAYS = 3, 10                                      # source files of the restarted streams
VIEW_CHECK = {"v_daily_summary": "volume", "v_weekly_rollup": "week_volume", "v_top_movers": "change_pct", "v_rsi_signals": "close",
              "v_bollinger_squeeze": "close", "v_latest_ticks": "price", "v_tick_history": "price"}  # column summed per view
# ---------------------------------------------------------------------------

AVERAGED = set(INDICATOR_COLS) | {
    "avg_change_pct",
    "risk_score",
    "bb_position_pct",
    "latest_rsi",
    "total_price",
}


def publish(df: DataFrame, extra_rounded: tuple[str, ...] = ()) -> DataFrame:
    """Output form: averaged doubles to stable 4 dp, instants as wall-clock UTC (TIMESTAMP_NTZ)."""
    out = {}
    for f in df.schema.fields:
        if f.name in AVERAGED or f.name in extra_rounded:
            out[f.name] = stable_round(f.name, 4)
        elif isinstance(f.dataType, TimestampType):
            out[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


# ---- shared inputs --------------------------------------------------------

def _curated_t(spark, sf):
    return add_all_indicators(trade_bars(spark, sf))


def _recent_curated_t(spark, sf):
    """Curated bars of the latest day: windows over the last bars of each symbol, not over all history."""
    recent = last_bars(trade_bars(spark, sf), LOOKBACK + 1)
    return add_all_indicators(recent).filter(F.col("date") == F.lit(latest_trade_day(spark, sf)))


def _daily_t(spark, sf):
    return V.v_daily_summary(_curated_t(spark, sf))


def _signals_t(spark, sf):
    return V.v_rsi_signals(_curated_t(spark, sf))


def _raw_e(spark, sf):
    return events_bars(spark, sf).withColumn("date_partition", F.col("date").cast("string"))


def _ticks_k(spark, sf):
    return event_ticks(spark, sf)


def _today_k(spark, sf):
    """'Today' for the tick views: the latest event day (every event becomes a tick)."""
    return latest_event_day(spark, sf)


def _latest_k(spark, sf):
    day = _today_k(spark, sf)
    return V.v_latest_ticks(event_ticks(spark, sf, day), as_of=day)


def _history_k(spark, sf):
    day = _today_k(spark, sf)
    return V.v_tick_history(event_ticks(spark, sf, day), as_of=day)


def _bar_cols(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("symbol", "date", *extra)


# ---- S: sources / sinks ---------------------------------------------------

def q_raw_partition_scan(spark, sf):
    """E landed as one run per day; the latest run read back, pruned to its partition."""
    paths = LakePaths(scratch_path(spark, "raw"))
    lake.write_raw_runs(_raw_e(spark, sf), paths)
    return lake.read_raw(spark, paths, "latest")


def q_universe_filter(spark, sf):
    return in_universe(events_bars(spark, sf), universe_frame(spark, UNIVERSE))


def q_normalize_wide(spark, sf):
    return normalize_wide(wide_history(spark, sf))


# ---- C: cleaning ----------------------------------------------------------

def q_clean_dropna(spark, sf):
    return C.drop_incomplete(dirty_bars(spark, sf))


def q_clean_price_volume_filters(spark, sf):
    return C.non_negative_volume(C.positive_close(dirty_bars(spark, sf)))


def q_clean_round(spark, sf):
    return C.round_prices(C.parse_date(dirty_bars(spark, sf)))


def q_clean_dedup(spark, sf):
    d = dirty_bars(spark, sf)
    return C.dedup_bars(d, order=["date_partition", "open", "high", "low", "close", "volume"])


def q_clean_all(spark, sf):
    staged = C.clean(dirty_bars(spark, sf), FIXED_INGESTED_AT)
    return C.ingested_at_as_text(staged)


def _staging_d(spark, sf):
    """Each run date cleaned on its own, as the staging zone holds them."""
    return C.clean(dirty_bars(spark, sf), FIXED_INGESTED_AT, keys=("symbol", "date", "date_partition"))


def q_staging_history_dedup(spark, sf):
    return C.ingested_at_as_text(lake.latest_per_bar(_staging_d(spark, sf)))


# ---- W: indicators --------------------------------------------------------

def q_sma_20(spark, sf):
    return publish(_bar_cols(add_sma(trade_bars(spark, sf), 20), "close", "sma_20"))


def q_sma_50(spark, sf):
    return publish(_bar_cols(add_sma(trade_bars(spark, sf), 50), "close", "sma_50"))


def q_ema_20(spark, sf):
    return publish(_bar_cols(add_ema(trade_bars(spark, sf), 20), "close", "ema_20"))


def q_lag_gain_loss(spark, sf):
    g = add_gain_loss(trade_bars(spark, sf))
    return _bar_cols(g, "close", "prev_close", "delta", "gain", "loss")


def q_rsi_14(spark, sf):
    return publish(_bar_cols(add_rsi(trade_bars(spark, sf), 14), "close", "rsi_14"))


def q_macd(spark, sf):
    return publish(_bar_cols(add_macd(trade_bars(spark, sf)), "macd_line", "macd_signal", "macd_hist"))


def q_bollinger(spark, sf):
    return publish(_bar_cols(add_bollinger(trade_bars(spark, sf)), "bb_mid", "bb_upper", "bb_lower"))


def q_all_indicators(spark, sf):
    return publish(_curated_t(spark, sf).select(*OHLCV_COLS, *INDICATOR_COLS))


def q_indicators_split(spark, sf):
    out = add_all_indicators(trade_bars(spark, sf), split_rows=SPLIT_TEST_ROWS)
    return publish(out.select(*OHLCV_COLS, *INDICATOR_COLS))


# ---- V: views -------------------------------------------------------------

def q_v_daily_summary(spark, sf):
    return publish(_daily_t(spark, sf))


def q_v_weekly_rollup(spark, sf):
    return V.v_weekly_rollup(_curated_t(spark, sf))


def q_v_top_movers(spark, sf):
    return V.v_top_movers(trade_bars(spark, sf, latest_trade_day(spark, sf)))


def q_v_rsi_signals(spark, sf):
    return publish(_signals_t(spark, sf))


def q_v_bollinger_squeeze(spark, sf):
    return publish(V.v_bollinger_squeeze(_curated_t(spark, sf)))


def q_registered_views(spark, sf):
    """S13 + S14: curated bars and ticks landed as catalog tables, all seven views made over them, then each
    one read by its qualified name: view, rows, symbols and the sum of one published column."""
    root = scratch_path(spark, "views")
    paths, db = LakePaths(root), "ql_" + root.rsplit("/", 1)[-1][:12]
    curated = _curated_t(spark, sf).withColumn("ingested_at", F.lit(FIXED_INGESTED_AT))
    lake.write_curated(curated, paths)
    landed_columns(_ticks_k(spark, sf)).write.partitionBy("date_partition", "symbol").parquet(paths.raw_ticks)
    CAT.create_database(spark, db, location=f"{root}/warehouse", use=False)
    for table_name in (CAT.create_curated_table(spark, paths, db), CAT.create_ticks_table(spark, paths, db)):
        CAT.repair(spark, table_name)
    parts = []
    for name in CAT.create_views(spark, db, ticks=True, latest_day=True):
        short = name.split(".")[1]
        parts.append(CAT.query_view(spark, name).agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct("symbol").alias("n_symbols"),
            F.coalesce(stable_round(F.sum(VIEW_CHECK[short]), 2), F.lit(0.0)).alias("check_sum"),
        ).select(F.lit(short).alias("view_name"), "n_rows", "n_symbols", "check_sum"))
    return functools.reduce(DataFrame.unionByName, parts)


def q_top_n_movers(spark, sf):
    return M.top_n_movers(q_v_top_movers(spark, sf), TOP_N)


# ---- M: measures (page slicer = latest trading day) -----------------------

def _daily_latest(spark, sf):
    """The latest day's rows; its indicators from each symbol's last LOOKBACK + 1 bars."""
    return V.v_daily_summary(_recent_curated_t(spark, sf))


def _moves_latest(spark, sf):
    """The latest day without indicators: only that day's trades are read."""
    day = latest_trade_day(spark, sf)
    return M.slice_date(V.daily_moves(trade_bars(spark, sf, day)), day)


def _signals_latest(spark, sf):
    return V.v_rsi_signals(_recent_curated_t(spark, sf))


def q_market_kpis(spark, sf):
    return publish(M.market_kpis(_moves_latest(spark, sf)))


def q_rsi_counts(spark, sf):
    return M.rsi_counts(_signals_latest(spark, sf))


def q_rsi_distribution(spark, sf):
    return M.rsi_distribution(_signals_latest(spark, sf))


def q_volume_by_symbol(spark, sf):
    return M.volume_by_symbol(_moves_latest(spark, sf))


def q_change_ranking(spark, sf):
    return M.change_ranking(_moves_latest(spark, sf))


def q_market_summary(spark, sf):
    return M.market_summary(_moves_latest(spark, sf))


def q_symbol_kpis(spark, sf):
    return publish(M.symbol_kpis(_daily_t(spark, sf)))


def q_high_low_52w(spark, sf):
    return M.high_low_52w(_daily_t(spark, sf))


def q_bb_position(spark, sf):
    return publish(M.bb_position(_daily_t(spark, sf)))


def q_symbol_series(spark, sf):
    return publish(M.symbol_series(_daily_t(spark, sf)))


def q_volume_history(spark, sf):
    return M.volume_history(_daily_t(spark, sf))


def q_rsi_screen(spark, sf):
    return publish(M.rsi_screen(_signals_latest(spark, sf)))


def q_band_width_rank(spark, sf):
    return M.band_width_rank(V.v_bollinger_squeeze(_recent_curated_t(spark, sf)))


def q_risk_scatter(spark, sf):
    return publish(M.risk_scatter(_daily_latest(spark, sf)))


def q_market_risk_score(spark, sf):
    return publish(M.market_risk_score(_signals_latest(spark, sf)))


# ---- ticks ----------------------------------------------------------------

def q_tick_decode(spark, sf):
    records = encode_ticks(_ticks_k(spark, sf))
    return publish(decode_ticks(records).select(*_TICK_OUT))


def q_tick_encode(spark, sf):
    return encode_ticks(_ticks_k(spark, sf))


def q_v_latest_ticks(spark, sf):
    return _latest_k(spark, sf)


def q_v_tick_history(spark, sf):
    return _history_k(spark, sf)


def q_latest_ticks_by_hour(spark, sf):
    return V.latest_ticks_by_hour(_ticks_k(spark, sf))


def q_live_kpis(spark, sf):
    return publish(M.live_kpis(_latest_k(spark, sf)))


def q_live_table_totals(spark, sf):
    return publish(M.live_table_totals(_latest_k(spark, sf)), ("price", "change_pct", "intraday_range_pct"))


def q_intraday_series(spark, sf):
    return M.intraday_series(_history_k(spark, sf))


_TICK_OUT = ("symbol", "timestamp", "price", "volume", "open", "high", "low", "prev_close",
             "event_time", "date_partition")


# ---- writers: stream sink, lake round trip, catalog -----------------------

def q_stream_tick_sink(spark, sf):
    """K encoded to JSON lines in a source folder, landed by a streaming query, read back."""
    root = scratch_path(spark, "stream")
    src, sink, ckpt = f"{root}/source", f"{root}/sink", f"{root}/checkpoint"
    encode_ticks(_ticks_k(spark, sf)).select("value").write.text(src)
    stream = spark.readStream.schema("value STRING").text(src)
    q = start_tick_sink(decode_ticks(stream), sink, ckpt, available_now=True)
    q.awaitTermination()
    landed = read_landed_ticks(spark, sink)
    return publish(landed.select(*_TICK_OUT))


def q_lake_roundtrip(spark, sf):
    """Raw landing, two daily batch runs (overlapping days), curated read back."""
    paths = LakePaths(scratch_path(spark, "lake"))
    lake.write_raw_runs(dirty_bars(spark, sf), paths)
    for run in lake.landed_runs(spark, paths):
        done = run_batch(spark, paths, run, ingested_at=FIXED_INGESTED_AT)
    cur = lake.read_curated(spark, paths)
    written = F.lit(done.staging_rows).cast("long").alias("staging_rows")  # of the last run, counted by its write
    return publish(cur.select(*OHLCV_COLS, *INDICATOR_COLS, "ingested_at", written))


def q_catalog_repair(spark, sf):
    """External table over the raw zone, partitions registered after landing, read via the catalog."""
    root = scratch_path(spark, "catalog")
    paths = LakePaths(root)
    db = "ql_" + root.rsplit("/", 1)[-1][:12]
    CAT.create_database(spark, db, location=f"{root}/warehouse", use=False)
    name = CAT.create_raw_table(spark, paths, db)
    lake.write_raw_runs(dirty_bars(spark, sf), paths)
    CAT.repair(spark, name)
    return CAT.query_view(spark, name).select(*OHLCV_COLS, "date_partition")


def q_table_statistics(spark, sf):
    """Curated bars as a catalog table; its row count from ANALYZE next to the counted one."""
    root = scratch_path(spark, "stats")
    paths, db = LakePaths(root), "ql_" + root.rsplit("/", 1)[-1][:12]
    lake.write_curated(_curated_t(spark, sf).withColumn("ingested_at", F.lit(FIXED_INGESTED_AT)), paths)
    CAT.create_database(spark, db, location=f"{root}/warehouse", use=False)
    name = CAT.create_curated_table(spark, paths, db)
    CAT.repair(spark, name)
    CAT.analyze(spark, name)
    stated = F.lit(CAT.row_count(spark, name)).cast("long").alias("analyzed_rows")
    return CAT.query_view(spark, name).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("symbol").alias("n_symbols")).select("*", stated)


def q_latest_ticks_zoned(spark, sf):
    """the market read on another zone's clock and trading week."""
    day = _today_k(spark, sf)
    return V.v_latest_ticks(event_ticks(spark, sf, day), as_of=day, tz=OTHER_ZONE, trading_dow=TRADING_DOW_SUN_THU)


def q_ticks_today(spark, sf):
    """the ticks moved so that their latest day is today, then the view's default day."""
    moved = F.date_add(F.current_date(), F.datediff(F.col("date_partition"), F.lit(_today_k(spark, sf))))
    return V.v_tick_history(_ticks_k(spark, sf).withColumn("date_partition", moved))


def q_ingestion_stamp(spark, sf):
    """rows whose ingestion stamp, taken from the clock, is of this run."""
    stamped = C.clean(dirty_bars(spark, sf))
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("ingested_at")
    return stamped.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(age.between(0, 3600)).alias("stamped_now"))


def _placed(listing: DataFrame, order: str) -> DataFrame:
    return M.placed(listing, order).withColumn("place", F.col("place").cast("int"))


def q_movers_ranked(spark, sf):
    """The summary grid in presentation order, made visible by each row's place."""
    return _placed(M.market_summary(_moves_latest(spark, sf)), "movers")


def q_losers_ranked(spark, sf):
    """Smallest change first."""
    return _placed(M.change_ranking(_moves_latest(spark, sf)), "losers")


def q_volume_ranked(spark, sf):
    """Largest volume first."""
    return _placed(M.volume_by_symbol(_moves_latest(spark, sf)), "volume")


def q_widest_ranked(spark, sf):
    """Widest bands first."""
    return _placed(q_band_width_rank(spark, sf), "widest")


def q_narrowest_ranked(spark, sf):
    """The squeeze, narrowest bands first, over every symbol and day."""
    return _placed(V.v_bollinger_squeeze(_curated_t(spark, sf)).select("symbol", "trade_date", "band_width"), "narrowest")


def q_live_ranked(spark, sf):
    """The live table by symbol."""
    return _placed(_latest_k(spark, sf), "symbols")


def q_ticks_ordered(spark, sf):
    """All ticks by symbol and time, each with its place."""
    return with_place(_ticks_k(spark, sf).select("symbol", F.col("timestamp").alias("tick_time"), "price"), ["symbol", "tick_time"])


def q_latest_day_bars(spark, sf):
    """Curated bars landed, the last day found in the footers and read back."""
    paths = LakePaths(scratch_path(spark, "days"))
    lake.write_curated(add_all_indicators(events_bars(spark, sf)).withColumn("ingested_at", F.lit(FIXED_INGESTED_AT)), paths)
    return publish(lake.read_latest_day(spark, paths).select(*OHLCV_COLS, *INDICATOR_COLS))


def _in_runs(bars: DataFrame) -> DataFrame:
    """E as three overlapping runs: each has the days behind the one before, some days again, and the last one late corrections."""
    off = F.datediff("date", F.lit(RUNS_FROM).cast("date"))
    late = (off < CORRECTED_DAYS) & (F.col("symbol") == CORRECTED_SYMBOL)
    runs = [(F.lit("2024-03-01"), off <= 17), (F.lit("2024-03-02"), off.between(15, 23)), (F.lit("2024-03-03"), (off > 20) | late)]
    landed = [bars.where(when).withColumn("date_partition", run) for run, when in runs]
    landed[2] = landed[2].withColumn("close", F.when(off < CORRECTED_DAYS, F.col("close") * 2).otherwise(F.col("close")))
    return functools.reduce(DataFrame.unionByName, landed)


def q_lake_incremental(spark, sf):
    """Three runs through the incremental job: first bars, appended days, appended days with late corrections."""
    paths = LakePaths(scratch_path(spark, "lake"))
    lake.write_raw_runs(_in_runs(events_bars(spark, sf)), paths)
    for run in lake.landed_runs(spark, paths):
        done = run_incremental(spark, paths, run, ingested_at=FIXED_INGESTED_AT)
    work = [F.lit(v).cast("long").alias(n) for n, v in (("appended", done.appended), ("replaced", done.replaced))]  # by the last run
    return publish(lake.read_curated(spark, paths).select(*OHLCV_COLS, *INDICATOR_COLS, "ingested_at", *work))


def q_partition_statistics(spark, sf):
    """Each symbol's rows as ANALYZE recorded them per partition, after two runs' partitions were registered
    from the writes' own reports: the second run replaces one symbol, and that partition only is analyzed again."""
    root = scratch_path(spark, "stats")
    paths, db = LakePaths(root), "ql_" + root.rsplit("/", 1)[-1][:12]
    curated = add_all_indicators(events_bars(spark, sf)).withColumn("ingested_at", F.lit(FIXED_INGESTED_AT))
    CAT.create_database(spark, db, location=f"{root}/warehouse", use=False)
    name = CAT.create_curated_table(spark, paths, db)
    CAT.publish(spark, name, lake.land_curated(curated, paths).partitions, whole=True)
    CAT.analyze(spark, name, ("symbol",), columns=("close",))
    fewer = lake.land_curated(curated.where((F.col("symbol") == CORRECTED_SYMBOL) & (F.dayofmonth("date") > CORRECTED_DAYS)), paths, dynamic=True)
    CAT.publish(spark, name, fewer.partitions)
    CAT.analyze(spark, name, values=fewer.partitions)
    counts = CAT.partition_row_counts(spark, name)
    # one row a partition, as the catalog lists them
    stated = spark.createDataFrame(list(counts.items()), "symbol string, analyzed_rows long")
    return CAT.query_view(spark, name).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows")).join(stated, "symbol", "full")


def _feed(spark, sf, src: str, part: int) -> None:
    """Every PARTS-th of the ticks' days, in order of time but for ticks that come a day late, as one more source file."""
    ticks = _ticks_k(spark, sf)
    day = F.datediff("date_partition", F.lit(RUNS_FROM).cast("date")) + F.pmod(F.xxhash64("symbol", "timestamp"), F.lit(2))
    (encode_ticks(ticks.where(F.least(F.floor(day / FEED_DAYS), F.lit(FEED_PARTS - 1)) == part)).select("value").write.mode("append").text(src))


def _fed(spark, sf, name: str, start) -> str:
    """A stream run over each part of the feed in turn, so it restarts from its checkpoint every time."""
    root = scratch_path(spark, name)
    for part in range(FEED_PARTS):
        _feed(spark, sf, f"{root}/source", part)
        stream = spark.readStream.schema("value STRING").text(f"{root}/source")
        start(decode_ticks(stream), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def q_stream_latest_ticks(spark, sf):
    """W11, V06 as running state: the latest tick of every symbol and day, kept by a stream that is fed out of order and restarted."""
    path = _fed(spark, sf, "latest", lambda t, out, ckpt: start_latest_ticks(t, out, ckpt, late="3 days", available_now=True))
    return publish(read_latest_ticks(spark, path).select(*_TICK_OUT))


def q_stream_live_kpis(spark, sf):
    """M16 over the running state, of the latest day."""
    path = _fed(spark, sf, "latest", lambda t, out, ckpt: start_latest_ticks(t, out, ckpt, late="3 days", available_now=True))
    return publish(M.live_kpis(V.v_latest_ticks(read_latest_ticks(spark, path), as_of=_today_k(spark, sf))))


def q_stream_dedup_sink(spark, sf):
    """The feed delivered twice, the second time in part after a restart, lands once."""
    root = scratch_path(spark, "dedup")
    src, out, ckpt = f"{root}/source", f"{root}/out", f"{root}/checkpoint"
    ticks = _ticks_k(spark, sf)
    for again in (ticks.unionByName(ticks.where("volume % 2 = 0")), ticks.where("volume % 3 = 0")):
        encode_ticks(again).select("value").write.mode("append").text(src)
        stream = spark.readStream.schema("value STRING").text(src)
        start_tick_sink(decode_ticks(stream), out, ckpt, available_now=True, dedup_within="40 days").awaitTermination()
    return publish(read_landed_ticks(spark, out).select(*_TICK_OUT))


def q_symbol_slice(spark, sf):
    """The symbol slicer over the daily summary."""
    return M.slice_symbols(V.daily_moves(trade_bars(spark, sf)), SLICED_SYMBOLS)


QUERIES: dict[str, Query] = {
    "table_statistics": q_table_statistics,
    "latest_ticks_zoned": q_latest_ticks_zoned,
    "ticks_today": q_ticks_today,
    "ingestion_stamp": q_ingestion_stamp,
    "movers_ranked": q_movers_ranked,
    "losers_ranked": q_losers_ranked,
    "volume_ranked": q_volume_ranked,
    "widest_ranked": q_widest_ranked,
    "narrowest_ranked": q_narrowest_ranked,
    "live_ranked": q_live_ranked,
    "ticks_ordered": q_ticks_ordered,
    "latest_day_bars": q_latest_day_bars,
    "lake_incremental": q_lake_incremental,
    "partition_statistics": q_partition_statistics,
    "stream_latest_ticks": q_stream_latest_ticks,
    "stream_live_kpis": q_stream_live_kpis,
    "stream_dedup_sink": q_stream_dedup_sink,
    "symbol_slice": q_symbol_slice,
    "raw_partition_scan": q_raw_partition_scan,
    "universe_filter": q_universe_filter,
    "normalize_wide": q_normalize_wide,
    "clean_dropna": q_clean_dropna,
    "clean_price_volume_filters": q_clean_price_volume_filters,
    "clean_round": q_clean_round,
    "clean_dedup": q_clean_dedup,
    "clean_all": q_clean_all,
    "staging_history_dedup": q_staging_history_dedup,
    "sma_20": q_sma_20,
    "sma_50": q_sma_50,
    "ema_20": q_ema_20,
    "lag_gain_loss": q_lag_gain_loss,
    "rsi_14": q_rsi_14,
    "macd": q_macd,
    "bollinger": q_bollinger,
    "all_indicators": q_all_indicators,
    "indicators_split": q_indicators_split,
    "v_daily_summary": q_v_daily_summary,
    "v_weekly_rollup": q_v_weekly_rollup,
    "v_top_movers": q_v_top_movers,
    "v_rsi_signals": q_v_rsi_signals,
    "v_bollinger_squeeze": q_v_bollinger_squeeze,
    "registered_views": q_registered_views,
    "top_n_movers": q_top_n_movers,
    "market_kpis": q_market_kpis,
    "rsi_counts": q_rsi_counts,
    "rsi_distribution": q_rsi_distribution,
    "volume_by_symbol": q_volume_by_symbol,
    "change_ranking": q_change_ranking,
    "market_summary": q_market_summary,
    "symbol_kpis": q_symbol_kpis,
    "high_low_52w": q_high_low_52w,
    "bb_position": q_bb_position,
    "symbol_series": q_symbol_series,
    "volume_history": q_volume_history,
    "rsi_screen": q_rsi_screen,
    "band_width_rank": q_band_width_rank,
    "risk_scatter": q_risk_scatter,
    "market_risk_score": q_market_risk_score,
    "tick_decode": q_tick_decode,
    "tick_encode": q_tick_encode,
    "v_latest_ticks": q_v_latest_ticks,
    "v_tick_history": q_v_tick_history,
    "latest_ticks_by_hour": q_latest_ticks_by_hour,
    "live_kpis": q_live_kpis,
    "live_table_totals": q_live_table_totals,
    "intraday_series": q_intraday_series,
    "stream_tick_sink": q_stream_tick_sink,
    "lake_roundtrip": q_lake_roundtrip,
    "catalog_repair": q_catalog_repair,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SURVEY §7.2 slice: event bars -> clean -> indicators -> RSI signals."""
    bars = events_bars(spark, sf_dir)
    staged = C.clean(bars, FIXED_INGESTED_AT)
    return publish(V.v_rsi_signals(add_all_indicators(staged)))
