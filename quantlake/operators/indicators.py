"""Technical indicators as trailing row-frame window expressions.

Semantics kept from the source pipeline (SURVEY D1, D10, D11):
* every "moving" value is the plain mean of the last ``n`` rows that exist, so
  the first rows of a series use shorter frames (no warm-up NULLs);
* ``ema_n`` is that same trailing mean, hence ``ema_20 == sma_20 == bb_mid`` and
  the MACD line is SMA12 - SMA26;
* RSI's first row has no previous close, gain = loss = 0 and RSI = 100;
* Bollinger bands use the *sample* standard deviation (NULL on a one-row frame).

Plan shape. ``add_all_indicators`` emits three projections (lag -> means ->
MACD signal); all frames share one PARTITION BY / ORDER BY, so Catalyst plans a
single Exchange + Sort with three Window nodes on top.

Hot keys. A window is evaluated per partition key, so one symbol holding a
third of all rows would be one task. ``split_rows`` turns on the split plan (``ranged_series``): rows are
range-partitioned by (symbol, date), every range is given a halo of the ``LOOKBACK`` rows before it, so ranges are
independent tasks and the halo rows are dropped afterwards. ``split_series`` does the same in chunks of exactly equal
size, for a part of the series (``hot_rows``) and without writing anything in between; row positions then come
from counts per (symbol, quantile bucket), never from a window over a whole symbol.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampNTZType, TimestampType

from quantlake.session import scratch_path

# ---- fixed values: the indicator bundle of the source pipeline -----------
SMA_PERIODS = (20, 50)
EMA_PERIOD = 20
RSI_PERIOD = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BB_PERIOD, BB_STD = 20, 2.0
# ---------------------------------------------------------------------------

# rows of history a bundle value may look back over (excluding the current row)
LOOKBACK = max(
    max(SMA_PERIODS) - 1,
    EMA_PERIOD - 1,
    RSI_PERIOD,                            # 14 gains need 15 closes
    (MACD_SLOW - 1) + (MACD_SIGNAL - 1),   # signal frame over slow frames
    BB_PERIOD - 1,
)

Keys = Sequence[str]
Order = str | Sequence[str]


def _ordered(partition_cols: Keys, order_col: Order):
    return Window.partitionBy(*partition_cols).orderBy(*([order_col] if isinstance(order_col, str) else order_col))


def trailing_window(period: int, partition_cols: Keys = ("symbol",), order_col: Order = "date"):
    """The current row and the ``period - 1`` rows before it."""
    return _ordered(partition_cols, order_col).rowsBetween(-(period - 1), 0)


def _mean(col: str | Column, period: int, keys: Keys, order: Order) -> Column:
    return F.avg(col).over(trailing_window(period, keys, order))


# ---- single indicators (public API, one call adds its columns) ------------

def add_sma(df: DataFrame, period: int = 20, price_col: str = "close", *,
            partition_cols: Keys = ("symbol",), order_col: str = "date") -> DataFrame:
    """``sma_<period>``."""
    return df.withColumn(f"sma_{period}", _mean(price_col, period, partition_cols, order_col))


def add_ema(df: DataFrame, period: int = 20, price_col: str = "close", *,
            partition_cols: Keys = ("symbol",), order_col: str = "date") -> DataFrame:
    """``ema_<period>``, the trailing mean of the source pipeline (not a recursive EMA)."""
    return df.withColumn(f"ema_{period}", _mean(price_col, period, partition_cols, order_col))


def _gain_loss(price: Column, prev: Column) -> tuple[Column, Column]:
    delta = price - prev
    gain = F.when(delta > 0, delta).otherwise(F.lit(0.0))
    loss = F.when(delta < 0, -delta).otherwise(F.lit(0.0))
    return gain, loss


def _rsi(avg_gain: Column, avg_loss: Column) -> Column:
    return (
        F.when(avg_loss == 0, F.lit(100.0))
        .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(avg_gain, avg_loss)))
    )


def add_gain_loss(df: DataFrame, price_col: str = "close", *,
                  partition_cols: Keys = ("symbol",), order_col: str = "date") -> DataFrame:
    """Previous close, delta, gain and loss columns."""
    prev = F.lag(price_col).over(_ordered(partition_cols, order_col))
    df = df.withColumn("prev_close", prev).withColumn("delta", F.col(price_col) - F.col("prev_close"))
    gain, loss = _gain_loss(F.col(price_col), F.col("prev_close"))
    return df.withColumn("gain", gain).withColumn("loss", loss)


def add_rsi(df: DataFrame, period: int = 14, price_col: str = "close", *,
            partition_cols: Keys = ("symbol",), order_col: str = "date") -> DataFrame:
    """``rsi_<period>`` from simple trailing means of gains and losses."""
    prev = F.lag(price_col).over(_ordered(partition_cols, order_col))
    gain, loss = _gain_loss(F.col(price_col), prev)
    tmp = df.withColumns({"_gain": gain, "_loss": loss}).withColumns({
        "_avg_gain": _mean("_gain", period, partition_cols, order_col),
        "_avg_loss": _mean("_loss", period, partition_cols, order_col),
    })
    rsi = _rsi(F.col("_avg_gain"), F.col("_avg_loss"))
    return tmp.withColumn(f"rsi_{period}", rsi).drop("_gain", "_loss", "_avg_gain", "_avg_loss")


def add_macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9,
             price_col: str = "close", *, partition_cols: Keys = ("symbol",),
             order_col: str = "date") -> DataFrame:
    """macd_line, macd_signal (trailing mean of the line) and macd_hist."""
    line = _mean(price_col, fast, partition_cols, order_col) - _mean(price_col, slow, partition_cols, order_col)
    df = df.withColumn("macd_line", line)
    df = df.withColumn("macd_signal", _mean("macd_line", signal, partition_cols, order_col))
    return df.withColumn("macd_hist", F.col("macd_line") - F.col("macd_signal"))


def add_bollinger(df: DataFrame, period: int = 20, std_dev: float = 2.0, price_col: str = "close", *,
                  partition_cols: Keys = ("symbol",), order_col: str = "date") -> DataFrame:
    """bb_mid, bb_upper, bb_lower with the sample standard deviation."""
    w = trailing_window(period, partition_cols, order_col)
    mid, sd = F.avg(price_col).over(w), F.stddev_samp(price_col).over(w)
    return df.withColumns({"bb_mid": mid, "_sd": sd}).withColumns(
        {
            "bb_upper": F.col("bb_mid") + F.lit(std_dev) * F.col("_sd"),
            "bb_lower": F.col("bb_mid") - F.lit(std_dev) * F.col("_sd"),
        }
    ).drop("_sd")


# ---- the fused bundle -----------------------------------------------------

def last_bars(df: DataFrame, rows: int, partition_cols: Keys = ("symbol",), order_col: str = "date") -> DataFrame:
    """The last ``rows`` rows of each series: all that a bundle value of its last row looks at is LOOKBACK + 1 rows.

    Spark keeps only so many rows per series in every input task (window group limit) before the shuffle.
    """
    newest = Window.partitionBy(*partition_cols).orderBy(F.col(order_col).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= rows).drop("_rank")


def _bundle(df: DataFrame, keys: Keys, order: Order, price_col: str = "close") -> DataFrame:
    """W09 in three projections; adds the ten curated indicator columns."""
    base = df.columns
    w_lag = _ordered(keys, order)
    lvl1 = df.withColumn("_prev", F.lag(price_col).over(w_lag))
    gain, loss = _gain_loss(F.col(price_col), F.col("_prev"))
    lvl1 = lvl1.withColumns({"_gain": gain, "_loss": loss})

    def m(col, n):
        return _mean(col, n, keys, order)

    # each distinct frame is evaluated once (Catalyst does not merge equal window
    # aggregates): ema_20 and bb_mid are the 20-row mean, RSI reads its means twice
    means = {n: f"_m{n}" for n in sorted({*SMA_PERIODS, EMA_PERIOD, BB_PERIOD, MACD_FAST, MACD_SLOW})}
    lvl2 = lvl1.select(
        *base,
        *[m(price_col, n).alias(name) for n, name in means.items()],
        m("_gain", RSI_PERIOD).alias("_avg_gain"),
        m("_loss", RSI_PERIOD).alias("_avg_loss"),
        F.stddev_samp(price_col).over(trailing_window(BB_PERIOD, keys, order)).alias("_sd"),
    )
    lvl3 = lvl2.select(
        *base,
        *means.values(),
        "_sd",
        _rsi(F.col("_avg_gain"), F.col("_avg_loss")).alias("rsi_14"),
        (F.col(means[MACD_FAST]) - F.col(means[MACD_SLOW])).alias("macd_line"),
    ).withColumn("macd_signal", m("macd_line", MACD_SIGNAL))
    bb_mid = F.col(means[BB_PERIOD])
    return lvl3.select(
        *base,
        F.col(means[SMA_PERIODS[0]]).alias("sma_20"),
        F.col(means[SMA_PERIODS[1]]).alias("sma_50"),
        F.col(means[EMA_PERIOD]).alias("ema_20"),
        "rsi_14",
        "macd_line",
        "macd_signal",
        (F.col("macd_line") - F.col("macd_signal")).alias("macd_hist"),
        (bb_mid + F.lit(BB_STD) * F.col("_sd")).alias("bb_upper"),
        bb_mid.alias("bb_mid"),
        (bb_mid - F.lit(BB_STD) * F.col("_sd")).alias("bb_lower"),
    )


def add_all_indicators(
    df: DataFrame,
    *,
    partition_cols: Keys = ("symbol",),
    order_col: str = "date",
    split_rows: int | None = None,
    hot_rows: int | None = None,
    tie_cols: Keys = (),
) -> DataFrame:
    """The fixed bundle (SMA 20/50, EMA 20, RSI 14, MACD 12-26-9, Bollinger 20x2).

    ``split_rows`` (optional) splits the rows into ranges of about that many, each
    with a LOOKBACK-row halo, so a hot symbol spreads over many tasks. With
    ``hot_rows`` only the series longer than that are split (into chunks of that many rows) and the
    rest take the plain plan. All plans return the same rows, NULL keys and NULL
    order values included. Bars are unique by key and ``order_col``; where rows are not, ``tie_cols`` order them
    (else their order is the engine's choice).
    """
    if split_rows is None:
        return _bundle(df, tuple(partition_cols), [order_col, *tie_cols])
    if hot_rows is None:
        return ranged_series(df, _bundle, LOOKBACK, split_rows, partition_cols, [order_col, *tie_cols])
    # hybrid: the long series are found by a map-side combined count; how to join with them is left to Spark
    keys = list(partition_cols)
    hot = df.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    same = _null_safe(df, keys, hot, [f"_h_{k}" for k in keys])
    cold_part = _bundle(df.join(hot, same, "left_anti"), tuple(keys), order_col)
    hot_part = split_series(df.join(hot, same, "left_semi"), _bundle, LOOKBACK, split_rows, keys, order_col)
    return cold_part.unionByName(hot_part)


def _null_safe(left: DataFrame, left_cols: Keys, right: DataFrame, right_cols: Keys) -> Column:
    """Equality of all column pairs in which NULL equals NULL."""
    pairs = [left[a].eqNullSafe(right[b]) for a, b in zip(left_cols, right_cols)]
    return functools.reduce(lambda x, y: x & y, pairs)


def ranged_series(df: DataFrame, fn, lookback: int, range_rows: int, partition_cols: Keys = ("symbol",), order_col: Order = "date") -> DataFrame:
    """Evaluate a trailing-window function ``fn(df, keys, order)`` over ranges of about ``range_rows`` rows.

    1. the rows are range-partitioned by (key, order), sorted in each range and written once with their place in it: however
       long one series is, its rows spread evenly (this is the plan's range shuffle);
    2. one aggregate gives every range's size, first and last key; from this the driver (one row a range) decides which last rows of
       which ranges precede which range: of the range before, and of earlier ones where those hold fewer than ``lookback``;
    3. these rows are handed on as halo, and ``fn`` runs over (key, range) in the order of places (one hash shuffle); halo copies are dropped.
    Remaining columns decide ties of ``order_col``. NULL keys and order values are values like others, first in order.
    """
    if range_rows <= lookback:
        raise ValueError("range_rows must exceed the lookback")
    spark, keys, cols = df.sparkSession, list(partition_cols), df.columns
    given = [*keys, *([order_col] if isinstance(order_col, str) else order_col)]
    ties = [f.name for f in df.schema.fields if f.name not in given and f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    total = [F.col(f"`{c}`") for c in given + ties]
    seen, path = Observation("series"), scratch_path(spark, "series")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/rows")
    ranges = max(1, -(-seen.get["n"] // range_rows))
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows").repartitionByRange(ranges, *total).sortWithinPartitions(*total)
    rows.withColumn("_at", F.monotonically_increasing_id()).write.parquet(f"{path}/ranged")
    ranged = spark.read.schema(StructType([*df.schema.fields, StructField("_at", LongType())])).parquet(f"{path}/ranged")
    ranged = ranged.withColumns({"_range": F.shiftright("_at", RANGE_BITS), "_place": F.col("_at").bitwiseAND(F.lit((1 << RANGE_BITS) - 1))})
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    known = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last"))
    lent = spark.createDataFrame(_lent_rows(sorted(known.collect()), lookback), "_from long, _least long, _to long")
    # at most ``lookback`` entries a range are broadcast
    halo = ranged.join(F.broadcast(lent), (F.col("_range") == F.col("_from")) & (F.col("_place") >= F.col("_least")))
    halo = halo.select(*cols, "_at", F.col("_to").alias("_range"), F.lit(True).alias("_halo"))
    every = ranged.select(*cols, "_at", "_range", F.lit(False).alias("_halo")).unionByName(halo)
    out = fn(every, (*keys, "_range"), "_at")
    extra = [c for c in out.columns if c not in cols and not c.startswith("_")]
    return out.filter(~F.col("_halo")).select(*cols, *extra)


def _lent_rows(ranges: list, lookback: int) -> list[tuple[int, int, int]]:
    """(from, least place, to): the rows before each range that its first series looks back on."""
    out = []
    for i, r in enumerate(ranges):
        need, j = lookback, i - 1
        while need > 0 and j >= 0 and ranges[j]["last"] == r["first"]:
            take = min(need, ranges[j]["n"])
            out.append((ranges[j]["_range"], ranges[j]["n"] - take, r["_range"]))
            need -= take
            if ranges[j]["first"] != r["first"]:
                break
            j -= 1
    return out


# monotonically_increasing_id() puts the range above this many bits and the row's place in it below
RANGE_BITS = 33

# a series is counted in this many buckets of about equal size
SPLIT_BUCKETS = 64


def split_series(
    df: DataFrame,
    fn,
    lookback: int,
    chunk_rows: int,
    partition_cols: Keys = ("symbol",),
    order_col: str = "date",
) -> DataFrame:
    """Evaluate a trailing-window function ``fn(df, keys, order)`` chunk by chunk.

    1. one aggregate gives each series' approximate quantiles of the order column; they cut it
       into ``SPLIT_BUCKETS`` buckets of about equal row counts, whatever its time scale
       (NULL order values are first, in a bucket of their own);
    2. exact counts per (key, bucket), a small table, and their running sum give each bucket's first position;
    3. row_number inside (key, bucket) completes the exact position in the series;
    4. rows go to chunk ``pos // chunk_rows``; the last ``lookback`` rows of a chunk
       are copied into the next chunk as halo;
    5. ``fn`` runs over (key, chunk) ordered by position; halo copies are dropped.
    Rows are sorted by (key, bucket) and (key, chunk) only. Joins are null-safe, so every row is kept.
    """
    if chunk_rows <= lookback:
        raise ValueError("chunk_rows must exceed the lookback")
    keys = list(partition_cols)
    cols = df.columns
    rank = _as_number(df, order_col)
    points = [i / SPLIT_BUCKETS for i in range(1, SPLIT_BUCKETS)]
    cuts = df.groupBy(*keys).agg(F.percentile_approx(rank, points, 4096).alias("_cuts"))
    cuts = cuts.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_cuts")
    bucket = F.when(rank.isNull(), -1).otherwise(F.size(F.filter("_cuts", lambda c: c <= rank)))
    bucketed = df.join(cuts, _null_safe(df, keys, cuts, [f"_c_{k}" for k in keys])).select(*cols, bucket.alias("_bkt"))
    counts = bucketed.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_bkt").alias("_o_bkt"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
    )
    rn = F.row_number().over(Window.partitionBy(*keys, "_bkt").orderBy(order_col))
    numbered = bucketed.withColumn("_rn", rn)
    placed = numbered.join(offsets, _null_safe(numbered, [*keys, "_bkt"], offsets, [*[f"_o_{k}" for k in keys], "_o_bkt"]))
    pos = F.col("_off") + F.col("_rn") - F.lit(1)
    placed = placed.withColumns({"_pos": pos, "_home": F.floor(pos / F.lit(chunk_rows))})
    in_halo = F.pmod(F.col("_pos"), F.lit(chunk_rows)) >= F.lit(chunk_rows - lookback)
    targets = F.when(in_halo, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array(F.col("_home")))
    copies = placed.select(*cols, "_pos", "_home", F.explode(targets).alias("_chunk"))
    out = fn(copies, tuple(keys) + ("_chunk",), "_pos")
    extra = [c for c in out.columns if c not in cols and not c.startswith("_")]
    return out.filter(F.col("_chunk") == F.col("_home")).select(*cols, *extra)


def _as_number(df: DataFrame, col: str) -> Column:
    """Order column as a number with the same order: days, microseconds, or its own value."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, DateType):
        return F.unix_date(F.col(col))
    if isinstance(dtype, TimestampNTZType):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(dtype, TimestampType):
        return F.unix_micros(F.col(col))
    return F.col(col)
