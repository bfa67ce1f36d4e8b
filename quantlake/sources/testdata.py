"""Market-shaped inputs derived by Spark from the given test tables.

* ``events_bars``   (E): daily bars per event type from ``events``.
* ``trade_bars``    (T): daily bars per brand from ``lineitem`` joined to ``part``.
* ``event_ticks``   (K): one tick per event, with day bar fields and previous close.
* ``dirty_bars``    (D): E on thirds of the value, with NULL / negative / repeated rows,
                         shaped as the raw zone (one ``date_partition`` per run).
* ``wide_history``  (W): E pivoted to one row per date, vendor-style column groups.

Every adapter is an aggregation or a join over the full tables, so its work
grows with the data. Adapter SQL twins for DuckDB live in ``plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantlake.functions.exprs import iso_timestamp

# ---- fixed values of the adapters ----------------------------------------
DIRTY_EPOCH = "2024-01-01"      # h = days since this date
DIRTY_NULL_CLOSE_EVERY = 13     # close NULL when h % 13 == 0
DIRTY_NEG_CLOSE_EVERY = 17      # else close negated when h % 17 == 0
DIRTY_NEG_VOLUME_EVERY = 19     # volume negated when h % 19 == 0
DIRTY_REPEAT_EVERY = 7          # row repeated (copy 0 and 1) when h % 7 == 0
DIRTY_RUN_DATE = "2024-02-01"   # run date of copy 0; copy 1 is the next day
TICK_NULL_OHL_EVERY = 5         # open/high/low NULL when event_id % 5 == 0
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_bars(spark: SparkSession, sf_dir: str, price_divisor: float | None = None) -> DataFrame:
    """E: symbol = event_type, date = day of ts, first/last value by (ts, event_id), volume = count."""
    ev = table(spark, sf_dir, "events").select("event_type", "ts", "value", "event_id")
    order = F.struct("ts", "event_id")
    price = F.col("value") if price_divisor is None else F.col("value") / F.lit(price_divisor)
    return (
        ev.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select("date", "symbol", "open", "high", "low", "close", "volume")
    )


_TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey")


def latest_trade_day(spark: SparkSession, sf_dir: str) -> dt.date | None:
    """The last ship day that a trade of a known part has: a column of lineitem and one of part are read."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    day = li.agg(F.to_date(F.max("l_shipdate"))).first()[0]
    if day is None or not _on_day(li, "l_shipdate", day).join(part, li.l_partkey == part.p_partkey, "left_semi").isEmpty():
        return day
    return li.join(part, li.l_partkey == part.p_partkey, "left_semi").agg(F.to_date(F.max("l_shipdate"))).first()[0]


def latest_event_day(spark: SparkSession, sf_dir: str) -> dt.date | None:
    return table(spark, sf_dir, "events").agg(F.to_date(F.max("ts"))).first()[0]


def _on_day(df: DataFrame, col: str, day: dt.date) -> DataFrame:
    """A range on the stored column, which the Parquet reader can use to skip row groups."""
    kind = df.schema[col].dataType
    return df.filter((F.col(col) >= F.lit(day).cast(kind)) & (F.col(col) < F.lit(day + dt.timedelta(days=1)).cast(kind)))


def trade_bars(spark: SparkSession, sf_dir: str, day: dt.date | None = None) -> DataFrame:
    """T (of one ``day`` or all): symbol = brand, date = ship day, price = extendedprice / quantity (unrounded).

    Open/close are the first/last trade by a total order of lineitem columns,
    taken as min/max of one struct of the order columns; the price of that trade
    is derived from the struct after the aggregate (it is a function of two of
    its fields), so nothing extra is carried per row.

    Plan: ``part`` is a dimension; AQE broadcasts it when small, otherwise the
    join is sort-merge and a hot part key is split by AQE's skew-join handling.
    The (brand, day) aggregate is combined map-side before its shuffle, so a
    hot brand or day is reduced in every task first.
    """
    li = table(spark, sf_dir, "lineitem").select(*_TRADE_ORDER, "l_shipdate")
    if day is not None:
        li = _on_day(li, "l_shipdate", day)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    trade = F.struct(*[F.col(c) for c in _TRADE_ORDER])
    joined = li.join(part, li.l_partkey == part.p_partkey)

    def px(t: str):
        return F.try_divide(F.col(f"{t}.l_extendedprice"), F.col(f"{t}.l_quantity"))

    return (
        joined.groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.min(trade).alias("first"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(trade).alias("last"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select("date", "symbol", px("first").alias("open"), "high", "low", px("last").alias("close"), "volume")
    )


def event_ticks(spark: SparkSession, sf_dir: str, day: dt.date | None = None) -> DataFrame:
    """K (of one ``day`` or all): one tick per event, in the landed-tick layout (plus ``symbol``).

    The day bar (and its previous close) is joined back to the events; the bar
    table has one row per (symbol, day), so AQE broadcasts it when small and
    falls back to a skew-split sort-merge join otherwise.
    """
    bars = events_bars(spark, sf_dir)
    w = Window.partitionBy("symbol").orderBy("date")
    bar = bars.select("symbol", "date", "open", "high", "low", F.lag("close").over(w).alias("prev_close"))
    events = table(spark, sf_dir, "events")
    if day is not None:
        events, bar = _on_day(events, "ts", day), bar.filter(F.col("date") == F.lit(day))
    ev = events.select(
        "event_id", "ts", "value", "props", F.col("event_type").alias("symbol"), F.to_date("ts").alias("date")
    )
    blank = F.col("event_id") % TICK_NULL_OHL_EVERY == 0
    return ev.join(bar, ["symbol", "date"]).select(
        "symbol",
        iso_timestamp("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"),
        *[F.when(blank, F.lit(None).cast("double")).otherwise(F.col(c)).alias(c) for c in ("open", "high", "low")],
        "prev_close",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("date").alias("date_partition"),
    )


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D: raw-zone rows with the dirt described in FIXTURES.md; ``date_partition`` = run date."""
    e = events_bars(spark, sf_dir, price_divisor=3.0)
    h = F.datediff(F.col("date"), F.lit(DIRTY_EPOCH).cast("date"))
    close = (
        F.when(h % DIRTY_NULL_CLOSE_EVERY == 0, F.lit(None).cast("double"))
        .when(h % DIRTY_NEG_CLOSE_EVERY == 0, -F.col("close"))
        .otherwise(F.col("close"))
    )
    volume = F.when(h % DIRTY_NEG_VOLUME_EVERY == 0, -F.col("volume")).otherwise(F.col("volume"))
    copies = F.when(h % DIRTY_REPEAT_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    run_date = F.date_add(F.lit(DIRTY_RUN_DATE).cast("date"), F.col("copy")).cast("string")
    return (
        e.withColumns({"close": close, "volume": volume})
        .withColumn("copy", F.explode(copies))
        .withColumn("date_partition", run_date)
        .drop("copy")
    )


WIDE_FIELDS = (("open", "Open"), ("high", "High"), ("low", "Low"), ("close", "Close"), ("volume", "Volume"))


def wide_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W: one row per ``Date`` with ``<symbol>_Open ... <symbol>_Volume`` column groups, of the symbols there are."""
    e = events_bars(spark, sf_dir)
    aggs = [F.first(src).alias(dst) for src, dst in WIDE_FIELDS]
    return e.groupBy(F.col("date").alias("Date")).pivot("symbol").agg(*aggs)
