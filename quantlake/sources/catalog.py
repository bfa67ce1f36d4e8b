"""Catalog tables over the lake folders.

Works with Spark's built-in session catalog (no external metastore needed):
tables are created over existing locations. A job registers the partitions it has
written from its own report (``publish``): partitions are added at, or moved to, the folders of the new version, one
by one and each as a whole. ``repair`` does the same for everything that a zone holds, or leaves it to
``recoverPartitions`` where a folder has no versions. Statistics are refreshed with ``ANALYZE``, of
the table or of single partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from quantlake.paths import LakePaths
from quantlake.schemas import CURATED_OHLCV, RAW_OHLCV, RAW_TICKS, STAGING_OHLCV, ddl
from quantlake.sources import versions

RAW_TABLE = "raw_ohlcv"
STAGING_TABLE = "staging_ohlcv"
CURATED_TABLE = "curated_ohlcv"
TICKS_TABLE = "raw_ticks"
#: Partitions named in one ALTER TABLE
BATCH = 200


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_database(spark: SparkSession, db: str, location: str | None = None, use: bool = True) -> None:
    """CREATE DATABASE IF NOT EXISTS (optionally at a shared location) and USE it."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(db)}{loc}")
    if use:
        spark.catalog.setCurrentDatabase(db)


def _create(spark: SparkSession, name: str, schema, partitions: tuple[str, ...], location: str,
            comment: str | None = None) -> None:
    cols = ddl(schema, exclude=partitions)
    part_ddl = ", ".join(f"`{p}` {schema[p].dataType.simpleString().upper()}" for p in partitions)
    text = f"CREATE TABLE IF NOT EXISTS {_q(name)} ({cols}, {part_ddl}) USING parquet"
    text += f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})"
    if comment:
        text += " COMMENT '" + comment.replace("'", "\\'") + "'"
    text += f" LOCATION '{location}'"
    spark.sql(text)


def create_raw_table(spark: SparkSession, paths: LakePaths, db: str | None = None) -> str:
    """Raw bars, partitioned by run date."""
    name = f"{db}.{RAW_TABLE}" if db else RAW_TABLE
    _create(spark, name, RAW_OHLCV, ("date_partition",), paths.raw_ohlcv)
    return name


def create_staging_table(spark: SparkSession, paths: LakePaths, db: str | None = None) -> str:
    """Cleaned bars of each run, partitioned by run date."""
    name = f"{db}.{STAGING_TABLE}" if db else STAGING_TABLE
    _create(spark, name, STAGING_OHLCV, ("date_partition",), paths.staging_ohlcv)
    return name


def create_curated_table(spark: SparkSession, paths: LakePaths, db: str | None = None) -> str:
    """Curated bars with column comments, partitioned by symbol."""
    name = f"{db}.{CURATED_TABLE}" if db else CURATED_TABLE
    _create(spark, name, CURATED_OHLCV, ("symbol",), paths.curated_ohlcv, "curated_ohlcv table")
    return name


def create_ticks_table(spark: SparkSession, paths: LakePaths, db: str | None = None) -> str:
    """Landed ticks, partitioned by day then symbol."""
    name = f"{db}.{TICKS_TABLE}" if db else TICKS_TABLE
    _create(spark, name, RAW_TICKS, ("date_partition", "symbol"), paths.raw_ticks,
            "ticks landed by the streaming job")
    return name


def is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _spec(key: str, value: str | None) -> str:
    if value is None:
        return f"PARTITION (`{key}` = null)"
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"PARTITION (`{key}` = '{text}')"


def publish(spark: SparkSession, table: str, folders: dict[str | None, str], whole: bool = False) -> dict[str, int]:
    """Make ``table`` read the partitions in ``folders`` (value -> folder), as a write reports them.

    Partitions new to the table are added, others moved by one ALTER each, so a reader sees every partition
    either before or after. ``whole``: partitions that are not in ``folders`` go, last. The work follows the folders, not
    the lake; the catalog's own list of partition names is all that is read besides.
    """
    key = partition_columns(spark, table)[0]
    known = {versions.value_of(r[0]) for r in partitions(spark, table).collect()}
    new, moved = [v for v in folders if v not in known], [v for v in folders if v in known]
    for i in range(0, len(new), BATCH):
        specs = " ".join(f"{_spec(key, v)} LOCATION '{folders[v]}'" for v in new[i : i + BATCH])
        spark.sql(f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS {specs}")
    for v in moved:
        spark.sql(f"ALTER TABLE {_q(table)} {_spec(key, v)} SET LOCATION '{folders[v]}'")
    gone = sorted(known - set(folders), key=str) if whole else []
    for i in range(0, len(gone), BATCH):
        spark.sql(f"ALTER TABLE {_q(table)} DROP IF EXISTS {', '.join(_spec(key, v) for v in gone[i : i + BATCH])}")
    spark.catalog.refreshTable(table)
    return {"added": len(new), "moved": len(moved), "dropped": len(gone)}


def repair(spark: SparkSession, table: str) -> bool:
    """Register partition folders written outside the catalog.

    A zone with versions is registered as its readers by path see it. A table created over a streaming sink's
    folder after the sink has written is read through the sink's commit log (``_spark_metadata``), which already
    knows every committed file and its partition values; Spark registers such
    a table without catalog partitions, and there is nothing to recover.
    Returns whether partitions were recovered.
    """
    if not is_partitioned(spark, table):
        return False
    keys, zone = partition_columns(spark, table), location(spark, table)
    folders = versions.live(spark, zone, keys[0]) if len(keys) == 1 else {}
    if any("/version=" in f for f in folders.values()):
        publish(spark, table, folders, whole=True)
    else:
        spark.catalog.recoverPartitions(table)
    return True


def analyze(spark: SparkSession, table: str, partition_cols: tuple[str, ...] = (), values: Iterable[str | None] | None = None,
            columns: tuple[str, ...] = ()) -> None:
    """Statistics for the optimizer, of the table, per partition (``partition_cols``), or of the partitions
    ``values`` only, such as those that a run has changed; ``columns``: of these columns of the table too."""
    if values is not None:
        key = partition_columns(spark, table)[0]
        for v in values:
            spark.sql(f"ANALYZE TABLE {_q(table)} {_spec(key, v)} COMPUTE STATISTICS")
    else:
        part = f" PARTITION ({', '.join(partition_cols)})" if partition_cols else ""
        spark.sql(f"ANALYZE TABLE {_q(table)}{part} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {_q(table)} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")


def _rows_in(text: str) -> int | None:
    return int(text.split(" rows")[0].split(",")[-1]) if "rows" in text else None


def row_count(spark: SparkSession, table: str) -> int | None:
    """The row count that ANALYZE recorded, or None."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}").collect():
        if r["col_name"] == "Statistics":
            return _rows_in(r["data_type"])
    return None


def partition_row_counts(spark: SparkSession, table: str, values: Iterable[str | None] | None = None) -> dict[str | None, int | None]:
    """The row count that ANALYZE recorded for each partition (or for ``values``); None: not analyzed."""
    key = partition_columns(spark, table)[0]
    if values is None:
        values = [versions.value_of(r[0]) for r in partitions(spark, table).collect()]
    out: dict[str | None, int | None] = {}
    for v in values:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)} {_spec(key, v)}").collect()
        out[v] = next((_rows_in(r["data_type"]) for r in rows if r["col_name"] == "Partition Statistics"), None)
    return out


def column_statistics(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """What ANALYZE recorded about a column: min, max, num_nulls, distinct_count and lengths."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)} `{column}`").collect()
    return {r["info_name"]: r["info_value"] for r in rows if r["info_value"] not in ("NULL", None)}


def partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_q(table)}")


_CHANGE = "round(try_divide({new} - {base}, {base}) * 100, 2)"

#: View name -> query over {t}, the curated or ticks table. "Today" is the current date.
VIEW_SQL = {
    "v_daily_summary": "SELECT symbol, CAST(date AS STRING) AS trade_date, open, high, low, close, volume, "
    + _CHANGE.format(new="close", base="open")
    + " AS daily_change_pct, sma_20, sma_50, rsi_14, macd_line, bb_upper, bb_lower FROM {t}",
    "v_weekly_rollup": "SELECT symbol, CAST(trunc(date, 'week') AS STRING) AS week_start, min(low) AS week_low, max(high) AS week_high, "
    "sum(volume) AS week_volume, min_by(open, date) AS week_open, max_by(close, date) AS week_close FROM {t} GROUP BY symbol, trunc(date, 'week')",
    "v_top_movers": "SELECT symbol, CAST(date AS STRING) AS trade_date, open, close, "
    + _CHANGE.format(new="close", base="open") + " AS change_pct, abs(" + _CHANGE.format(new="close", base="open")
    + ") AS abs_change_pct FROM {t} WHERE date = (SELECT max(date) FROM {t})",
    "v_rsi_signals": "SELECT symbol, CAST(date AS STRING) AS trade_date, close, rsi_14, CASE WHEN rsi_14 >= 70 THEN 'overbought' "
    "WHEN rsi_14 <= 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal FROM {t} WHERE rsi_14 IS NOT NULL",
    "v_bollinger_squeeze": "SELECT symbol, CAST(date AS STRING) AS trade_date, close, bb_upper, bb_lower, "
    "round(bb_upper - bb_lower, 4) AS band_width FROM {t} WHERE bb_upper IS NOT NULL",
}
_TICK_DAY = "SELECT * FROM {t} WHERE date_partition = {day}"
TICK_VIEW_SQL = {
    "v_latest_ticks": "WITH day AS (" + _TICK_DAY + "), newest AS (SELECT symbol, max_by(struct(*), struct(event_time, timestamp, price, volume, "
    "prev_close, open, high, low)) AS r FROM day GROUP BY symbol) SELECT symbol, r.timestamp AS tick_time, r.price, "
    "coalesce(r.volume, 0) AS volume, coalesce(r.open, r.price) AS open, coalesce(r.high, r.price) AS high, coalesce(r.low, r.price) AS low, "
    "r.prev_close, " + _CHANGE.format(new="r.price", base="r.prev_close") + " AS change_pct, "
    "round(try_divide(coalesce(r.high, r.price) - coalesce(r.low, r.price), r.prev_close) * 100, 2) AS intraday_range_pct, "
    "CASE WHEN pmod(floor(unix_seconds(r.event_time) / 60), 1440) BETWEEN 420 AND 750 "
    "AND dayofweek(date_from_unix_date(CAST(floor(unix_seconds(r.event_time) / 86400) AS INT))) BETWEEN 2 AND 6 "
    "AND coalesce(r.volume, 0) > 0 THEN 'LIVE' ELSE 'CLOSED' END AS market_status FROM newest",
    "v_tick_history": "SELECT symbol, timestamp AS tick_time, price, volume, " + _CHANGE.format(new="price", base="prev_close")
    + " AS change_pct FROM (" + _TICK_DAY + ")",
}


def create_views(spark: SparkSession, db: str, ticks: bool = False, latest_day: bool = False) -> list[str]:
    """The views as catalog objects of ``db``, over its tables; they outlive the session that made them.

    ``latest_day``: the tick views show the greatest day present instead of the current date.
    """
    made = {n: q.format(t=f"{_q(db)}.{CURATED_TABLE}") for n, q in VIEW_SQL.items()}
    if ticks:
        t = f"{_q(db)}.{TICKS_TABLE}"
        day = f"(SELECT max(date_partition) FROM {t})" if latest_day else "current_date()"
        made |= {n: q.format(t=t, day=day) for n, q in TICK_VIEW_SQL.items()}
    for name, query in made.items():
        spark.sql(f"CREATE OR REPLACE VIEW {_q(db)}.{name} AS {query}")
    return [f"{db}.{n}" for n in made]


def query_view(spark: SparkSession, name: str) -> DataFrame:
    """Read a registered view or table by name."""
    return spark.table(name)
