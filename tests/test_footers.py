"""Column ranges from Parquet footers, and listings with places."""

import datetime as dt

from pyspark.sql import functions as F

from quantlake.paths import LakePaths
from quantlake.plans import measures as M
from quantlake.plans import views as V
from quantlake.sources import lake
from quantlake.sources.footers import footer_frame, footer_range

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_is_pushed_into_the_footers(spark, tmp_path):
    days = spark.range(1000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 77).cast("int")).alias("date"), "id")
    days.repartition(4).write.parquet(f"{tmp_path}/x")
    text = plan(footer_frame(spark, f"{tmp_path}/x", "date"))
    assert "PushedAggregation: [MIN(date), MAX(date)]" in text
    assert "ReadSchema: struct<min(date):date,max(date):date>" in text        # two values a file, not the column
    assert footer_range(spark, f"{tmp_path}/x", "date") == (dt.date(2024, 1, 1), dt.date(2024, 3, 17))
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")   # the caller's settings stay
    ts = footer_range(spark, f"{SF}/events.parquet", "ts")                    # a type that isn't pushed
    assert ts == tuple(spark.read.parquet(f"{SF}/events.parquet").agg(F.min("ts"), F.max("ts")).first())


def test_range_of_files_without_statistics(spark, tmp_path):
    spark.range(5).withColumn("d", F.lit(1.5)).write.option("parquet.column.statistics.enabled", "false").parquet(f"{tmp_path}/x")
    assert footer_range(spark, f"{tmp_path}/x", "id") == (0, 4)
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert footer_range(spark, f"{tmp_path}/none", "id") == (None, None)


def test_days_of_the_curated_zone(spark, tmp_root):
    paths = LakePaths(tmp_root)
    assert lake.curated_days(spark, paths) == (None, None)
    schema = lake.CURATED_OHLCV
    rows = [(dt.date(2024, 1, d), s) for d in (3, 9, 5) for s in ("A", "B#")]
    df = spark.createDataFrame(rows, "date date, symbol string")
    full = df.select(*[F.col(f.name) if f.name in ("date", "symbol") else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    lake.write_curated(full, paths)
    assert lake.curated_days(spark, paths) == (dt.date(2024, 1, 3), dt.date(2024, 1, 9))
    assert {(r["symbol"], r["date"]) for r in lake.read_latest_day(spark, paths).collect()} == {("A", dt.date(2024, 1, 9)), ("B#", dt.date(2024, 1, 9))}
    lake.write_curated(full.where("symbol = 'A' and date < '2024-01-05'"), paths)
    assert lake.curated_days(spark, paths) == (dt.date(2024, 1, 3), dt.date(2024, 1, 3))


def test_listings_in_all_orders(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", None), ("C", 3.0), ("D", 1.0), (None, 2.0)], "symbol string, band_width double")
    named = lambda c: df.withColumnRenamed("band_width", c)
    places = lambda order, c: [r["symbol"] for r in M.placed(named(c), order).orderBy("place").collect()]
    for order, (column, way) in M.LISTINGS.items():
        got = places(order, "band_width" if column == "symbol" else column)
        assert got == {"desc": ["C", None, "A", "D", "B"], "asc": ["B", "A", "D", None, "C"]}[way] if column != "symbol" else got == [None, "A", "B", "C", "D"]
        text = plan(M.placed(named("band_width" if column == "symbol" else column), order))
        assert "SinglePartition" not in text


def test_presentation_orders_by_symbol_then_time(spark):
    df = spark.createDataFrame([("B", "2"), ("A", "3"), ("B", "1"), ("A", "1")], "symbol string, tick_time string")
    assert [tuple(r) for r in V.presentation(df, "symbol", "tick_time").collect()] == [("A", "1"), ("A", "3"), ("B", "1"), ("B", "2")]
