"""Writes that fail in mid-write, replaced versions, and tables that follow a write's report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quantlake.paths import LakePaths
from quantlake.plans.batch import run_batch
from quantlake.schemas import CURATED_OHLCV, RAW_OHLCV, STAGING_OHLCV
from quantlake.sources import catalog as CAT
from quantlake.sources import lake, versions

D = dt.date


def frame(spark, schema, n, symbols=("A", "B"), run="2024-01-01", bump=0.0):
    """``n`` rows in each symbol, every column of ``schema`` filled."""
    base = spark.range(n * len(symbols)).withColumn("i", (F.col("id") / len(symbols)).cast("int"))
    values = {"date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")), "symbol": F.element_at(F.array(*map(F.lit, symbols)), (F.col("id") % len(symbols) + 1).cast("int")),
              "date_partition": F.lit(run), "ingested_at": F.lit("2024-01-01 00:00:00"), "volume": F.col("i")}
    return base.repartition(4).select(*[values.get(f.name, F.col("i") + F.lit(bump)).cast(f.dataType).alias(f.name) for f in schema.fields])


def broken(df):
    """Fails on one row, after other rows have been written."""
    bad = F.when((F.col("symbol") == "B") & (F.col("date") == F.lit("2024-01-03").cast("date")), F.raise_error(F.lit("bad row")).cast("double"))
    return df.withColumn("close", F.coalesce(bad, F.col("close")))


ZONES = {
    "raw": (RAW_OHLCV, lambda df, p: lake.write_raw(df, p, "2024-01-01"), lake.read_raw, CAT.create_raw_table),
    "staging": (STAGING_OHLCV, lambda df, p: lake.write_staging(df, p, "2024-01-01"), lake.read_staging, CAT.create_staging_table),
    "curated": (CURATED_OHLCV, lambda df, p: lake.write_curated(df, p), lake.read_curated, CAT.create_curated_table),
    "curated_part": (CURATED_OHLCV, lambda df, p: lake.write_curated(df, p, dynamic=True), lake.read_curated, CAT.create_curated_table),
}


@pytest.mark.parametrize("zone", ZONES)
def test_failed_write_leaves_the_old_rows(spark, tmp_root, zone):
    schema, write, read, create = ZONES[zone]
    paths, db = LakePaths(tmp_root), f"qltest_fail_{zone}"
    assert write(frame(spark, schema, 50), paths) == 100
    CAT.create_database(spark, db, location=f"{tmp_root}/wh", use=False)
    table = create(spark, paths, db)
    CAT.repair(spark, table)
    before = sorted(map(str, read(spark, paths).collect()))
    with pytest.raises(Exception, match="bad row"):
        write(broken(frame(spark, schema, 60, bump=1.0)), paths)
    spark.catalog.refreshTable(table)
    assert sorted(map(str, read(spark, paths).collect())) == before and len(before) == 100
    assert spark.table(table).count() == 100
    assert write(frame(spark, schema, 60, bump=1.0), paths) == 120        # and the next write is seen as a whole
    assert spark.table(table).count() == 100                              # the table, once it is told
    CAT.repair(spark, table)
    assert read(spark, paths).count() == spark.table(table).count() == 120
    assert read(spark, paths).agg(F.min("close")).first()[0] == 1.0


def test_a_dead_driver_leaves_an_ignored_version(spark, tmp_root):
    """Part of a version's files are there, but nothing says that the job ended."""
    paths = LakePaths(tmp_root)
    lake.write_curated(frame(spark, CURATED_OHLCV, 5), paths)
    full = lake.land_curated(frame(spark, CURATED_OHLCV, 9, bump=5.0), paths)
    part = lake.land_curated(frame(spark, CURATED_OHLCV, 7, ("B",), bump=9.0), paths, dynamic=True)
    for commit in (part, full):
        versions.delete(spark, f"{commit.path}/_SUCCESS")
    assert lake.read_curated(spark, paths).count() == 10 and lake.read_curated(spark, paths).agg(F.max("close")).first()[0] == 4.0
    assert versions.sweep(spark, paths.curated_ohlcv, "symbol", keep=0) == []        # they may still be written
    lake.write_curated(frame(spark, CURATED_OHLCV, 3), paths)
    assert lake.read_curated(spark, paths).count() == 6


def test_parts_replace_partitions_and_full_replaces_all(spark, tmp_root):
    paths = LakePaths(tmp_root)
    odd = ("A", "a b", "Brand#11", "x=y/z%", "é")
    lake.write_curated(frame(spark, CURATED_OHLCV, 4, odd), paths)
    assert {r["symbol"] for r in lake.read_curated(spark, paths).collect()} == set(odd)
    lake.write_curated(frame(spark, CURATED_OHLCV, 2, ("Brand#11", "new", "é"), bump=50.0), paths, dynamic=True)
    lake.write_curated(frame(spark, CURATED_OHLCV, 1, ("new",), bump=90.0), paths, dynamic=True)
    got = {(r["symbol"], r["n"], r["x"]) for r in lake.read_curated(spark, paths).groupBy("symbol").agg(F.count("*").alias("n"), F.max("close").alias("x")).collect()}
    assert got == {("A", 4, 3.0), ("a b", 4, 3.0), ("x=y/z%", 4, 3.0), ("Brand#11", 2, 51.0), ("é", 2, 51.0), ("new", 1, 90.0)}
    live = versions.live(spark, paths.curated_ohlcv, "symbol")
    assert set(live) == {*odd, "new"}
    assert {versions.folder_of("symbol", v) for v in live} == {p.rsplit("/", 1)[1] for p in live.values()}
    plan = lake.read_curated(spark, paths).filter("symbol = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan
    lake.write_curated(frame(spark, CURATED_OHLCV, 1, ("A",)), paths)
    assert [r["symbol"] for r in lake.read_curated(spark, paths).collect()] == ["A"]
    lake.write_curated(frame(spark, CURATED_OHLCV, 1).limit(0), paths)
    assert lake.read_curated(spark, paths).count() == 0


def test_sweep_keeps_what_is_live_and_the_last_replaced(spark, tmp_root):
    paths = LakePaths(tmp_root)
    for day in ("2024-01-01", "2024-01-02"):
        for bump in (0.0, 1.0, 2.0):
            lake.write_raw(frame(spark, RAW_OHLCV, 3, bump=bump), paths, day)
    gone = versions.sweep(spark, paths.raw_ohlcv, "date_partition", keep=1)
    assert len(gone) == 3 and len(versions.children(spark, paths.raw_ohlcv)) == 3
    assert lake.read_raw(spark, paths).agg(F.count("*"), F.max("close")).first() == (12, 4.0)
    assert lake.landed_runs(spark, paths) == ["2024-01-01", "2024-01-02"]


def test_flat_folders_of_an_older_layout_are_read(spark, tmp_root):
    paths = LakePaths(tmp_root)
    for day in ("2024-01-01", "2024-01-02"):
        frame(spark, RAW_OHLCV, 3).drop("date_partition").write.parquet(f"{paths.raw_ohlcv}/date_partition={day}")
    assert lake.read_raw(spark, paths).count() == 12 and lake.landed_runs(spark, paths) == ["2024-01-01", "2024-01-02"]
    lake.write_raw(frame(spark, RAW_OHLCV, 1, bump=7.0), paths, "2024-01-02")
    assert lake.read_raw(spark, paths).count() == 8 and lake.read_raw(spark, paths, "2024-01-02").count() == 2
    assert lake.read_raw(spark, LakePaths(f"{tmp_root}/none")).count() == 0


def test_publish_follows_the_report(spark, tmp_root):
    paths, db = LakePaths(tmp_root), "qltest_publish"
    CAT.create_database(spark, db, location=f"{tmp_root}/wh", use=False)
    table = CAT.create_curated_table(spark, paths, db)
    done = lake.land_curated(frame(spark, CURATED_OHLCV, 4, ("A", "Brand#11", "it's")), paths)
    assert CAT.publish(spark, table, done.partitions, whole=True) == {"added": 3, "moved": 0, "dropped": 0}
    done = lake.land_curated(frame(spark, CURATED_OHLCV, 2, ("A", "C")), paths, dynamic=True)
    assert CAT.publish(spark, table, done.partitions) == {"added": 1, "moved": 1, "dropped": 0}
    assert sorted(map(str, spark.table(table).collect())) == sorted(map(str, lake.read_curated(spark, paths).collect()))
    CAT.analyze(spark, table, values=["A", "it's"], columns=("close",))
    assert CAT.partition_row_counts(spark, table) == {"A": 2, "C": None, "Brand#11": None, "it's": 4}
    assert CAT.column_statistics(spark, table, "close")["max"] == "3.0"
    done = lake.land_curated(frame(spark, CURATED_OHLCV, 1, ("A",)), paths)
    assert CAT.publish(spark, table, done.partitions, whole=True)["dropped"] == 3
    assert spark.table(table).count() == 1


def test_failed_run_keeps_the_database_and_sweeps_later(spark, tmp_root, monkeypatch):
    from quantlake.plans import batch

    paths, db = LakePaths(tmp_root), "qltest_run"
    for day in (1, 2, 3):
        lake.write_raw(frame(spark, RAW_OHLCV, 4, bump=float(day)), paths, f"2024-01-0{day}")
    run_batch(spark, paths, "2024-01-01", ingested_at="2024-01-01 00:00:00", database=db)
    before = sorted(map(str, spark.table(f"{db}.v_daily_summary").collect()))
    with monkeypatch.context() as m:
        m.setattr(batch, "add_all_indicators", lambda h, **kw: broken(h))
        with pytest.raises(Exception, match="bad row"):
            run_batch(spark, paths, "2024-01-02", ingested_at="2024-01-02 00:00:00", database=db)
    assert sorted(map(str, spark.table(f"{db}.v_daily_summary").collect())) == before and len(before) == 8
    for day in (2, 3):
        run_batch(spark, paths, f"2024-01-0{day}", ingested_at=f"2024-01-0{day} 00:00:00", database=db)
    assert spark.table(f"{db}.curated_ohlcv").agg(F.max("close")).first()[0] == 6.0
    kept = [n for n in versions.children(spark, paths.curated_ohlcv) if n.startswith("version=")]
    assert len(kept) <= 3
