"""Zones, the daily batch job, the catalog, the universe and the wide-history reshape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quantlake.paths import LakePaths
from quantlake.plans.batch import EmptyRunError, refresh_catalog, run_batch, run_ingest
from quantlake.sources import catalog as CAT
from quantlake.sources import lake
from quantlake.sources.universe import in_universe, read_universe, universe_frame
from quantlake.sources.wide import EmptyHistoryError, normalize_wide

RAW = "date date, symbol string, open double, high double, low double, close double, volume bigint"
D = dt.date


def bars(spark, days, symbols=("A", "B"), bump=0.0):
    rows = []
    for s in symbols:
        for i, d in enumerate(days):
            px = 10.0 + i + bump
            rows.append((d, s, px, px + 1, px - 1, px, 100 + i))
    return spark.createDataFrame(rows, RAW)


def test_two_runs_overlap_newest_wins(spark, tmp_root):
    paths = LakePaths(tmp_root)
    run1 = [D(2024, 1, d) for d in (1, 2, 3, 4)]
    run2 = [D(2024, 1, d) for d in (3, 4, 5)]          # overlaps run 1 on the 3rd and 4th
    assert lake.write_raw(bars(spark, run1), paths, "2024-01-04") == 8
    r1 = run_batch(spark, paths, "2024-01-04", ingested_at="2024-01-04 18:00:00")
    assert (r1.staging_rows, r1.curated_rows) == (8, 8)
    lake.write_raw(bars(spark, run2, bump=100.0), paths, "2024-01-05")
    r2 = run_batch(spark, paths, "2024-01-05", ingested_at="2024-01-05 18:00:00")
    assert r2.staging_rows == 6 and r2.curated_rows == 10   # 5 distinct days x 2 symbols
    cur = lake.read_curated(spark, paths)
    got = {(r["symbol"], r["date"]): (r["close"], r["ingested_at"]) for r in cur.collect()}
    assert got[("A", D(2024, 1, 3))] == (110.0, "2024-01-05 18:00:00")   # newest run wins
    assert got[("A", D(2024, 1, 2))] == (11.0, "2024-01-04 18:00:00")
    assert set(cur.columns) >= {"sma_20", "bb_lower", "ingested_at", "symbol"}
    # raw read is pruned to one run date
    assert lake.read_raw(spark, paths, "2024-01-05").count() == 6


def test_curated_static_vs_dynamic_overwrite(spark, tmp_root):
    paths = LakePaths(tmp_root)
    lake.write_raw(bars(spark, [D(2024, 1, 1)], ("A", "B")), paths, "2024-01-01")
    run_batch(spark, paths, "2024-01-01", ingested_at="2024-01-01 00:00:00")
    only_a = lake.read_curated(spark, paths).filter("symbol = 'A'")
    frozen = spark.createDataFrame(only_a.collect(), only_a.schema)
    lake.write_curated(frozen, paths, dynamic=True)
    assert {r["symbol"] for r in lake.read_curated(spark, paths).collect()} == {"A", "B"}
    lake.write_curated(frozen, paths, dynamic=False)
    assert {r["symbol"] for r in lake.read_curated(spark, paths).collect()} == {"A"}


def test_empty_run_changes_nothing(spark, tmp_root):
    paths = LakePaths(tmp_root)
    lake.write_raw(bars(spark, [D(2024, 1, 4)]), paths, "2024-01-04")
    run_batch(spark, paths, "2024-01-04", ingested_at="2024-01-04 18:00:00")
    lake.write_staging(bars(spark, [D(2024, 1, 5)]).withColumn("ingested_at", F.lit("2024-01-05 00:00:00").cast("timestamp")), paths, "2024-01-05")
    before = (sorted(lake.read_staging(spark, paths).collect()), sorted(lake.read_curated(spark, paths).collect()))
    with pytest.raises(EmptyRunError):
        run_batch(spark, paths, "2024-01-05")
    assert before == (sorted(lake.read_staging(spark, paths).collect()), sorted(lake.read_curated(spark, paths).collect()))
    assert run_batch(spark, paths, "2024-01-05", allow_empty=True).staging_rows == 0


def test_run_is_pruned_to_its_partition(spark, tmp_root):
    paths = LakePaths(tmp_root)
    two = bars(spark, [D(2024, 1, 1)]).withColumn("date_partition", F.lit("2024-01-01"))
    lake.write_raw_runs(two.unionByName(two.withColumn("date_partition", F.lit("2024-01-02"))), paths)
    assert lake.landed_runs(spark, paths) == ["2024-01-01", "2024-01-02"]
    plan = lake.read_raw(spark, paths, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_partition" in plan


def test_history_is_shuffled_and_sorted_once(spark, tmp_root):
    from quantlake.operators.indicators import add_all_indicators

    paths = LakePaths(tmp_root)
    lake.write_raw(bars(spark, [D(2024, 1, d) for d in range(1, 9)]), paths, "2024-01-08")
    run_batch(spark, paths, "2024-01-08", ingested_at="2024-01-08 18:00:00")
    staging = lake.read_staging(spark, paths)
    plan = add_all_indicators(lake.history_by_symbol(staging))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert sorted(lake.history_by_symbol(staging).collect()) == sorted(lake.latest_per_bar(staging).select(*staging.columns).collect())


def test_ingest_then_batch_then_views(spark, tmp_root):
    paths, db = LakePaths(tmp_root), "qltest_views"
    wide = spark.createDataFrame(
        [(f"2024-01-{d:02d}", 1.0 + d, 3.0 + d, 0.5, 2.0 + d, 10 * d) for d in range(1, 8)],
        "Date string, AAA_Open double, AAA_High double, AAA_Low double, AAA_Close double, AAA_Volume bigint")
    assert run_ingest(spark, paths, wide, "2024-01-07") == 7
    with pytest.raises(EmptyHistoryError):
        run_ingest(spark, paths, wide.filter(F.lit(False)), "2024-01-07")
    assert lake.read_raw(spark, paths, "2024-01-07").count() == 7
    run_batch(spark, paths, "2024-01-07", ingested_at="2024-01-07 18:00:00", database=db)
    assert spark.table(f"{db}.v_daily_summary").count() == 7 and spark.table(f"{db}.v_top_movers").count() == 1
    more = wide.withColumns({c.replace("AAA", "NEW"): F.col(c) for c in wide.columns if c != "Date"})
    run_ingest(spark, paths, more, "2024-01-08")
    run_batch(spark, paths, "2024-01-08", ingested_at="2024-01-08 18:00:00", database=db)
    assert {r["symbol"] for r in spark.table(f"{db}.v_top_movers").collect()} == {"AAA", "NEW"}
    assert len(refresh_catalog(spark, paths, db)) == 5


def test_universe_from_a_file(spark, tmp_path):
    (tmp_path / "symbols.txt").write_text("aaa\n\n# all of these\nBBB # note\nAAA\n")
    assert sorted(r["symbol"] for r in read_universe(spark, str(tmp_path / "symbols.txt")).collect()) == ["AAA", "BBB"]


def test_catalog_tables_and_repair(spark, tmp_root):
    paths = LakePaths(tmp_root)
    db = "qltest_catalog"
    CAT.create_database(spark, db, location=f"{tmp_root}/wh", use=False)
    name = CAT.create_raw_table(spark, paths, db)
    lake.write_raw(bars(spark, [D(2024, 1, 1)]), paths, "2024-01-01")
    lake.write_raw(bars(spark, [D(2024, 1, 2)]), paths, "2024-01-02")
    assert CAT.partitions(spark, name).count() == 0
    CAT.repair(spark, name)
    assert CAT.partitions(spark, name).count() == 2
    assert CAT.query_view(spark, name).count() == 4
    CAT.analyze(spark, name)
    CAT.analyze(spark, name, ("date_partition",))          # per-partition statistics
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION (date_partition='2024-01-02')").collect()
    assert any("rows" in (r["data_type"] or "") for r in stats if r["col_name"] == "Partition Statistics")
    cur = CAT.create_curated_table(spark, paths, db)
    comments = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {cur}").collect()}
    assert comments["sma_20"] == "sma_20"
    ticks = CAT.create_ticks_table(spark, paths, db)
    assert {"date_partition", "symbol"} <= set(spark.table(ticks).columns)


def test_universe_semi_join(spark):
    df = bars(spark, [D(2024, 1, 1)], ("A", "B", "C"))
    uni = universe_frame(spark, ["A", "C", "C", "Z"])
    assert sorted(r["symbol"] for r in in_universe(df, uni).collect()) == ["A", "C"]


def test_normalize_wide_skips_absent_and_fails_on_empty(spark):
    wide = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 0.5, 1.5, 10, 3.0, 4.0, 2.5, 3.5, 20)],
        "Date string, `AAA.XC_Open` double, `AAA.XC_High` double, `AAA.XC_Low` double, "
        "`AAA.XC_Close` double, `AAA.XC_Volume` bigint, BBB_Open double, BBB_High double, "
        "BBB_Low double, BBB_Close double, BBB_Volume bigint",
    )
    out = {r["symbol"]: r for r in normalize_wide(wide, ["AAA.XC", "BBB", "MISSING"]).collect()}
    assert set(out) == {"AAA.XC", "BBB"}
    assert out["BBB"]["close"] == 3.5 and out["BBB"]["volume"] == 20 and out["BBB"]["date"] == D(2024, 1, 2)
    with pytest.raises(EmptyHistoryError):
        normalize_wide(wide, ["NOPE"])
    assert {r["symbol"] for r in normalize_wide(wide).collect()} == {"AAA.XC", "BBB"}


def test_batch_split_matches_plain(spark, tmp_path):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    rows = [(d, s, 10.0 + (i * 7 % 13), 30.0, 1.0, 10.0 + (i * 5 % 11), 100)
            for s, n in (("HOT", 120), ("A", 40), ("B", 25)) for i, d in enumerate(days[:n])]
    raw = spark.createDataFrame(rows, RAW)
    out = {}
    for mode, kw in (("plain", {"split_rows": None}), ("auto", {"split_rows": 99})):
        paths = LakePaths(str(tmp_path / mode))
        lake.write_raw(raw, paths, "2024-05-01")
        res = run_batch(spark, paths, "2024-05-01", ingested_at="2024-05-01 00:00:00", **kw)
        out[mode] = (res, sorted(lake.read_curated(spark, paths).drop("ingested_at").collect()))
    assert out["plain"][0].split_rows is None and out["auto"][0].split_rows == 99
    assert out["auto"][1] == out["plain"][1]
