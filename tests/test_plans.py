"""Plan properties that matter at scale, asserted on the physical plans."""

import contextlib
import io

import pytest

import __spark_entry__ as ep
from quantlake.paths import LakePaths
from quantlake.plans import views as V
from quantlake.plans.registry import QUERIES as REGISTRY
from quantlake.sources import lake

SF = "/root/testdata/sf0.001"
WRITERS = {"stream_tick_sink", "lake_roundtrip", "catalog_repair", "raw_partition_scan", "registered_views", "table_statistics"}


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITERS))
def test_no_python_no_cartesian_no_global_window(spark, name):
    p = plan(ep.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, bad
    # every window is partitioned (a window without PARTITION BY runs in one task)
    for line in p.splitlines():
        if "Window [" in line:
            assert "], [" in line and not line.rstrip().endswith("[]"), line


def test_top_movers_pushes_latest_day_into_scan(spark):
    p = plan(ep.queries()["v_top_movers"](spark, SF))
    scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]
    for scan in scans:
        pushed = scan.split("PushedFilters")[1]
        assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed
    assert scans


@pytest.mark.parametrize("name", ["market_kpis", "volume_by_symbol", "change_ranking", "market_summary", "v_latest_ticks", "v_tick_history", "intraday_series"])
def test_day_queries_read_one_day_of_facts(spark, name):
    p = plan(ep.queries()[name](spark, SF))
    scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln and ("l_shipdate" in ln or "event_type" in ln)]
    day = ["GreaterThanOrEqual(" in ln.split("PushedFilters")[1] for ln in scans]
    # trades: every scan; ticks: the events themselves (bars look back for the previous close)
    assert all(day) if any("l_shipdate" in ln for ln in scans) else any(day)
    assert scans


@pytest.mark.parametrize("name", ["rsi_counts", "rsi_distribution", "rsi_screen", "band_width_rank", "market_risk_score"])
def test_signal_queries_limit_rows_per_symbol_before_the_shuffle(spark, name):
    p = plan(ep.queries()[name](spark, SF))
    assert "WindowGroupLimit" in p and p.count("FileScan parquet") == 2


def test_weekly_rollup_is_an_aggregate_and_latest_ticks_a_group_limit(spark):
    p = plan(ep.queries()["v_weekly_rollup"](spark, SF))
    assert "Window [" not in p.split("Exchange")[0] and "Aggregate" in p
    assert plan(ep.queries()["latest_ticks_by_hour"](spark, SF)).count("WindowGroupLimit") == 2   # one in each input task, one behind the shuffle


def test_zone_reads_are_partition_pruned(spark, tmp_root):
    paths = LakePaths(tmp_root)
    df = spark.createDataFrame([("2024-01-02", "A", 1.0, 1.0, 1.0, 1.0, 1)],
                               "date string, symbol string, open double, high double, low double, close double, volume bigint")
    lake.write_raw(df.selectExpr("cast(date as date) date", "symbol", "open", "high", "low", "close", "volume"), paths, "2024-01-02")
    p = plan(lake.read_raw(spark, paths, "2024-01-02"))
    assert "PartitionFilters: [isnotnull(date_partition" in p and "2024-01-02" in p


def test_tick_day_filter_is_a_partition_filter(spark, tmp_root):
    import datetime as dt

    from quantlake.schemas import RAW_TICKS

    path = f"{tmp_root}/ticks"
    row = ("2024-01-08T10:00:00+00:00", 1.0, 1, 1.0, 1.0, 1.0, 1.0, dt.datetime(2024, 1, 8, 10), dt.date(2024, 1, 8), "A")
    spark.createDataFrame([row], RAW_TICKS).write.partitionBy("date_partition", "symbol").parquet(path)
    t = spark.read.schema(RAW_TICKS).parquet(path)
    p = plan(V.v_tick_history(t, as_of="2024-01-08"))
    assert "PartitionFilters" in p and "date_partition" in p.split("PartitionFilters")[1].split("]")[0]


def test_universe_is_a_semi_join_that_spark_plans(spark):
    from quantlake.sources.universe import in_universe, universe_frame

    bars = spark.range(1000).selectExpr("concat('S', cast(id % 50 as string)) AS symbol", "id AS v")
    p = plan(in_universe(bars, universe_frame(spark, ["S1", "S2"])))
    assert "LeftSemi" in p
    assert "strategy=broadcast" not in plan(in_universe(bars, universe_frame(spark, ["S1"])), "extended")   # no hint
