"""The adapters reproduce the row counts FIXTURES.md states for sf0.01."""

import pytest
from pyspark.sql import functions as F

from quantlake.operators.cleaning import clean
from quantlake.plans import views as V
from quantlake.sources.testdata import dirty_bars, event_ticks, events_bars, table, trade_bars

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables_present():
    import os
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("sf0.01 test data not present")


def test_bar_adapters(spark, tables_present):
    assert events_bars(spark, SF).count() == 150
    t = trade_bars(spark, SF)
    assert t.count() == 38372
    assert t.select("symbol", "date").distinct().count() == 38372


def test_dirty_bars_clean_to_125(spark, tables_present):
    d = dirty_bars(spark, SF)
    assert d.count() == 175
    assert clean(d, "2024-02-02 00:00:00").count() == 125


def test_ticks_one_per_event_and_hourly_latest(spark, tables_present):
    k = event_ticks(spark, SF)
    assert k.count() == table(spark, SF, "events").count()
    assert k.filter(F.col("open").isNull()).count() == table(spark, SF, "events").filter("event_id % 5 = 0").count()
    assert V.latest_ticks_by_hour(k).count() == 3385
