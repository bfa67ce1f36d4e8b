"""Incremental curated runs against full ones: appends, late corrections, new symbols, re-runs, crashes."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from quantlake.__main__ import main
from quantlake.operators.indicators import LOOKBACK
from quantlake.paths import LakePaths
from quantlake.plans import incremental as INC
from quantlake.plans.batch import EmptyRunError, run_batch
from quantlake.sources import lake, versions

RAW = "date date, symbol string, open double, high double, low double, close double, volume bigint"
START = dt.date(2024, 1, 1)


def bars(spark, series):
    """series: {symbol: {day number: close}}"""
    rows = [(START + dt.timedelta(days=d), s, px, px + 1, px - 1, px, 100 + d) for s, days in series.items() for d, px in days.items()]
    return spark.createDataFrame(rows, RAW).repartition(3)


def walk(seed, first, last):
    rnd = random.Random(seed)
    return {d: round(50 + rnd.uniform(-9, 9), 2) for d in range(first, last)}


def rows_of(spark, paths, *drop):
    return sorted((tuple(r) for r in lake.read_curated(spark, paths).drop("ingested_at", *drop).collect()), key=str)


class Both:
    """The same runs through an incremental and a full lake."""

    def __init__(self, spark, root):
        self.spark, self.a, self.b = spark, LakePaths(f"{root}/inc"), LakePaths(f"{root}/full")

    def run(self, date, series):
        raw, stamp = bars(self.spark, series), f"{date} 18:00:00"
        for p in (self.a, self.b):
            lake.write_raw(raw, p, date)
        done = INC.run_incremental(self.spark, self.a, date, ingested_at=stamp)
        run_batch(self.spark, self.b, date, ingested_at=stamp)
        assert rows_of(self.spark, self.a) == rows_of(self.spark, self.b)
        return done


def test_incremental_equals_full(spark, tmp_root):
    lakes = Both(spark, tmp_root)
    base = {s: walk(i, 0, 120) for i, s in enumerate(("A", "B", "C", "Brand#1"))}
    first = lakes.run("2024-06-01", base)
    assert first.full and first.replaced == 4
    # nothing new: nothing is written
    before = versions.children(spark, lakes.a.curated_ohlcv)
    same = lakes.run("2024-06-02", {s: {d: px for d, px in v.items() if d > 100} for s, v in base.items()})
    assert (same.full, same.appended, same.replaced) == (False, 0, 0) and versions.children(spark, lakes.a.curated_ohlcv).keys() == before.keys()
    # new bars behind the last ones, with an unchanged overlap; C has none
    day = lakes.run("2024-06-03", {s: {119: base[s][119], **walk(i + 50, 120, 123)} for i, s in enumerate(("A", "B", "Brand#1"))})
    assert (day.appended, day.appended_rows, day.replaced) == (3, 9, 0)
    # a late correction of A, a gap filled in B, a symbol seen first, an append to C
    mixed = lakes.run("2024-06-04", {"A": {40: 1.5, 123: 60.0}, "B": {119: base["B"][119], 200: 3.0}, "NEW": walk(9, 100, 124), "C": walk(8, 120, 124)})
    assert (mixed.appended, mixed.appended_rows, mixed.replaced) == (2, 5, 2)
    gap = lakes.run("2024-06-05", {"B": {150: 4.0}})
    assert (gap.appended, gap.replaced) == (0, 1)
    more = lakes.run("2024-06-06", {s: {201: 7.0, 202: 8.0} for s in ("A", "B", "C", "NEW", "Brand#1")})
    assert (more.appended, more.appended_rows, more.replaced) == (5, 10, 0)
    tail = INC.read_tail(spark, lakes.a).groupBy("symbol").agg(F.count("*").alias("n"), F.max("date").alias("d")).collect()
    assert {(r["symbol"], r["n"]) for r in tail} == {("A", LOOKBACK), ("B", LOOKBACK), ("C", LOOKBACK), ("NEW", 26), ("Brand#1", LOOKBACK)}
    assert {r["d"] for r in tail} == {START + dt.timedelta(days=202)}
    # the stamps: an unchanged bar keeps its first one
    stamps = {(r["symbol"], r["date"]): r["ingested_at"] for r in lake.read_curated(spark, lakes.a).collect()}
    assert stamps["C", START] == "2024-06-01 18:00:00" and stamps["Brand#1", START + dt.timedelta(days=122)] == "2024-06-03 18:00:00"


def test_reruns_and_backfills(spark, tmp_root):
    lakes = Both(spark, tmp_root)
    lakes.run("2024-06-01", {"A": walk(1, 0, 80), "B": walk(2, 0, 80), "GONE": {5: 1.0}})
    lakes.run("2024-06-05", {"A": walk(3, 80, 84), "B": walk(4, 80, 84), "ONCE": {3: 2.0}})
    again = lakes.run("2024-06-05", {"A": walk(5, 80, 83)})                     # fewer bars than before: B's and ONCE's go
    assert not again.full and again.replaced == 3
    assert "ONCE" not in {r["symbol"] for r in lake.read_curated(spark, lakes.a).collect()}
    back = lakes.run("2024-06-03", {"A": walk(6, 78, 82), "GONE": {6: 2.0}})    # an older run: the newer one's bars stay
    assert not back.full and back.replaced == 2
    lakes.run("2024-06-06", {"A": walk(7, 84, 86), "ONCE": {90: 1.0}})


def test_a_crashed_run_is_made_good(spark, tmp_root, monkeypatch):
    lakes = Both(spark, tmp_root)
    lakes.run("2024-06-01", {"A": walk(1, 0, 90), "B": walk(2, 0, 90)})
    new = bars(spark, {"A": walk(3, 90, 92), "B": {50: 1.0}})
    lake.write_raw(new, lakes.a, "2024-06-02")
    before = rows_of(spark, lakes.a)

    def fails(*a, **k):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:        # after B was replaced and before A's rows were appended
        m.setattr(versions, "append", fails)
        with pytest.raises(RuntimeError):
            INC.run_incremental(spark, lakes.a, "2024-06-02", ingested_at="2024-06-02 18:00:00")
    assert [r for r in rows_of(spark, lakes.a) if r[-1] == "A"] == [r for r in before if r[-1] == "A"]
    with monkeypatch.context() as m:        # after the rows were appended and before the tail was written
        m.setattr(INC, "_write_tail", fails)
        with pytest.raises(RuntimeError):
            INC.run_incremental(spark, lakes.a, "2024-06-02", ingested_at="2024-06-02 18:00:00")
    lake.write_raw(new, lakes.b, "2024-06-02")
    run_batch(spark, lakes.b, "2024-06-02", ingested_at="2024-06-02 18:00:00")
    done = lakes.run("2024-06-03", {"A": walk(4, 92, 94), "B": walk(5, 90, 94)})
    assert done.full
    assert not lakes.run("2024-06-04", {"A": walk(6, 94, 95)}).full


def test_full_run_between_incremental_ones(spark, tmp_root):
    lakes = Both(spark, tmp_root)
    lakes.run("2024-06-01", {"A": walk(1, 0, 70)})
    lake.write_raw(bars(spark, {"A": walk(2, 70, 75)}), lakes.a, "2024-06-02")
    lake.write_raw(bars(spark, {"A": walk(2, 70, 75)}), lakes.b, "2024-06-02")
    for p in (lakes.a, lakes.b):
        run_batch(spark, p, "2024-06-02", ingested_at="2024-06-02 18:00:00")
    assert lakes.run("2024-06-03", {"A": walk(3, 75, 76)}).full
    with pytest.raises(EmptyRunError):
        INC.run_incremental(spark, lakes.a, "2024-06-09")


def test_table_follows_incremental_runs(spark, tmp_root, capsys):
    paths, db = LakePaths(tmp_root), "qltest_incremental"
    for day, series in (("2024-06-01", {"A": walk(1, 0, 60), "B": walk(2, 0, 60)}), ("2024-06-02", {"A": walk(3, 60, 62), "B": {10: 5.0}, "N": {61: 1.0}})):
        lake.write_raw(bars(spark, series), paths, day)
        assert main(["batch", "--root", tmp_root, "--run-date", day, "--incremental", "--database", db]) == 0
        out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert sorted(map(str, spark.table(f"{db}.curated_ohlcv").collect())) == sorted(map(str, lake.read_curated(spark, paths).collect()))
    assert (out["appended"], out["replaced"]) == (1, 2)
    assert spark.table(f"{db}.v_daily_summary").count() == 123


def test_work_follows_the_change(spark, tmp_root):
    """A day's run reads the curated folders of its symbols and days only, and runs windows over tail and new bars."""
    paths = LakePaths(tmp_root)
    lake.write_raw(bars(spark, {f"S{i}": walk(i, 0, 70) for i in range(6)}), paths, "2024-06-01")
    INC.run_incremental(spark, paths, "2024-06-01", ingested_at="2024-06-01 18:00:00")
    lake.write_raw(bars(spark, {"S1": {70: 1.0}}), paths, "2024-06-02")
    seen = []
    orig = INC.add_all_indicators

    def counted(df, **kw):
        seen.append(df.count())
        return orig(df, **kw)

    INC.add_all_indicators = counted
    try:
        done = INC.run_incremental(spark, paths, "2024-06-02", ingested_at="2024-06-02 18:00:00")
    finally:
        INC.add_all_indicators = orig
    assert seen == [LOOKBACK + 1] and (done.appended, done.appended_rows, done.replaced_rows) == (1, 1, 0)
