"""Job entry points (python -m quantlake ...)."""

import datetime as dt
import json

from quantlake.__main__ import main
from quantlake.paths import LakePaths
from quantlake.sources import lake
from quantlake.streaming.ticks import read_landed_ticks


def test_batch_and_stream_jobs(spark, tmp_root, capsys):
    paths = LakePaths(tmp_root)
    rows = [(dt.date(2024, 1, d), "A", 1.0, 2.0, 0.5, 1.5, 10) for d in range(1, 6)]
    raw = spark.createDataFrame(rows, "date date, symbol string, open double, high double, low double, "
                                      "close double, volume bigint")
    lake.write_raw(raw, paths, "2024-01-05")
    assert main(["batch", "--root", tmp_root, "--run-date", "2024-01-05"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["staging_rows"] == 5 and out["curated_rows"] == 5
    assert lake.read_curated(spark, paths).count() == 5

    src = f"{tmp_root}/feed"
    tick = {"symbol": "A", "timestamp": "2024-01-08T10:00:00.000000+00:00", "price": 1.0, "volume": 1,
            "open": 1.0, "high": 1.0, "low": 1.0, "prev_close": 1.0}
    spark.createDataFrame([(json.dumps(tick),)], "value string").write.text(src)
    assert main(["stream", "--root", tmp_root, "--files", src, "--available-now"]) == 0
    assert read_landed_ticks(spark, paths.raw_ticks).count() == 1


def test_ticks_table_before_and_after_landing(spark, tmp_root):
    from quantlake.sources import catalog as CAT

    paths = LakePaths(tmp_root)
    CAT.create_database(spark, "qltest_ticks", location=f"{tmp_root}/wh", use=False)
    before = CAT.create_ticks_table(spark, paths, "qltest_ticks")     # created before the stream writes
    src = f"{tmp_root}/feed"
    ticks = [{"symbol": s, "timestamp": f"2024-01-0{d}T10:00:00.000000+00:00", "price": 1.0, "volume": 1,
              "open": None, "high": None, "low": None, "prev_close": 1.0} for s in ("A", "B") for d in (8, 9)]
    spark.createDataFrame([(json.dumps(t),) for t in ticks], "value string").write.text(src)
    assert main(["stream", "--root", tmp_root, "--files", src, "--available-now"]) == 0
    assert CAT.partitions(spark, before).count() == 0
    assert CAT.repair(spark, before) is True
    assert CAT.partitions(spark, before).count() == 4          # (day, symbol) folders
    day = spark.table(before).filter("date_partition = DATE'2024-01-09'")
    assert day.count() == 2 and {r["symbol"] for r in day.collect()} == {"A", "B"}

    spark.sql(f"DROP TABLE {before}")
    after = CAT.create_ticks_table(spark, paths, "qltest_ticks")      # over the sink's commit log
    assert CAT.repair(spark, after) is False
    assert spark.table(after).filter("date_partition = DATE'2024-01-08'").count() == 2
