"""Tick encoding, decoding and the checkpointed streaming sink."""

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from quantlake.functions.exprs import iso_timestamp
from quantlake.sources.kafka import encode_ticks
from quantlake.streaming.ticks import bad_tick_records, decode_ticks, read_landed_ticks, start_reject_sink, start_tick_sink

GOOD = {"symbol": "AAA.XC", "timestamp": "2024-01-08T10:00:00.123456+00:00", "price": 80.5, "volume": 1200,
        "open": 79.0, "high": 81.0, "low": 78.5, "prev_close": 79.5}


def records(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_fields_time_and_partition(spark):
    t = decode_ticks(records(spark, [json.dumps(GOOD)])).first()
    assert t["symbol"] == "AAA.XC" and t["volume"] == 1200 and t["prev_close"] == 79.5
    assert t["event_time"] == dt.datetime(2024, 1, 8, 10, 0, 0, 123456)
    assert t["date_partition"] == dt.date(2024, 1, 8)


def test_decode_binary_value(spark):
    df = spark.createDataFrame([(bytearray(json.dumps(GOOD).encode()),)], "value binary")
    assert decode_ticks(df).first()["price"] == 80.5


def test_corrupt_missing_and_lenient_volume(spark):
    vals = [
        "{not json",
        json.dumps({k: v for k, v in GOOD.items() if k != "open"}),
        json.dumps({**GOOD, "volume": 3.0}),
        json.dumps({**GOOD, "volume": None, "open": None, "high": None, "low": None, "prev_close": 0.0}),
    ]
    kept = decode_ticks(records(spark, vals)).collect()
    assert len(kept) == 4
    corrupt = [r for r in kept if r["symbol"] is None]
    assert len(corrupt) == 1 and all(v is None for v in corrupt[0].asDict().values())
    volumes = [r["volume"] for r in kept if r["symbol"]]
    assert volumes.count(1200) == 1 and volumes.count(None) == 2   # "3.0" is not a LONG -> NULL
    quarantined = decode_ticks(records(spark, vals), bad_records="quarantine").count()
    assert quarantined == 3
    assert bad_tick_records(records(spark, vals)).count() == 1
    lenient = decode_ticks(records(spark, vals[2:3]), lenient_volume=True).first()
    assert lenient["volume"] == 3


def test_encode_topics_keys_and_nulls(spark):
    df = spark.createDataFrame(
        [("AAA.XC", "2024-01-08T10:00:00.000000+00:00", 1.5, 10, None, 2.0, 1.0, 1.25)],
        "symbol string, timestamp string, price double, volume bigint, open double, high double, low double, "
        "prev_close double",
    )
    r = encode_ticks(df, prefix="mkt").first()
    assert r["topic"] == "mkt.aaa_xc" and r["key"] == "AAA.XC"
    assert json.loads(r["value"]) == {"symbol": "AAA.XC", "timestamp": "2024-01-08T10:00:00.000000+00:00",
                                      "price": 1.5, "volume": 10, "open": None, "high": 2.0, "low": 1.0,
                                      "prev_close": 1.25}
    # round trip
    back = decode_ticks(encode_ticks(df)).select("symbol", "price", "open", "prev_close").first()
    assert tuple(back) == ("AAA.XC", 1.5, None, 1.25)


def test_stream_sink_equals_batch_decode_and_restart_adds_nothing(spark, tmp_root):
    src, sink, ckpt = f"{tmp_root}/src", f"{tmp_root}/sink", f"{tmp_root}/ckpt"
    vals = [json.dumps({**GOOD, "symbol": s, "timestamp": f"2024-01-0{d}T10:00:0{i}.000000+00:00", "price": float(i)})
            for s in ("A.X", "B.Y") for d in (8, 9) for i in range(3)]
    records(spark, vals).coalesce(1).write.text(src)

    def run():
        stream = spark.readStream.schema("value STRING").text(src)
        q = start_tick_sink(decode_ticks(stream), sink, ckpt, available_now=True, query_name=f"t{uuid.uuid4().hex[:8]}")
        q.awaitTermination()

    run()
    landed = read_landed_ticks(spark, sink)
    batch = decode_ticks(records(spark, vals))
    cols = ["symbol", "timestamp", "price", "volume", "event_time", "date_partition"]
    assert sorted(landed.select(cols).collect()) == sorted(batch.select(cols).collect())
    parts = {(r["date_partition"], r["symbol"]) for r in landed.select("date_partition", "symbol").distinct().collect()}
    assert len(parts) == 4
    run()  # restart from the checkpoint: nothing new to process
    assert read_landed_ticks(spark, sink).count() == len(vals)
    # only today's folder is read for a day filter
    one_day = read_landed_ticks(spark, sink).filter(F.col("date_partition") == "2024-01-09")
    assert one_day.count() == 6


def test_sink_files_per_folder_bound(spark, tmp_root):
    import os

    src, sink, ckpt = f"{tmp_root}/src", f"{tmp_root}/sink", f"{tmp_root}/ckpt"
    vals = [json.dumps({**GOOD, "symbol": "HOT", "timestamp": f"2024-01-08T10:{i // 60:02d}:{i % 60:02d}.000000+00:00"})
            for i in range(600)]
    records(spark, vals).repartition(8).write.text(src)
    stream = spark.readStream.schema("value STRING").text(src)
    q = start_tick_sink(decode_ticks(stream), sink, ckpt, available_now=True, files_per_folder=2)
    q.awaitTermination()
    folder = f"{sink}/date_partition=2024-01-08/symbol=HOT"
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert 1 <= len(files) <= 2
    assert read_landed_ticks(spark, sink).count() == 600


def test_decode_is_the_same_in_any_session_zone(spark):
    rows = [(json.dumps({"symbol": "A", "timestamp": t, "price": 1.0, "volume": 2}),) for t in (
        "2024-01-08T20:00:00+00:00", "2024-01-08T20:00:00", "2024-01-09T01:30:00.5+05:00", "nonsense")]
    records = spark.createDataFrame(rows, "value string")
    got = {}
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            t = decode_ticks(records)
            got[zone] = sorted((r[0], r[1], r[2], r[3]) for r in t.select(
                "timestamp", F.unix_micros("event_time"), F.col("date_partition").cast("string"), iso_timestamp("event_time")).collect())
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["UTC"] == got["Asia/Tokyo"] == got["America/New_York"]
    assert {r[2] for r in got["UTC"]} == {"2024-01-08", None} and "2024-01-08T20:30:00.500000+00:00" in {r[3] for r in got["UTC"]}


def test_rejects_are_landed(spark, tmp_path):
    good = '{"symbol":"A","timestamp":"2024-01-08T10:00:00+00:00","price":1.0,"volume":2}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([good, "junk", good.replace("2024-01-08T10:00:00+00:00", "soon"), good.replace('"A"', "null")]))
    records = spark.readStream.schema("value STRING").text(str(tmp_path / "in"))
    a = start_tick_sink(decode_ticks(records, bad_records="quarantine"), f"{tmp_path}/ticks", f"{tmp_path}/c1", available_now=True)
    b = start_reject_sink(records, f"{tmp_path}/rejects", f"{tmp_path}/c2", available_now=True)
    a.awaitTermination()
    b.awaitTermination()
    assert read_landed_ticks(spark, f"{tmp_path}/ticks").count() == 1 and spark.read.parquet(f"{tmp_path}/rejects").count() == 3


def test_processing_time_trigger_lands_ticks(spark, tmp_path):
    import time

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"symbol":"A","timestamp":"2024-01-08T10:00:00+00:00","price":1.0,"volume":2}')
    records = spark.readStream.schema("value STRING").text(str(tmp_path / "in"))
    q = start_tick_sink(decode_ticks(records), f"{tmp_path}/ticks", f"{tmp_path}/c", trigger="1 second")
    try:
        until = time.time() + 60
        while time.time() < until and not (q.lastProgress and q.lastProgress["numInputRows"] >= 0 and (tmp_path / "ticks" / "_spark_metadata" / "0").exists()):
            time.sleep(0.5)
    finally:
        q.stop()
    assert read_landed_ticks(spark, f"{tmp_path}/ticks").count() == 1
