"""Options of the Kafka source and sink, and the catalog views against the DataFrame views."""

from pyspark.sql import functions as F

from quantlake.paths import LakePaths
from quantlake.operators.indicators import add_all_indicators
from quantlake.plans import views as V
from quantlake.sources import catalog as CAT
from quantlake.sources import kafka, lake
from quantlake.sources.testdata import event_ticks, events_bars, trade_bars
from quantlake.streaming.ticks import landed_columns

SF = "/root/testdata/sf0.001"


class Recorder:
    """Stands in for a reader or writer; there is no broker here."""

    def __init__(self):
        self.set, self.kind, self.done = {}, None, None

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.set[key] = value
        return self

    def load(self):
        self.done = "load"
        return self

    def save(self):
        self.done = "save"


class Holder:
    def __init__(self):
        self.readStream = self.write = Recorder()


def test_kafka_source_options():
    s = Holder()
    r = kafka.read_tick_stream(s, "b1:9092,b2:9092", prefix="mkt.eod", starting_offsets="earliest", group_id="g", max_offsets_per_trigger=5000)
    assert (r.kind, r.done) == ("kafka", "load")
    assert r.set == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribePattern": r"mkt\.eod\..*", "startingOffsets": "earliest", "failOnDataLoss": "false",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "5000"}
    plain = kafka.read_tick_stream(Holder(), "b:1")
    assert plain.set == {"kafka.bootstrap.servers": "b:1", "subscribePattern": r"ticks\..*", "startingOffsets": "latest", "failOnDataLoss": "false"}


def test_kafka_sink_options():
    h = Holder()
    kafka.write_ticks_kafka(h, "b:1")
    assert (h.write.kind, h.write.done, h.write.set) == ("kafka", "save", {"kafka.bootstrap.servers": "b:1"})


def test_catalog_views_equal_the_dataframe_views(spark, tmp_root):
    """All rows and columns of the seven views, made both ways over the same tables."""
    paths, db = LakePaths(tmp_root), "qltest_both"
    lake.write_curated(add_all_indicators(trade_bars(spark, SF).unionByName(events_bars(spark, SF))).withColumn("ingested_at", F.lit("x")), paths)
    landed_columns(event_ticks(spark, SF)).write.partitionBy("date_partition", "symbol").parquet(paths.raw_ticks)
    CAT.create_database(spark, db, location=f"{tmp_root}/wh", use=False)
    for t in (CAT.create_curated_table(spark, paths, db), CAT.create_ticks_table(spark, paths, db)):
        CAT.repair(spark, t)
    assert len(CAT.create_views(spark, db, ticks=True, latest_day=True)) == 7
    V.register_views(spark, spark.table(f"{db}.curated_ohlcv"), spark.table(f"{db}.raw_ticks"), as_of="latest")
    for name in V.VIEW_NAMES:
        a, b = spark.table(f"{db}.{name}"), spark.table(name)
        assert set(a.columns) == set(b.columns), name
        assert sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect())), name
        assert a.count() > 0
