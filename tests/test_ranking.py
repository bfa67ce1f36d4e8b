"""Places in a distributed order against Python's sort."""

import random

from pyspark.sql import functions as F

from quantlake.operators.ranking import with_place


def test_places_match_a_sort(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(20)]), rng.choice("abc"), i) for i in range(500)]
    df = spark.createDataFrame(rows, "x int, y string, i int").repartition(5)
    got = with_place(df, [F.col("x").desc_nulls_last(), "y"], ranges=7)
    assert got.columns == ["x", "y", "i", "place"]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[0] is not None, r[2]))
    assert [tuple(r)[:3] for r in got.orderBy("place").collect()] == order
    assert sorted(r["place"] for r in got.collect()) == list(range(1, 501))


def test_equal_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x")] * 30 + [(0, "y")], "a int, b string")
    got = {(r["a"], r["place"]) for r in with_place(df, ["a"]).collect()}
    assert got == {(0, 1)} | {(1, i) for i in range(2, 32)}
    assert with_place(df.limit(0), ["a"]).count() == 0


def test_no_task_sees_all_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = with_place(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
