"""Every registered query against its DuckDB SQL twin (the driver's gate), on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as ep  # noqa: E402
from check_oracle import duck, rows_key  # noqa: E402
from quantlake.plans.registry import QUERIES as REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = {name: sql for name, sql in ep.oracle_sql().items() if name in REGISTRY}
QUERIES = {name: fn for name, fn in ep.queries().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = ep.entry(spark)
    assert df.columns == ["symbol", "trade_date", "close", "rsi_14", "rsi_signal"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.sql(SQL[name])
    d_cols, d_rows = res.columns, res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_key(s_cols, s_rows) == rows_key(d_cols, d_rows)


def test_rounding_emulation_matches_spark(spark, con):
    """The oracle's SR/ST reproduce Spark's round and stable_round bit for bit, ties included."""
    import random

    from pyspark.sql import functions as F

    from quantlake.functions.exprs import stable_round
    from quantlake.plans.oracle import SR, ST

    rnd = random.Random(11)
    xs = [rnd.uniform(-1e4, 1e4) for _ in range(2000)]
    xs += [round(rnd.uniform(-500, 500), 3) + 0.0005 * s for s in (-1, 1) for _ in range(500)]   # x.xxx5 ties
    xs += [k / 1000 + 0.005 for k in range(-500, 500)] + [1.005, 2.675, 0.125, -0.125, 1e-7, 0.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = {r["i"]: (r["r2"], r["s4"]) for r in df.select(
        "i", F.round("x", 2).alias("r2"), stable_round("x", 4).alias("s4")).collect()}
    con.execute("CREATE OR REPLACE TEMP TABLE rx(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO rx VALUES (?, ?)", list(enumerate(xs)))
    want = {i: (a, b) for i, a, b in con.sql(f"SELECT i, {SR('x', 2)}, {ST('x', 4)} FROM rx").fetchall()}
    bad = [(xs[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not bad, bad[:5]
