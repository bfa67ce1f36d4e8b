"""Connected components by alternating star contractions, in DataFrame joins and aggregates only.

Large star: every node tells its larger neighbours about the smallest node it sees; small star: a node's
smaller neighbours and itself meet at the smallest of them. Both keep connectivity and shrink the graph
to stars in O(log^2 n) rounds. Each round is two aggregates (map-side combined, so a hub with a third of
all edges is one row per task) and two joins on the node; the round's edges are written to the
shared folder, which ends the lineage. Only the number of changed edges comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import stored

MAX_ROUNDS = 60


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction of edges (a, b), a > b; the result has the same form."""
    if larger:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        met = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = met.unionAll(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node that has an edge to another node.

    Null ends and loops are ignored; repeated edges and either direction are fine; no edge, no row.
    """
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = stored(now.where(F.col("a") != F.col("b")).distinct(), "edges")
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = digest(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        now = stored(_star(_star(now, True), False), "stars")
        after = digest(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
