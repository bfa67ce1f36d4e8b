"""Exact top-k by integer inner product as a Voronoi kNN join (operator 8).

Vectors are turned into integers first, so scores are exact. Pivots (k-means centres of a bounded sample)
cut queries and data into cells, and cells that lie together are gathered into groups of about equal rows. A summary of each
data cell holds its number of rows, its radius and its few smallest distances to the pivot. For a query q and a vector x of
cell c with pivot p and d = |x - p|:

    q.p - |q| d  <=  q.x  <=  q.p + |q| d

The left side over the summaries gives each query a score that k rows are sure to reach; the right side with a cell's radius
tells whether a row of it could still reach that. A query goes to the groups that have such a cell, and each
(block of a group's rows, slice of its queries) is solved locally as one matrix product; the best k of the blocks are merged.

Scale: of the two sides it is the few queries that are replicated, and only to groups that they need; a data row moves once (once
for every GROUP_QUERIES queries of its group, which bounds a task). Blocks are dealt by hash and hold about BLOCK_ROWS rows whatever
a cell's size, so one vector that a third of all rows share fills many blocks, not one task. The driver holds the
sample, the pivots and the summaries (CELLS rows). Where data have no cell structure no group can be skipped, and the join
costs what comparing the query set with all rows, in blocks, costs.

Defined cases: null vectors and vectors with null or non-finite components take no part, as query or candidate; a
query never meets its own row (same vec_id); ties go to the smaller vec_id; repeated rows of one id and
vector count once; shorter vectors are padded with zeros; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantlake.llm.common import prepare, stored, table

SCALE = 256
TOP = 5
QUERY_EVERY = 50
CELLS = 64
GROUPS = 16
SAMPLE = 8192
KMEANS_ROUNDS = 8
BLOCK_ROWS = 8192
GROUP_QUERIES = 8192
SLACK = 1e-3            # above any rounding of the bounds


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v (array<long>): floor(SCALE * x) of whole, finite vectors."""
    x = F.col(vec_col)
    good = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))
    return df.where(F.col(id_col).isNotNull() & good).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v")
    ).distinct()


def matrix(column: pd.Series, dims: int, dtype=np.float64) -> np.ndarray:
    out = np.zeros((len(column), dims), dtype)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def pivots_of(sample: np.ndarray, cells: int, rounds: int = KMEANS_ROUNDS) -> np.ndarray:
    """Centres of a few rounds of k-means that starts from evenly spaced sample rows."""
    p = np.unique(sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)], axis=0)
    for _ in range(rounds):
        near = nearest(sample, p)[0]
        n = np.bincount(near, minlength=len(p))
        sums = np.zeros_like(p)
        np.add.at(sums, near, sample)
        p = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], p)
    return p


def nearest(x: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot and a distance to it that rounding can't make too small."""
    d2 = (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)[None, :]
    at = d2.argmin(1)
    return at, np.sqrt(((x - p[at]) ** 2).sum(1)) * (1 + 1e-9) + 1e-6


def gathered(pivots: np.ndarray, n: np.ndarray, groups: int) -> np.ndarray:
    """A group for each cell: cells in a chain of nearest pivots, cut into ``groups`` of about equal rows."""
    left, chain = set(range(1, len(pivots))), [0]
    while left:
        here = pivots[chain[-1]]
        chain.append(min(left, key=lambda j: (float(((pivots[j] - here) ** 2).sum()), j)))
        left.discard(chain[-1])
    before = np.cumsum(n[chain]) - n[chain]
    out = np.zeros(len(pivots), np.int64)
    out[chain] = np.minimum(groups - 1, before * groups // max(1, int(n.sum())))
    return np.unique(out, return_inverse=True)[1]


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best (score, id), ties to the smaller id, without ``own``."""
    s = np.where(ids == own, np.iinfo(np.int64).min, scores)
    if len(s) > 4 * k:
        kth = np.partition(s, len(s) - k)[len(s) - k]
        keep = np.flatnonzero(s >= kth)
        s, ids = s[keep], ids[keep]
    order = np.lexsort((ids, -s))[:k]
    return [(int(s[i]), int(ids[i])) for i in order if s[i] != np.iinfo(np.int64).min]


def knn_join(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = TOP, every: int = QUERY_EVERY,
    cells: int = CELLS, groups: int = GROUPS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``, against all rows."""
    spark = vectors.sparkSession
    answer = "query_id long, vec_id long, score long"
    data = stored(integer_vectors(vectors, id_col, vec_col), "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    dims, peak = data.agg(F.max(F.size("v")), F.max(F.expr("array_max(transform(v, c -> abs(c)))"))).first()
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # float64 products and sums of integers are exact up to 2**53; beyond, integers are multiplied as such
    exact = np.float64 if dims * int(peak) ** 2 < 2**53 else np.int64
    lot = F.xxhash64("vec_id")
    sample = matrix(data.orderBy(lot, "vec_id").limit(SAMPLE).toPandas()["v"], dims)
    pivots = spark.sparkContext.broadcast(pivots_of(sample, cells))

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, d = nearest(matrix(b["v"], dims), pivots.value)
            yield b.assign(cell=at.astype(np.int32), d=d)

    placed = stored(data.mapInPandas(locate, "vec_id long, v array<long>, cell int, d double"), "cells")
    # k + 1 smallest distances, as one of those rows may be the query itself
    low = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("radius"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("d", "vec_id"))
    near = placed.select("cell", "d", "vec_id").withColumn("r", rank).where(F.col("r") <= k + 1)
    close = near.groupBy("cell").agg(F.array_sort(F.collect_list("d")).alias("close"))
    summary = low.join(close, "cell").orderBy("cell").toPandas()  # one row per cell
    group = gathered(pivots.value[summary["cell"].to_numpy()], summary["n"].to_numpy(), groups)
    shared = spark.sparkContext.broadcast((summary["cell"].to_numpy(), summary["radius"].to_numpy(), [np.array(c) for c in summary["close"]], group))

    def sure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each query the groups that can hold one of its k best."""
        at, radius, close_, group_ = shared.value
        for b in batches:
            q = matrix(b["v"], dims)
            qp, norm = q @ pivots.value[at].T, np.sqrt((q * q).sum(1)) * (1 + 1e-9)
            floor_ = np.concatenate([qp[:, [j]] - norm[:, None] * c[None, :] for j, c in enumerate(close_)], axis=1)
            want = min(k + 1, floor_.shape[1])
            bound = np.partition(floor_, floor_.shape[1] - want, axis=1)[:, floor_.shape[1] - want] if floor_.shape[1] > k else np.full(len(b), -np.inf)
            reach = qp + norm[:, None] * radius[None, :] >= bound[:, None] - SLACK
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": b["v"], "grps": [np.unique(group_[r]).astype(np.int32) for r in reach]})

    queries = stored(placed.where(is_query).mapInPandas(sure, "vec_id long, v array<long>, grps array<int>"), "queries")
    sizes = summary.assign(grp=group).groupby("grp")["n"].sum()
    asked = {r["g"]: r["n"] for r in queries.select(F.explode("grps").alias("g")).groupBy("g").agg(F.count("*").alias("n")).collect()}
    cuts = [(int(g), -(-int(n) // block_rows), -(-asked[g] // GROUP_QUERIES)) for g, n in sizes.items() if g in asked]
    if not cuts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # at most CELLS rows each
    cut = F.broadcast(spark.createDataFrame(cuts, "grp int, blocks int, slices int"))
    home = F.broadcast(spark.createDataFrame([(int(c), int(g)) for c, g in zip(summary["cell"], group)], "cell int, grp int"))
    lot_of = lambda seed, n: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    right = placed.join(home, "cell").join(cut, "grp").select("grp", lot_of(2, "blocks").alias("block"), "vec_id", "v", upto("slices").alias("part"))
    left = queries.select("vec_id", "v", F.explode("grps").alias("grp")).join(cut, "grp").select(
        "grp", lot_of(1, "slices").alias("part"), "vec_id", "v", upto("blocks").alias("block"))

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(x):
            ids, right_ = x["vec_id"].to_numpy(), matrix(x["v"], dims, exact)
            for a in range(0, len(q), 256):
                part = q.iloc[a : a + 256]
                scores = (matrix(part["v"], dims, exact) @ right_.T).astype(np.int64)
                for own, row in zip(part["vec_id"], scores):
                    out += [(own, i, s) for s, i in best(row, ids, own, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = left.groupBy("grp", "block", "part").cogroup(right.groupBy("grp", "block", "part")).applyInPandas(solve, answer)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_topk_search(spark, sf_dir):
    """The five best scores of every fiftieth vector against all rows."""
    prepare(spark)
    return knn_join(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(c::DOUBLE * 256)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id,
        list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
