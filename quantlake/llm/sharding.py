"""Range sharding by sampled splitters (operator 3).

Every record has a key (60 bits of its text's MD5, so equal texts are neighbours), a tie (a hash of its id, whose last bits tell
equal rows apart) and a size (UTF-8 bytes + 1). Keys are drawn with probability proportional to size; their quantiles are
the boundaries of many small ranges; a range that turns out overfull is sampled again and subdivided, down to single
rows inside one hot key. With exact sizes of all ranges, a record's position in bytes is its range's start plus a running
sum inside the range, and its shard is the eighth of all bytes that its middle falls into.

Law ``bytes``: sizes near equal. Equal texts stay in one shard if they make up at most 1 / ``GROUP_SHARE`` of a mean shard, all
rows of that text in the corpus counted; a larger group that a cut falls into is divided there. The rule depends on
the texts alone, not on the ranges that the work was cut into.

Scale: texts are read once; only (id, size, crc, key, tie) is kept, shuffled once by range and sorted inside.
The driver sees a sample (about ``SAMPLES_PER_RANGE`` for each range that is being cut, at most ``MAX_RANGES`` ranges at first), whatever
repeats, and one number per range. No task holds more than an overfull range's bound of rows.

Defined cases: null text has size 1; null ids are values like others; rows equal in id and text are
interchangeable; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantlake.llm.common import prepare, stored, table, whole_text

SHARDS = 8
RANGE_ROWS = 5000
MIN_RANGES, MAX_RANGES = 32, 65536
SAMPLES_PER_RANGE = 16
OVERFULL = 4            # times the mean size or rows of a range
MAX_ROUNDS = 4
GROUP_SHARE = 100       # a group stays whole up to 1/100 of a shard
LOWEST = -(2**63)
COPY_MASK = (1 << 24) - 1   # bits of a tie that tell equal rows apart

Splitter = tuple[int, int]


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, key, tie of every row; to be stored, as the last bits of ``tie`` are drawn when it is run."""
    text = whole_text(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long").alias("key"),
        (F.xxhash64(F.col(id_col).cast("long")).bitwiseAND(F.lit(~COPY_MASK)) + F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(COPY_MASK))).alias("tie"),
    )


def range_index(splitters: list[Splitter]):
    """Pandas UDF: how many splitters are <= (key, tie)."""
    keys = np.array([k for k, _ in splitters], np.int64)
    ties = np.array([t for _, t in splitters], np.int64)

    @F.pandas_udf("int")
    def index(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        out = lo.copy()
        for a, b in {(a, b) for a, b in zip(lo, hi) if b > a}:
            at = (lo == a) & (hi == b)  # keys between the splitters share ``lo``
            out[at] = a + np.searchsorted(ties[a:b], t[at], "right")
        return pd.Series(out.astype(np.int32))

    return index


def quantiles(sample: list, parts: int) -> list[Splitter]:
    """Boundaries that cut a weighted sample into equal parts; a key that fills several becomes several."""
    out: set[Splitter] = set()
    total, run, at = sum(r["w"] for r in sample), 0.0, 1
    for r in sorted(sample, key=lambda r: (r["key"], r["tie"])):
        run += r["w"]
        if run >= total * at / parts:
            first = (r["key"], LOWEST)
            out.add((r["key"], r["tie"]) if first in out else first)
            at = int(run * parts / total) + 1
    return sorted(out)


def draw(rec: DataFrame, rate: float, seed: int) -> list:
    """Rows taken with probability min(1, size * rate), weighted so that the sample stands for bytes. Rows with one (key, tie)
    are drawn as one, so about ``rate`` times all bytes are taken at most, whatever repeats."""
    one = rec.groupBy("key", "tie").agg(F.sum("size").alias("size"))
    u = (F.pmod(F.xxhash64("key", "tie", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40))
    p = F.least(F.lit(1.0), F.col("size") * F.lit(rate))
    return one.where(u < p).select("key", "tie", (F.col("size") / p).alias("w")).collect()


def splitters_for(rec: DataFrame, rows: int, total: int) -> tuple[list[Splitter], dict[int, tuple[int, int]]]:
    """Splitters, and (bytes, rows) of each range, after subdividing overfull ranges."""
    parts = min(MAX_RANGES, max(MIN_RANGES, math.ceil(rows / RANGE_ROWS)))
    cuts = quantiles(draw(rec, SAMPLES_PER_RANGE * parts / total, 0), parts)
    for again in range(MAX_ROUNDS + 1):
        where = range_index(cuts)("key", "tie").alias("rng")
        sums = rec.select(where, "size").groupBy("rng").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
        sizes = {r["rng"]: (r["b"], r["n"]) for r in sums}
        full = [r for r, (b, n) in sizes.items() if n > 1 and (b > OVERFULL * total / parts or n > OVERFULL * rows / parts)]
        if not full or again == MAX_ROUNDS:
            return cuts, sizes
        share = sum(max(sizes[r][0] / total, sizes[r][1] / rows) for r in full)
        into = math.ceil(4 * share * parts) + 1
        finer = draw(rec.where(range_index(cuts)("key", "tie").isin(full)), SAMPLES_PER_RANGE * into / sum(sizes[r][0] for r in full), again + 1)
        cuts = sorted({*cuts, *quantiles(finer, into)})


def _whole_groups(pos: DataFrame, divided: list[int]) -> DataFrame:
    """``group`` and ``begin`` of the keys that lie in several ranges, over all of these."""
    if not divided:
        return pos
    pos = stored(pos, "positions")
    keys = pos.sparkSession.createDataFrame([(k,) for k in sorted(set(divided))], "key long")
    parts = pos.join(F.broadcast(keys), "key").groupBy("key", "rng").agg(F.max("group").alias("group"), F.min("begin").alias("begin"))
    all_of = parts.groupBy("key").agg(F.sum("group").alias("_group"), F.min("begin").alias("_begin"))
    # at most one row for each splitter
    pos = pos.join(F.broadcast(all_of), "key", "left")
    return pos.withColumns({"group": F.coalesce("_group", "group"), "begin": F.coalesce("_begin", "begin")})


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``."""
    spark = docs.sparkSession
    rec = stored(records(docs, id_col, text_col), "records")
    rows, total = rec.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not rows:
        return rec.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    cuts, sizes = splitters_for(rec, rows, total)
    starts, b0, n0 = [], 0, 0
    for r in sorted(sizes):
        starts.append((r, b0, n0))
        b0, n0 = b0 + sizes[r][0], n0 + sizes[r][1]
    # at most MAX_RANGES plus subdivisions, 20 bytes each
    offsets = F.broadcast(spark.createDataFrame(starts, "rng int, b0 long, n0 long"))
    run = Window.partitionBy("rng").orderBy("key", "tie")
    same = Window.partitionBy("rng", "key")
    pos = (
        rec.withColumn("rng", range_index(cuts)("key", "tie")).repartition("rng").join(offsets, "rng")
        .withColumn("end", F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0)) + F.col("b0"))
        .withColumn("at", F.row_number().over(run) - 1 + F.col("n0"))
        .withColumn("group", F.sum("size").over(same)).withColumn("begin", F.min(F.col("end") - F.col("size")).over(same))
    )
    pos = _whole_groups(pos, [k for k, t in cuts if t != LOWEST])
    whole = F.col("group") * GROUP_SHARE * shards <= F.lit(total)
    twice = F.when(whole, 2 * F.col("begin") + F.col("group")).otherwise(2 * F.col("end") - F.col("size"))
    scaled, unit = twice * F.lit(shards), F.lit(2 * total)
    number = F.least(F.lit(shards - 1), (scaled - scaled % unit) / unit)
    put = stored(pos.select("doc_id", "size", "text_crc32", number.cast("int").alias("shard"), "at"), "placed")
    first = F.broadcast(put.groupBy("shard").agg(F.min("at").alias("first")))  # one row per shard
    return put.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the texts as one folder per shard. Rows of a shard are dealt over several tasks."""
    key = [F.col("doc_id"), F.crc32(F.encode(whole_text(), "UTF-8"))]
    put = shard(docs, shards=shards).dropDuplicates(["doc_id", "text_crc32"]).select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), "shard")
    docs.join(put, key[0].eqNullSafe(F.col("_id")) & (key[1] == F.col("_crc"))).drop("_id", "_crc").write.partitionBy("shard").parquet(path)


def op3_sharding(spark, sf_dir):
    """Every document's shard and slot under the law of near-equal bytes."""
    prepare(spark)
    got = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

