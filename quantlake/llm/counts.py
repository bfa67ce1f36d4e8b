"""How often hashes of a corpus occur, as log2 levels in a table of fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hashes counted by one task.
PART_HASHES = 3_000_000


def packed(table: np.ndarray) -> bytes:
    return zlib.compress(table.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


class Packed:
    """A byte table that is compressed where it is pickled, and a plain array where it is read."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def __reduce__(self):
        return unpacked, (packed(self.table),)


def sent(spark: SparkSession, table: np.ndarray) -> Broadcast:
    """``table`` as a broadcast whose value in a task is the array. It passes the driver's JVM compressed: whole tables made
    its heap grow by about their tenfold, and it stayed so."""
    return spark.sparkContext.broadcast(Packed(table))


def level_of(levels: np.ndarray, h: np.ndarray) -> np.ndarray:
    return levels[(h >> np.uint64(64 - (len(levels).bit_length() - 1))).astype(np.int64)]


def count_levels(texts: DataFrame, hashes: Callable[[list], np.ndarray], table_bits: int, bytes_per_hash: int) -> np.ndarray:
    """Byte table by a hash's top ``table_bits`` bits: 0 if no hash there occurs twice, else floor(log2(count))
    of the most frequent one.

    ``texts`` has one column, ``text``; ``hashes`` gives all uint64 hashes of a batch of texts. Counting is exact over
    all rows up to chance agreement in about 36 bits, which can only raise a level: 4 bytes per hash are shuffled,
    to a number of parts that follows the input. The driver holds the table, whose size is fixed; parts come to it compressed.
    """
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(table_bits, max(3, int(total // (bytes_per_hash * PART_HASHES)).bit_length()))
    slice_bits = table_bits - bits

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h = np.sort(hashes(b["text"]))
            part = (h >> np.uint64(64 - bits)).astype(np.int64)
            low = ((h >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            yield pd.DataFrame({"part": part[cuts].astype(np.int32), "h": [x.tobytes() for x in np.split(low, cuts[1:])] if len(cuts) else []})

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        h, n = np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in pdf["h"]]), return_counts=True)
        out = np.zeros(1 << slice_bits, np.uint8)
        h, n = h[n > 1], n[n > 1]
        at = (h >> np.uint32(32 - slice_bits)).astype(np.int64) if slice_bits else np.zeros(len(h), np.int64)
        np.maximum.at(out, at, np.log2(n).astype(np.uint8))
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "levels": [packed(out)]})

    got = texts.mapInPandas(deal, "part int, h binary").groupBy("part").applyInPandas(count, "part int, levels binary").collect()
    levels = np.zeros(1 << table_bits, np.uint8)
    for r in got:
        levels[r["part"] << slice_bits : (r["part"] + 1) << slice_bits] = unpacked(r["levels"])
    return levels


#: Bits of a member filter; fixed, so its size on the driver and in tasks is too.
FILTER_BITS = 27


def member_filter(keys: DataFrame, key: str) -> np.ndarray:
    """Bit table of the values of column ``key``, which are hashes: it may let others through, but never loses a member."""
    bits = keys.select(F.shiftrightunsigned(key, 64 - FILTER_BITS).alias("bit")).distinct().withColumn("part", F.shiftright("bit", FILTER_BITS - 8).cast("int"))
    span = 1 << (FILTER_BITS - 8)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(span, bool)
        table[pdf["bit"].to_numpy() % span] = True
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "bits": [packed(np.packbits(table))]})

    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in bits.groupBy("part").applyInPandas(pack, "part int, bits binary").collect():
        out[r["part"] * span // 8 : (r["part"] + 1) * span // 8] = unpacked(r["bits"])
    return out


def may_be_members(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the hashes ``keys`` the bit table lets through."""
    at = (keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
