"""Safe replacement of a zone's partitions: every write lands in a version folder of its own.

    <zone>/version=000000007-full/symbol=A/...      replaces the whole zone
    <zone>/version=000000008-part/symbol=B/...      replaces the partitions it holds

A version counts once Spark has put ``_SUCCESS`` into it (or into its partition folder, where a single partition was
written), which is the last thing a job does. A plan that fails in mid-write, or a driver that dies, therefore
leaves what readers see as it was. Readers by path (``read``) take the newest complete ``full`` version and, partition by
partition, what newer ``part`` versions replace: all of a write is seen or nothing. Partition folders
straight under the zone (an older layout) count as the oldest version.

Catalog tables see a write when their partitions' locations are moved to it (``catalog.publish``). Replaced
versions are deleted by ``sweep``, which leaves the last ones to readers that have already planned.

The folders are listed on the driver through the Hadoop file system API, one call a version; a ``full`` version's
partitions are not listed to read it.
"""

from __future__ import annotations

import functools
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FULL, PART = "full", "part"
SUCCESS = "_SUCCESS"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ABANDONED_HOURS = 24


@dataclass(frozen=True)
class Version:
    """A complete version folder: its number, kind and, unless it is the whole truth, its partition folders."""

    path: str
    number: int
    full: bool
    folders: tuple[str, ...] = ()


@dataclass(frozen=True)
class Commit:
    """What one write has put in place: rows, and the folder of each partition value."""

    path: str
    rows: int
    partitions: dict[str | None, str] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> dict[str, int]:
    """Names under a folder with their modification times (ms); nothing if there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)}


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def value_of(folder: str) -> str | None:
    """The partition value of a ``key=value`` folder name."""
    raw = folder.split("=", 1)[1]
    return None if raw == NULL_FOLDER else unquote(raw)


def folder_of(key: str, value: str | None) -> str:
    """The folder name that Spark's writer gives to a partition value."""
    if value is None:
        return f"{key}={NULL_FOLDER}"
    special = set("\"#%'*/:=?\\\x7f{[]^") | {chr(i) for i in range(1, 32)}
    return f"{key}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in value)


def _parse(name: str) -> tuple[int, bool] | None:
    head, _, kind = name.removeprefix("version=").partition("-")
    kind = kind.split("-")[0]
    return (int(head), kind == FULL) if name.startswith("version=") and head.isdigit() and kind in (FULL, PART) else None


def complete(spark: SparkSession, zone: str, key: str) -> list[Version]:
    """The complete versions that readers may need, oldest first: the newest full one and all newer parts."""
    found = []
    names = children(spark, zone)
    flat = tuple(sorted(n for n in names if n.startswith(f"{key}=")))
    for name in sorted((n for n in names if _parse(n)), reverse=True):
        number, full = _parse(name)
        path = f"{zone}/{name}"
        inside = children(spark, path)
        if full:
            if SUCCESS in inside:
                found.append(Version(path, number, True))
                break
            continue
        folders = [n for n in inside if n.startswith(f"{key}=")]
        if SUCCESS not in inside:
            folders = [n for n in folders if SUCCESS in children(spark, f"{path}/{n}")]
        if folders:
            found.append(Version(path, number, False, tuple(sorted(folders))))
    else:
        if flat:
            found.append(Version(zone, 0, False, flat))
    return found[::-1]


def live(spark: SparkSession, zone: str, key: str) -> dict[str | None, str]:
    """Each partition value's folder, as readers see them now."""
    out = {}
    for v in complete(spark, zone, key):
        folders = v.folders or sorted(n for n in children(spark, v.path) if n.startswith(f"{key}="))
        out |= {value_of(n): f"{v.path}/{n}" for n in folders}
    return out


def _is(key: str, values: Sequence[str | None]) -> Column:
    known = [v for v in values if v is not None]
    some = F.col(key).isin(known) if known else F.lit(False)
    return F.coalesce(some, F.lit(False)) | F.col(key).isNull() if None in values else F.coalesce(some, F.lit(False))


def read(spark: SparkSession, zone: str, schema: StructType, key: str) -> DataFrame:
    """The zone as its complete versions make it; an absent zone has no rows. Filters on ``key`` prune folders."""
    columns, named = schema.fieldNames(), StructType([*schema.fields, StructField("version", StringType())])
    replaced: set[str] = set()
    paths, outdated, parts = [], [], []
    for v in reversed(complete(spark, zone, key)):
        gone = sorted(replaced) if v.full else sorted(replaced & set(v.folders))
        if v.full or len(gone) < len(v.folders):
            if v.number:
                paths.append(v.path)
                outdated += [(v.path.rsplit("version=", 1)[1], gone)] if gone else []
            else:
                flat = [f"{zone}/{n}" for n in v.folders if n not in replaced]
                parts.append(spark.read.schema(schema).option("basePath", zone).parquet(*flat).select(columns))
        replaced |= set(v.folders)
    if paths:
        df = spark.read.schema(named).option("basePath", zone).parquet(*paths)
        for version, gone in outdated:
            df = df.where(~((F.col("version") == version) & _is(key, [value_of(n) for n in gone])))
        parts.insert(0, df.select(columns))
    return functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _next(spark: SparkSession, zone: str, kind: str) -> str:
    last = max((p[0] for n in children(spark, zone) if (p := _parse(n))), default=0)
    return f"{zone}/version={last + 1:09d}-{kind}-{uuid.uuid4().hex[:8]}"


def _observed(df: DataFrame, write) -> int:
    obs = Observation("rows")
    write(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"])


def write_partitions(df: DataFrame, zone: str, key: str, full: bool = False) -> Commit:
    """Replace the zone (``full``) or the partitions that ``df`` has rows of."""
    spark = df.sparkSession
    path = _next(spark, zone, FULL if full else PART)
    rows = _observed(df, lambda d: d.write.partitionBy(key).parquet(path))
    return Commit(path, rows, {value_of(n): f"{path}/{n}" for n in children(spark, path) if n.startswith(f"{key}=")})


def write_one(df: DataFrame, zone: str, key: str, value: str) -> Commit:
    """Replace one partition by ``df`` (without the column ``key``), also if ``df`` is empty."""
    path = _next(df.sparkSession, zone, PART)
    target = f"{path}/{folder_of(key, value)}"
    return Commit(path, _observed(df, lambda d: d.write.parquet(target)), {value: target})


def append(df: DataFrame, zone: str, key: str, values: Sequence[str]) -> int:
    """Add rows of ``values`` to the folders that these live in; one job for each version that holds some of them."""
    spark, rows = df.sparkSession, 0
    homes: dict[str, list[str]] = {}
    current = live(spark, zone, key)
    for v in values:
        homes.setdefault(current[v].rsplit("/", 1)[0], []).append(v)
    for path, some in sorted(homes.items()):
        rows += _observed(df.where(F.col(key).isin(some)), lambda d, p=path: d.write.mode("append").partitionBy(key).parquet(p))
    return rows


def sweep(spark: SparkSession, zone: str, key: str, keep: int = 1) -> list[str]:
    """Delete the versions of which nothing is live, but for the newest ``keep`` of them, and incomplete ones that
    nobody has touched for ABANDONED_HOURS; returns their paths."""
    current = complete(spark, zone, key)
    floor = next((v.number for v in current if v.full), 0)
    used, replaced = set(), set()
    for v in reversed(current):
        if v.full or set(v.folders) - replaced:
            used.add(v.path)
        replaced |= set(v.folders)
    known = {v.path for v in current}
    dead, broken = [], []
    names = children(spark, zone)
    for name in sorted((n for n in names if _parse(n)), reverse=True):
        path, number = f"{zone}/{name}", _parse(name)[0]
        if path in used:
            continue
        if path in known or (number < floor and SUCCESS in children(spark, path)):
            dead.append(path)
        elif time.time() * 1000 - names[name] > ABANDONED_HOURS * 3_600_000 or (number < floor and _finished(spark, path, key)):
            broken.append(path)
    if floor:
        dead += [f"{zone}/{n}" for n in names if n.startswith(f"{key}=")]
    for path in dead[keep:] + broken:
        delete(spark, path)
    return dead[keep:] + broken


def _finished(spark: SparkSession, path: str, key: str) -> bool:
    """Whether a single partition was written here to its end."""
    return any(SUCCESS in children(spark, f"{path}/{n}") for n in children(spark, path) if n.startswith(f"{key}="))
