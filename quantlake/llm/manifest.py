"""Merkle manifest of a dataset: bitmap-rank indexing (operator 11).

A leaf is the hash of a row's columns. The leaves of a group (here: source) ascend by id; every ARITY consecutive nodes
become their hash until one, the group's subroot, remains. The subroots, in the bytewise order of the groups, become the
root in the same way. A leaf's coordinate in its tree is not found by sorting:

1. Tasks collect the ids of each group as compressed bitmaps: one container for 2^13 neighbouring ids, as an array, a
   bitmap or runs, whichever is least, with the surplus of ids that repeat. Containers of one place are merged.
2. Popcounts become directories: inside a bitmap per 64 bytes, above it per container, per 2^17 containers and
   per 2^34, each a running sum within its parent only, so no directory is one task.
3. A rank query, the directory entries before an id plus the bits before it in its container, gives the leaf's coordinate.
4. Leaves are dealt by (group, coordinate / BLOCK) into slot arrays, each filled at the coordinate. A block reduces LEVELS
   levels; block roots are the next round's nodes, keyed by their coordinate, until each group has one and then
   the groups have one. Rounds: two up to 4.7 million leaves of a group, three up to 10 billion.

The siblings of every node are kept with its block, and a leaf's proof is that of its block's slot followed by those
of the blocks above. Nothing but counts and the root reaches the driver.

Defined cases: a null column hashes as '-'; a null group is a group, first in order; null ids come before all others of
their group; rows equal in group and id ascend by leaf, and each row is a leaf, also if all columns repeat; an
empty table gives no rows; extra columns are ignored; texts of any length are hashed in place, never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quantlake.llm.common import prepare, stored, table
from quantlake.operators.ranking import with_place

ARITY, LEVELS = 3, 7
BLOCK = ARITY**LEVELS
LOW_BITS = 13               # ids of one container
DIRECTORY_BITS = 17         # containers of one directory, directories of the next
GROUP_IDS = 40_000          # ids that one task group of the index takes, about
BUFFER = 200_000            # ids that a task compresses at a time
COPIES = 4096               # copies of one row that are written out at a time
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

# ---- hashing ------------------------------------------------------------------------------------------------


def piece(c: Column) -> Column:
    """'-' for null, else the UTF-8 byte count, ':' and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[piece(c) for c in columns]), 256)


def node(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


def levels(digests: list[str], n: int) -> list[list[str]]:
    """A block's levels from its nodes to its root, in a tree that has ``n`` nodes on the lowest of them."""
    out = [digests]
    for _ in range(min(LEVELS, depth(n))):
        low = out[-1]
        out.append([node(low[i : i + ARITY]) for i in range(0, len(low), ARITY)])
    return out


def siblings(tree: list[list[str]], slot: int) -> list[str]:
    """For each level, the digests left of the path and those right of it, each run as one text."""
    out = []
    for low in tree[:-1]:
        first = slot - slot % ARITY
        out += ["".join(low[first:slot]), "".join(low[slot + 1 : first + ARITY])]
        slot //= ARITY
    return out


def fold(start: Column, proof: Column) -> Column:
    """The root that ``start`` and a proof lead to."""
    steps = F.sequence(F.lit(0), (F.size(proof) / 2).cast("int") - 1)
    climbed = F.aggregate(steps, start, lambda acc, i: F.sha2(F.concat(F.get(proof, i * 2), acc, F.get(proof, i * 2 + 1)), 256))
    return F.when(F.size(proof) == 0, start).otherwise(climbed)


# ---- compressed bitmaps -------------------------------------------------------------------------------------

_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)


def compress(lows: np.ndarray) -> bytes:
    """Distinct rising places (0 to 2^LOW_BITS - 1) as the smallest of an array, runs or a bitmap with its directory."""
    cuts = np.flatnonzero(np.diff(lows) != 1) + 1
    starts, ends = np.append(0, cuts), np.append(cuts, len(lows))
    size = (1 << LOW_BITS) // 8
    if 4 * len(starts) <= min(2 * len(lows), size):
        return b"r" + lows[starts].astype("<u2").tobytes() + (ends - starts).astype("<u2").tobytes()
    if 2 * len(lows) <= size:
        return b"a" + lows.astype("<u2").tobytes()
    bits = np.zeros(1 << LOW_BITS, np.uint8)
    bits[lows] = 1
    packed = np.packbits(bits, bitorder="little")
    directory = np.append(0, np.cumsum(_ONES[packed].reshape(-1, 64).sum(1)))[:-1]
    return b"b" + directory.astype("<u2").tobytes() + packed.tobytes()


def members(payload: bytes) -> np.ndarray:
    kind, body = payload[:1], payload[1:]
    if kind == b"a":
        return np.frombuffer(body, "<u2").astype(np.int64)
    if kind == b"r":
        starts, sizes = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        return np.repeat(starts - np.append(0, np.cumsum(sizes))[:-1], sizes) + np.arange(sizes.sum())
    packed = np.frombuffer(body[2 * (1 << LOW_BITS) // 512 :], np.uint8)
    return np.flatnonzero(np.unpackbits(packed, bitorder="little")).astype(np.int64)


def rank(payload: bytes, lows: np.ndarray) -> np.ndarray:
    """How many members lie below each of ``lows``."""
    kind, body = payload[:1], payload[1:]
    if kind == b"a":
        return np.searchsorted(np.frombuffer(body, "<u2"), lows)
    if kind == b"r":
        starts, sizes = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        at = np.searchsorted(starts, lows, side="right") - 1
        inside = np.minimum(lows - starts[at], sizes[at])
        return np.where(at < 0, 0, np.append(0, np.cumsum(sizes))[at] + inside)
    blocks = (1 << LOW_BITS) // 512
    directory, packed = np.frombuffer(body[: 2 * blocks], "<u2").astype(np.int64), np.frombuffer(body[2 * blocks :], np.uint8)
    ones = _ONES[packed].reshape(blocks, 64)
    in_block = (np.cumsum(ones, axis=1) - ones).ravel()
    byte = lows >> 3
    return directory[lows >> 9] + in_block[byte] + _ONES[packed[byte] & ((1 << (lows & 7)) - 1)]


# ---- index --------------------------------------------------------------------------------------------------

CONTAINERS = "p int, tree string, hi long, payload binary, again binary, more binary"


def _containers(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns p, tree, hi, low, m (rows of that id) to one container for each (p, tree, hi)."""
    out = []
    for (p, tree, hi), g in frame.groupby(["p", "tree", "hi"], sort=False):
        low, where = np.unique(g["low"].to_numpy(), return_inverse=True)
        more = np.bincount(where, g["m"].to_numpy(), len(low)).astype(np.int64) - 1
        again = more > 0
        out.append((p, tree, hi, compress(low), low[again].astype("<u2").tobytes(), more[again].tobytes()))
    return pd.DataFrame(out, columns=["p", "tree", "hi", "payload", "again", "more"])


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += len(b)
        if rows >= BUFFER:
            yield _containers(pd.concat(held))
            held, rows = [], 0
    if rows:
        yield _containers(pd.concat(held))


def _merged(g: pd.DataFrame) -> pd.DataFrame:
    parts = []
    for r in g.itertuples(index=False):
        low = members(r.payload)
        m = np.ones(len(low), np.int64)
        m[np.searchsorted(low, np.frombuffer(r.again, "<u2").astype(np.int64))] += np.frombuffer(r.more, np.int64)
        parts.append(pd.DataFrame({"p": r.p, "tree": r.tree, "hi": r.hi, "low": low, "m": m}))
    out = _containers(pd.concat(parts))
    out["n"] = [len(members(c)) + int(np.frombuffer(m, np.int64).sum()) for c, m in zip(out["payload"], out["more"])]
    return out


def _ranked(ids: pd.DataFrame, containers: pd.DataFrame) -> pd.DataFrame:
    ids = ids.reset_index(drop=True)
    place = np.zeros(len(ids), np.int64)
    at = {(t, h): i for i, (t, h) in enumerate(zip(containers["tree"], containers["hi"]))}
    base, payload, again, more = (containers[c].to_numpy() for c in ("base", "payload", "again", "more"))
    low = ids["low"].to_numpy()
    for key, rows in ids.groupby(["tree", "hi"], sort=False).indices.items():
        c, q = at[key], low[rows]
        found = base[c] + rank(payload[c], q)
        if len(again[c]):
            extra = np.append(0, np.cumsum(np.frombuffer(more[c], np.int64)))
            found = found + extra[np.searchsorted(np.frombuffer(again[c], "<u2"), q)]
        place[rows] = found
    return pd.DataFrame({"tree": ids["tree"], "doc_id": ids["doc_id"], "place": place})


def index(ids: DataFrame, groups: int) -> tuple[DataFrame, DataFrame]:
    """From (tree, doc_id, m), one row an id: (tree, doc_id, place), null ids at 0, and (tree, n)."""
    hi = F.shiftright("doc_id", LOW_BITS)
    keyed = ids.where(F.col("doc_id").isNotNull()).select(
        F.pmod(F.xxhash64("tree", hi), F.lit(groups)).cast("int").alias("p"), "tree", hi.alias("hi"),
        F.col("doc_id").bitwiseAND(F.lit((1 << LOW_BITS) - 1)).alias("low"), "m", "doc_id")
    parts = keyed.drop("doc_id").mapInPandas(_partial, CONTAINERS)
    containers = stored(parts.groupBy("p").applyInPandas(_merged, CONTAINERS + ", n long"), "bitmaps")
    counts = containers.select("tree", "hi", "n").withColumn("h2", F.shiftright("hi", DIRECTORY_BITS)).withColumn("h3", F.shiftright("hi", 2 * DIRECTORY_BITS))

    def before(key: list[str], order: str) -> Column:
        w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0))

    low = counts.withColumn("b1", before(["tree", "h2"], "hi")).select("tree", "hi", "h2", "b1")
    mid = counts.groupBy("tree", "h2", "h3").agg(F.sum("n").alias("n"))
    high = mid.groupBy("tree", "h3").agg(F.sum("n").alias("n"))
    nulls = ids.where(F.col("doc_id").isNull()).select("tree", F.col("m").alias("b4"))
    trees = high.select("tree", "n").unionByName(nulls.select("tree", F.col("b4").alias("n"))).groupBy("tree").agg(F.sum("n").alias("n"))
    mid = mid.withColumn("b2", before(["tree", "h3"], "h2")).select("tree", "h2", "h3", "b2")
    high = high.withColumn("b3", before(["tree"], "h3")).select("tree", "h3", "b3")
    base = low.join(mid, ["tree", "h2"]).join(high, ["tree", "h3"]).join(nulls, "tree", "left")
    base = base.select("tree", "hi", (F.col("b1") + F.col("b2") + F.col("b3") + F.coalesce("b4", F.lit(0))).alias("base"))
    whole = containers.drop("n").join(base, ["tree", "hi"])
    places = keyed.groupBy("p").cogroup(whole.groupBy("p")).applyInPandas(_ranked, "tree string, doc_id long, place long")
    first = ids.where(F.col("doc_id").isNull()).select("tree", "doc_id", F.lit(0).cast("long").alias("place"))
    return places.unionByName(first), trees


# ---- trees --------------------------------------------------------------------------------------------------


def _slots(g: pd.DataFrame) -> list[int]:
    """Row numbers of a block in the order of its slots."""
    at = (g["pos"] % BLOCK).to_numpy()
    out = np.full(len(at), -1)
    out[at] = np.arange(len(at))
    return out.tolist()


def _leaf_block(g: pd.DataFrame) -> pd.DataFrame:
    rows = g.iloc[_slots(g)]
    leaves, n = rows["leaf"].tolist(), int(rows["n"].iloc[0])
    return pd.DataFrame([{
        "tree": rows["tree"].iloc[0], "n": n, "block": int(rows["pos"].iloc[0]) // BLOCK, "root": levels(leaves, n)[-1][0],
        "ids": rows["id"].tolist(), "leaves": leaves, "notes": rows["note"].tolist()}])


def _node_block(g: pd.DataFrame) -> pd.DataFrame:
    rows = g.iloc[_slots(g)]
    tree = levels(rows["digest"].tolist(), int(rows["n"].iloc[0]))
    return pd.DataFrame({"tree": rows["tree"], "n": rows["n"], "pos": rows["pos"], "root": tree[-1][0], "proof": [siblings(tree, i) for i in range(len(rows))]})


def _rounds(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (tree, n, pos, digest): (tree, pos, proof) to the tree's root, and (tree, root)."""
    most, paths = nodes.agg(F.max("n")).first()[0] or 0, None
    while True:
        done = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).applyInPandas(
            _node_block, "tree string, n long, pos long, root string, proof array<string>")
        done = stored(done, "nodes")
        step = done.select("tree", F.col("pos").alias("at"), F.floor(F.col("pos") / BLOCK).alias("up"), F.col("proof").alias("more"))
        if paths is None:
            paths = step.select("tree", F.col("at").alias("pos"), "up", F.col("more").alias("proof"))
        else:
            paths = paths.withColumnRenamed("up", "at").join(step, ["tree", "at"]).select("tree", "pos", "up", F.concat("proof", "more").alias("proof"))
        nodes = done.where(F.col("pos") % BLOCK == 0).select(
            "tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.floor(F.col("pos") / BLOCK).alias("pos"), F.col("root").alias("digest"))
        if most <= BLOCK:
            return paths.select("tree", "pos", "proof"), nodes.select("tree", F.col("digest").alias("root"))
        most = -(-most // BLOCK)


def manifest(leaves: DataFrame) -> DataFrame:
    """From ``leaves`` (tree: string that orders the groups, doc_id long, leaf, note: text that goes along, or null) one row
    for each: tree, doc_id, pos (coordinate), leaf, note, subroot, root and proof. A proof alternates, from the leaf up to
    the root, the digests left of the path and those right of it."""
    spark = leaves.sparkSession
    entries = stored(leaves.groupBy("tree", "doc_id", "leaf", "note").agg(F.count(F.lit(1)).alias("c")), "entries")
    ids = stored(entries.groupBy("tree", "doc_id").agg(F.sum("c").alias("m"), F.count(F.lit(1)).alias("kinds")), "ids")
    n_ids = ids.count()
    empty = "tree string, doc_id long, pos long, leaf string, note string, subroot string, root string, proof array<string>"
    if not n_ids:
        return spark.createDataFrame([], empty)
    places, trees = index(ids, max(1, -(-n_ids // GROUP_IDS)))
    places, trees = stored(places, "places"), stored(trees, "trees")
    apart = entries.withColumnRenamed("tree", "t").withColumnRenamed("doc_id", "i")
    # copies of a row are written out a bounded number at a time
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(COPIES).cast("long")))
    apart = apart.select("*", runs.alias("first")).select("t", "i", "leaf", "note", F.explode(
        F.sequence(F.col("first"), F.least(F.col("first") + COPIES, F.col("c")) - 1)).alias("copy"))
    clashes = ids.where("kinds > 1").select("tree", "doc_id")
    same = F.col("t").eqNullSafe(F.col("tree")) & F.col("i").eqNullSafe(F.col("doc_id"))
    if clashes.isEmpty():
        inner = apart.select(F.col("t").alias("tree"), F.col("i").alias("doc_id"), "leaf", "note", "copy")
    else:  # ids with unequal rows: their places within the id come from one distributed order of those rows
        few = with_place(apart.join(clashes, same, "left_semi").select("t", F.col("i").alias("id"), "leaf", "note", "copy"), ["t", F.asc_nulls_first("id"), "leaf", "copy"])
        least = few.groupBy("t", "id").agg(F.min("place").alias("least")).select(F.col("t").alias("t2"), F.col("id").alias("id2"), "least")
        few = few.join(least, F.col("t").eqNullSafe(F.col("t2")) & F.col("id").eqNullSafe(F.col("id2")))
        few = few.select(F.col("t").alias("tree"), F.col("id").alias("doc_id"), "leaf", "note", (F.col("place") - F.col("least")).alias("copy"))
        alone = apart.join(clashes, same, "left_anti").select(F.col("t").alias("tree"), F.col("i").alias("doc_id"), "leaf", "note", "copy")
        inner = alone.unionByName(few)
    at = places.select(F.col("tree").alias("t"), F.col("doc_id").alias("i"), "place")
    placed = inner.join(at, same).join(trees, "tree").select(
        "tree", "n", (F.col("place") + F.col("copy")).alias("pos"), F.col("doc_id").cast("string").alias("id"), "leaf", "note")
    blocks = placed.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).applyInPandas(
        _leaf_block, "tree string, n long, block long, root string, ids array<string>, leaves array<string>, notes array<string>")
    blocks = stored(blocks, "blocks")
    nodes = blocks.select("tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"), F.col("root").alias("digest"))
    paths, subroots = _rounds(nodes)
    subroots = with_place(subroots, ["tree"])
    n_trees = subroots.count()
    tops = subroots.select(F.lit("").alias("tree"), F.lit(n_trees).cast("long").alias("n"), (F.col("place") - 1).alias("pos"), F.col("root").alias("digest"))
    top_paths, top = _rounds(tops)
    top_paths = top_paths.select((F.col("pos") + 1).alias("place"), F.col("proof").alias("over"))
    ends = subroots.withColumnRenamed("root", "subroot").join(top_paths, "place")
    root = F.lit(top.first()["root"])
    paths = paths.join(ends, "tree").select("tree", F.col("pos").alias("block"), "subroot", root.alias("top"), F.concat("proof", "over").alias("over"))

    def proofs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                tree = levels(list(r.leaves), int(r.n))
                size = len(tree[0])
                yield pd.DataFrame({
                    "tree": r.tree, "id": list(r.ids), "pos": np.arange(size) + int(r.block) * BLOCK, "leaf": tree[0], "note": list(r.notes),
                    "subroot": r.subroot, "root": r.top, "proof": [siblings(tree, i) + list(r.over) for i in range(size)]})

    got = blocks.drop("root").join(paths, ["tree", "block"]).mapInPandas(
        proofs, "tree string, id string, pos long, leaf string, note string, subroot string, root string, proof array<string>")
    return got.select("tree", F.col("id").cast("long").alias("doc_id"), "pos", "leaf", "note", "subroot", "root", "proof")


def tree_key(group: Column) -> Column:
    """A text never null that orders as the groups do: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("s"), group.cast("string")), F.lit("-"))


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 2 == 0, F.lit(False))


def op11_merkle_manifest(spark, sf_dir):
    """Every document's leaf, proof and the root that its tampered or original leaf leads to."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in COLUMNS]
    altered = leaf_digest([*columns[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    leaves = docs.select(
        tree_key(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(columns).alias("leaf"),
        F.when(tampered(F.col("doc_id")), altered).alias("note"))
    got = manifest(leaves).withColumn("folded_root", fold(F.coalesce("note", "leaf"), F.col("proof")))
    return got.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


# the lowest bit of crc32 over the decimal digits of an id, from its polynomial
_CRC = """(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT))"""


def _sql_piece(c: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || source, '-') AS tree, sha256({" || ".join(_sql_piece(c) for c in COLUMNS)}) AS leaf,
    CASE WHEN {_CRC} % 2 = 0 THEN sha256({" || ".join(_sql_piece(c if c != "text" else "replace(text, chr(10), '')") for c in COLUMNS)}) END AS note FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
up AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM p
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
sub AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 100 AS lvl, pos, n, subroot AS h FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
nodes AS (SELECT tree, lvl, pos, n, h FROM up WHERE n > 1 UNION ALL SELECT sub.tree, top.lvl, top.pos, top.n, top.h FROM top, sub WHERE top.n > 1),
start AS (SELECT p.*, sub.pos AS top_pos, sub.subroot FROM p JOIN sub USING (tree)),
runs AS (SELECT s.tree, s.pos AS leaf_pos, x.lvl, x.pos AS place, x.h,
    CASE WHEN x.lvl < 100 THEN s.pos // CAST(pow(3, x.lvl) AS BIGINT) ELSE s.top_pos // CAST(pow(3, x.lvl - 100) AS BIGINT) END AS own
  FROM start s JOIN nodes x ON x.tree = s.tree AND x.pos // 3 = CASE WHEN x.lvl < 100 THEN s.pos // CAST(pow(3, x.lvl + 1) AS BIGINT) ELSE s.top_pos // CAST(pow(3, x.lvl - 99) AS BIGINT) END),
sides AS (SELECT tree, leaf_pos, lvl, coalesce(string_agg(h, '' ORDER BY place) FILTER (WHERE place < own), '') AS l, coalesce(string_agg(h, '' ORDER BY place) FILTER (WHERE place > own), '') AS r
  FROM runs GROUP BY tree, leaf_pos, lvl),
paths AS (SELECT tree, leaf_pos, list(l ORDER BY lvl) AS ls, list(r ORDER BY lvl) AS rs, string_agg(l || r, '' ORDER BY lvl) AS joined FROM sides GROUP BY tree, leaf_pos),
folded AS (
  SELECT s.tree, s.pos, 1 AS step, coalesce(s.note, s.leaf) AS h, coalesce(ls, []) AS ls, coalesce(rs, []) AS rs FROM start s LEFT JOIN paths q ON q.tree = s.tree AND q.leaf_pos = s.pos
  UNION ALL
  SELECT tree, pos, step + 1, sha256(ls[step] || h || rs[step]), ls, rs FROM folded WHERE step <= len(ls))
SELECT s.doc_id, s.leaf, s.subroot, top.h AS root, sha256(coalesce(q.joined, '')) AS proof_sha256, f.h AS folded_root, f.h = top.h AS verified
FROM start s JOIN top ON top.n = 1 JOIN folded f ON f.tree = s.tree AND f.pos = s.pos AND f.step = len(f.ls) + 1 LEFT JOIN paths q ON q.tree = s.tree AND q.leaf_pos = s.pos
"""
