"""Exact n-gram Jaccard join of documents (operator 7).

Two documents link when their sets of word shingles have a Jaccard similarity of at least ``percent`` / 100.
The result is each document's set size and component, exact for every link.

1. Documents with equal sets are one class; the rest works on classes.
2. How often each shingle occurs is counted over all documents (4 bytes per shingle are shuffled, in as many parts as
   the data needs) and kept as log2 levels in a table of fixed size: a global order, rarest first.
   The table only orders; the join is exact for any table.
3. Index lists: a set of n shingles is listed under the first n - ceil(t n) + 1 of that order; two linked sets share one
   of these. Shingles that occur once are left out. Lists are sorted by size, then position, and met block by block: a
   pair of blocks is skipped if sizes, or the most elements that any of their sets has behind its position, rule out every link.
   A pair of a list is passed on if its sizes, its positions and the two sets' parity bitmaps (512 bits; bits that differ
   are at most the elements that differ) allow a link.
4. Answers from similar sets: classes first meet, by four min-hashes, a leader each, the one with the fewest shingles of
   its own; a class that is verified to link to its leader is connected, so lists skip all pairs inside a component. For the pairs that remain the leaders
   are compared first, and |x ^ y| (symmetric difference) lies within |rx ^ ry| +- (|x ^ rx| + |y ^ ry|): most
   pairs follow from the leaders' answer, and only the undecided are verified themselves.

Scale: texts are read in place three times; only shingle counts, list entries of shared rare shingles and the sets
of candidate classes move. A list longer than LIST_ROWS is split into blocks that meet pairwise, each in its own
group. Copies, and near copies of one leader, never expand into pairs; ``link_counts``, which asks for every link, lists pairs
of classes (not of copies) inside components too.

Defined cases: null and empty texts, and texts without words, have an empty set and link with nothing; fewer words
than a shingle: the whole sequence is the one shingle; repeated rows are one class; rows with a null id
count, their own component is the smallest non-null id reachable; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import prepare, row_key, stored, table, whole_text
from quantlake.llm.components import connected_components
from quantlake.llm.counts import count_levels, level_of, may_be_members, member_filter, sent
from quantlake.llm.wordhash import Words, scramble, shingle_sets

SHINGLE, PERCENT = 5, 80
LEADERS = 4
LEVEL_BITS = 24          # the level table has 2**LEVEL_BITS bytes
LIST_ROWS = 8192
RUN_ROWS = 200_000
BLOCK = 256
PARITY = 512


def class_of(s: np.ndarray) -> int:
    """64-bit id of a set, as a signed number."""
    if not len(s):
        return 0
    a, b = int(scramble(s).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(scramble(s + np.uint64(0x632BE59BD9B4E019))))
    return int(scramble(np.array([(3 * a + b + len(s)) % 2**64], np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def parity_bits(s: np.ndarray) -> bytes:
    """Each element flips one of PARITY bits."""
    at = (scramble(s ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(PARITY)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=PARITY) & 1).tobytes()


def min_overlap(a, b, percent: int):
    """The least intersection with which sets of a and b elements link: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def entries_of(s: np.ndarray, levels: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Shingles, positions and levels of a set's index entries, and how many of its shingles are its own."""
    level = level_of(levels, s)
    k = prefix_length(len(s), percent)
    order = np.lexsort((s, level))[:k]  # s is sorted, so ties go by hash
    lv = level[order]
    keep = lv > 0
    return s[order][keep], np.flatnonzero(keep), lv[keep], int((level == 0).sum())


def may_link(n, m, p, q, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m elements that first agree at positions p and q, with bitmaps x and y, could link."""
    need = min_overlap(n, m, percent)
    # no more than the shorter rest is shared; what is not shared flips the bits that differ
    ok = np.minimum(n - p, m - q) >= need
    ok[ok] = np.bitwise_count(x[ok] ^ y[ok]).sum(axis=1) <= (n + m - 2 * need)[ok]
    return ok


def listed_pairs(cls: np.ndarray, n: np.ndarray, pos: np.ndarray, comp: np.ndarray, bits: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one list that could link and aren't connected yet. Sorted by size, then position."""
    order = np.lexsort((pos, n))
    cls, n, pos, comp, bits = cls[order], n[order].astype(np.int64), pos[order].astype(np.int64), comp[order], bits[order]
    if (comp == comp[0]).all():
        return
    starts = np.arange(0, len(cls), BLOCK)
    rest = np.maximum.reduceat(n - pos, starts)  # of each block, the most that a set can still share
    for a in starts.tolist():
        i = slice(a, min(a + BLOCK, len(cls)))
        # sizes beyond this are ruled out for the whole block, so later blocks are skipped
        last = np.searchsorted(n, n[i][-1] * 100 // percent, "right")
        for b in range(a, last, BLOCK):
            if min(rest[a // BLOCK], rest[b // BLOCK]) < min_overlap(n[a], n[b], percent):  # sizes rise, so these ask for least
                continue
            j = slice(b, min(b + BLOCK, last))
            other = comp[i][:, None] != comp[j][None, :]
            if a == b:
                other &= np.triu(np.ones(other.shape, bool), 1)
            x, y = np.nonzero(other)
            x, y = x + a, y + b
            ok = may_link(n[x], n[y], pos[x], pos[y], bits[x], bits[y], percent)
            if ok.any():
                yield cls[x[ok]], cls[y[ok]]


def pairs_of_lists(e: np.ndarray, bits: np.ndarray, percent: int) -> Iterator[pd.DataFrame]:
    """Pairs (a, b) of whole lists; rows are token, block, block, class, size, position, component, with bitmaps.

    Lists that lie in one component are skipped. Short ones are all handled together: in order of size, each entry meets
    the next one, then the one after that, until no size is close enough; long ones go by blocks.
    """
    if not len(e):
        return
    order = np.lexsort((e[:, 5], e[:, 4], e[:, 3], e[:, 2], e[:, 1], e[:, 0]))
    e, bits = e[order], bits[order]
    fresh = np.ones(len(e), bool)
    fresh[1:] = (e[1:, :4] != e[:-1, :4]).any(axis=1)
    e, bits = e[fresh], bits[fresh]  # a class once per list
    order = np.lexsort((e[:, 5], e[:, 4], e[:, 2], e[:, 1], e[:, 0]))
    e, bits = e[order], bits[order]
    head = np.ones(len(e), bool)
    head[1:] = (e[1:, :3] != e[:-1, :3]).any(axis=1)
    starts = np.flatnonzero(head)
    sizes = np.diff(np.append(starts, len(e)))
    mixed = np.minimum.reduceat(e[:, 6], starts) != np.maximum.reduceat(e[:, 6], starts)
    for a, m in zip(starts[mixed & (sizes > BLOCK)], sizes[mixed & (sizes > BLOCK)]):
        for x, y in listed_pairs(*(e[a : a + m, c] for c in (3, 4, 5, 6)), bits[a : a + m], percent):
            yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})
    short = np.repeat(mixed & (sizes <= BLOCK), sizes)
    lists, bits = np.repeat(np.arange(len(starts)), sizes)[short], bits[short]
    cls, n, pos, comp = (e[short, c] for c in (3, 4, 5, 6))
    at, step = np.arange(len(cls)), 1
    while len(at):
        at = at[at + step < len(cls)]
        other = at + step
        near = (lists[at] == lists[other]) & (n[other] * percent <= n[at] * 100)
        at, other = at[near], other[near]
        apart = comp[at] != comp[other]
        i, j = at[apart], other[apart]
        ok = may_link(n[i], n[j], pos[i], pos[j], bits[i], bits[j], percent)
        if ok.any():
            x, y = cls[i[ok]], cls[j[ok]]
            yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}).drop_duplicates()
        step += 1


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``common``: the size of the intersection."""

    @F.pandas_udf("int")
    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8"), assume_unique=True)) for p, q in zip(x, y)])

    left = sets.select(F.col("cls").alias("a"), F.col("items").alias("ia"), F.col("n").alias("na"))
    right = sets.select(F.col("cls").alias("b"), F.col("items").alias("ib"), F.col("n").alias("nb"))
    return pairs.join(left, "a").join(right, "b").withColumn("common", common("ia", "ib")).drop("ia", "ib")


def joined_classes(
    docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, lower: bool, every: bool,
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, rk, cls, n) and links (a, b) between classes of equal sets: enough of them to connect each component, or
    ``every`` one."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rk"), whole_text(text_col).alias("text"))

    def shingles(texts) -> np.ndarray:
        sets = list(shingle_sets(Words(lower), texts, size))
        return np.concatenate(sets) if sets else np.zeros(0, np.uint64)

    levels = sent(spark, count_levels(texts.select("text"), shingles, LEVEL_BITS, 5))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, seen = Words(lower), set()
        salts = scramble(np.arange(1, LEADERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for b in batches:
            found, low, rare, entries = [], [], [], []
            for s in shingle_sets(words, b["text"], size):
                c = class_of(s)
                tokens, at, lv, own = entries_of(s, levels.value, percent)
                found.append((c, len(s)))
                rare.append(own)
                low.append([int(scramble(s ^ x).min().view(np.int64)) for x in salts] if len(s) else None)
                if len(tokens) and c not in seen:  # a class that this task has listed needs no second entry
                    if len(seen) < 1_000_000:
                        seen.add(c)
                    bits = parity_bits(s)
                    for t, p, v in zip(tokens.view(np.int64).tolist(), at.tolist(), lv.tolist()):
                        entries.append((t, c, len(s), p, v, bits))
            yield pd.DataFrame({
                "doc_id": b["doc_id"].astype("Int64"), "rk": b["rk"].astype("Int64"), "cls": [c for c, _ in found], "n": [n for _, n in found],
                "rare": rare, "low": low, "token": pd.array([None] * len(b), "Int64"), "pos": 0, "level": 0, "bits": None})
            if entries:
                none = pd.array([None] * len(entries), "Int64")
                yield pd.DataFrame({
                    "doc_id": none, "rk": none, "cls": [e[1] for e in entries], "n": [e[2] for e in entries], "rare": 0, "low": None,
                    "token": pd.array([e[0] for e in entries], "Int64"), "pos": [e[3] for e in entries], "level": [e[4] for e in entries],
                    "bits": [e[5] for e in entries]})

    schema = "doc_id long, rk long, cls long, n int, rare int, low array<long>, token long, pos int, level int, bits binary"
    both = stored(texts.mapInPandas(index, schema), "shingle-index")
    levels.destroy()
    rows = both.where("token is null").select("doc_id", "rk", "cls", "n", "rare", "low")
    entries = both.where("token is not null").select("token", "cls", "n", "pos", "level", "bits")

    # leaders: of each min-hash bucket the class with the fewest shingles that no other has
    classes = rows.where("n > 0").select("cls", "n", "rare", "low").dropDuplicates(["cls"])
    lows = classes.select("cls", "n", "rare", F.posexplode("low").alias("k", "low"))
    heads = lows.groupBy("k", "low").agg(F.min(F.struct("rare", "cls", "n")).alias("head"), F.count("*").alias("c")).where("c > 1")
    stars = lows.join(heads, ["k", "low"]).where(F.col("cls") != F.col("head.cls")).select(
        F.col("cls").alias("a"), F.col("head.cls").alias("b"), "n", F.col("head.n").alias("m"))
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    stars = stored(stars.where(fits).select("a", "b").distinct(), "stars")

    # whole sets, of the classes that any pair could need
    wanted = sent(spark, member_filter(
        stars.select(F.col("a").alias("cls")).unionAll(stars.select("b")).unionAll(entries.select("cls")).distinct(), "cls"))

    def whole_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, seen = Words(lower), set()
        for b in batches:
            out = []
            for s in shingle_sets(words, b["text"], size):
                c = class_of(s)
                if len(s) and c not in seen and may_be_members(wanted.value, np.array([c], np.int64))[0]:
                    if len(seen) < 1_000_000:
                        seen.add(c)
                    out.append((c, len(s), s.astype("<u8").tobytes()))
            yield pd.DataFrame(out, columns=["cls", "n", "items"])

    sets = texts.select("text").mapInPandas(whole_sets, "cls long, n int, items binary")
    sets = stored(sets.dropDuplicates(["cls"]), "sets")
    wanted.destroy()

    def linked(df: DataFrame) -> DataFrame:
        return df.where(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent)

    close = stored(linked(verified(stars, sets)).withColumn("delta", F.col("na") + F.col("nb") - 2 * F.col("common")), "close")
    comps = stored(connected_components(close), "leader-components")
    led = close.groupBy("a").agg(F.min(F.struct("delta", "b")).alias("x")).select(
        F.col("a").alias("cls"), F.col("x.b").alias("leader"), F.col("x.delta").alias("delta"))

    # index lists; long ones as blocks that meet pairwise
    blocks = F.ceil(F.pow(F.lit(2.0), F.col("level") + 1) / LIST_ROWS).cast("int")
    mine = F.pmod(F.xxhash64("cls", F.lit(5)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    if every:
        listed = entries.withColumn("component", F.col("cls"))
    else:
        listed = entries.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    listed = listed.withColumn("mine", mine).withColumn("other", other).select(
        "token", "cls", "n", "pos", "component", "bits", F.least("mine", "other").alias("g1"), F.greatest("mine", "other").alias("g2"))
    listed = listed.repartition("token", "g1", "g2").sortWithinPartitions("token", "g1", "g2", "cls")

    def pairs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Streams sorted entries; holds about RUN_ROWS of them, or one list."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for b in batches:
            if not len(b):
                continue
            held.append((b[["token", "g1", "g2", "cls", "n", "pos", "component"]].to_numpy(np.int64),
                         np.frombuffer(b"".join(b["bits"]), "<u8").reshape(len(b), -1)))
            rows += len(b)
            if rows >= RUN_ROWS:
                e, bits = (np.concatenate(x) for x in zip(*held))
                cut = int(np.flatnonzero((e[:, :3] != e[-1, :3]).any(axis=1))[-1]) + 1 if (e[0, :3] != e[-1, :3]).any() else 0
                yield from pairs_of_lists(e[:cut], bits[:cut], percent)
                held, rows = [(e[cut:], bits[cut:])], len(e) - cut
        if rows:
            yield from pairs_of_lists(*(np.concatenate(x) for x in zip(*held)), percent)

    pairs = listed.mapInPandas(pairs_of, "a long, b long").distinct()

    # the leaders' answers first; |x ^ y| is known within the two distances to the leaders
    side = led.select("cls", "leader", "delta")
    known = pairs.join(side.toDF("a", "la", "da"), "a", "left").join(side.toDF("b", "lb", "db"), "b", "left").select(
        "a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"),
        (F.coalesce("da", F.lit(0)) + F.coalesce("db", F.lit(0))).alias("off"))
    known = stored(known, "pairs")
    lead = verified(known.where("la != lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), sets)
    lead = stored(lead.withColumn("apart", F.col("na") + F.col("nb") - 2 * F.col("common")), "leader-pairs")
    size_of = classes.select("cls", "n")
    told = known.join(lead.select(F.col("a").alias("la"), F.col("b").alias("lb"), "apart"), ["la", "lb"], "left")
    told = told.join(size_of.toDF("a", "na"), "a").join(size_of.toDF("b", "nb"), "b")
    # link iff |x ^ y| <= (a + b) (100 - percent) / (100 + percent)
    most = (F.col("na") + F.col("nb")) * (100 - percent)
    apart = F.when(F.col("la") == F.col("lb"), 0).otherwise(F.col("apart"))
    told = stored(told.select("a", "b", ((apart + F.col("off")) * (100 + percent) <= most).alias("sure"),
                              ((apart - F.col("off")) * (100 + percent) <= most).alias("maybe")), "told")
    rest = linked(verified(told.where("maybe and not sure").select("a", "b"), sets)).select("a", "b")
    edges = close.select("a", "b").unionAll(told.where("sure").select("a", "b")).unionAll(rest)
    return rows, edges


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT, lower: bool = True,
) -> DataFrame:
    """doc_id, rk, n_shingles, component_id, component of every row of ``docs``.

    ``rk`` is the row's key of (id, text), ``component`` a number that rows share exactly if links join them.
    """
    rows, edges = joined_classes(docs, id_col, text_col, size, percent, lower, every=False)
    final = connected_components(edges)

    ids = rows.groupBy("cls").agg(F.min("doc_id").alias("first"), F.max("n").alias("n")).where("n > 0")
    ids = ids.join(final.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = ids.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = ids.join(least, "component").select("cls", "component", "component_id")
    out = rows.select("doc_id", "rk", "cls", "n").join(by_class, "cls", "left")
    return out.select("doc_id", "rk", F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.coalesce("component", "rk").alias("component"))


def link_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT, lower: bool = True,
) -> DataFrame:
    """doc_id, rk, n_shingles, class_id (rows of equal sets share it), n_links (other rows that this one links with) of every row."""
    rows, edges = joined_classes(docs, id_col, text_col, size, percent, lower, every=True)
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sizes = rows.where("n > 0").groupBy("cls").agg(F.count("*").alias("copies"))
    both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(sizes.toDF("b", "copies"), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("copies").alias("near"))
    counts = sizes.join(near, "cls", "left").select("cls", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    out = rows.select("doc_id", "rk", "cls", "n").join(counts, "cls", "left")
    return out.select("doc_id", "rk", F.col("n").cast("long").alias("n_shingles"), F.col("cls").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``docs``: that of the smallest id, null ids last, ties by the hash of id and text.

    Rows without words are linked with nothing and all stay; of rows equal in id and text one stays.
    """
    got = jaccard_components(docs, id_col, text_col, size, percent).where("n_shingles > 0")
    kept = got.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rk")).alias("k"))
    kept = kept.select(F.col("k.rk").alias("rk"))
    rows = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("rk"), whole_text(text_col).rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    worded = rows.where("worded").join(kept, "rk", "left_semi").dropDuplicates(["rk"])
    return rows.where("not worded").select("row.*").unionAll(worded.select("row.*"))


def op7_ngram_jaccard_join(spark, sf_dir):
    """Every document's set of 4-word shingles and its component of links of 0.85 or more."""
    prepare(spark)
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=85).select(
        "doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3])) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n, s FROM s),
x AS (SELECT doc_id, n, unnest(s) AS g FROM n),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * i >= 85 * (na + nb - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS o FROM n UNION SELECT r.d, e.b FROM r JOIN e ON r.o = e.a)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.o)::BIGINT AS component_id FROM n JOIN r ON r.d = n.doc_id GROUP BY ALL
"""
