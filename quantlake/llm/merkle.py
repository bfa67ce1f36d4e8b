"""Merkle fingerprints of documents (operator 2). DataFrame functions only.

A text is its lines ("paragraphs"); runs of paragraphs are sections. A section ends behind a paragraph whose
own hash says so (one in eight on average), so an inserted paragraph moves no other section's
boundaries. Paragraph node: SHA-256 of its text; section node: SHA-256 of its paragraph nodes; root: SHA-256 of
the section nodes. Joining the paragraphs again gives the text, so equal roots mean equal texts. Below a
paragraph, its words are cut into leaves by content too: a leaf ends behind a word whose last character and length say
so (one in four on average), so a word that is put in or taken out changes the leaf that it falls into and no other. Leaves
are hashed (64 bits) to grade small edits.

Likeness of two trees: equal roots give 1; else the Dice share of their distinct leaves, at most just
below 1. ``differing`` compares section nodes first, descends only into sections that the other tree lacks, and lists the
paragraphs in them that no such section of the other tree has.

Scale: every text is hashed once, behind the one shuffle of the texts. The next document is met by a window inside buckets
of neighbouring ids; the first row of a bucket is also put behind the end of the bucket before, so buckets are
independent. Bucket bounds come from one aggregate (quantiles of the ids).

Defined cases: null text is empty and has one empty paragraph; ids are taken in descending order, null ids
last, rows equal in id by the hash of their text; after the last comes the first, so a table of
one row is its own next; repeated rows stay; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantlake.llm.common import table, whole_text

#: A leaf ends behind a word whose last code point plus length is a multiple of this
LEAF_ENDS = 4
#: A section ends behind a paragraph whose SHA-256 begins with one of these (2 of 16).
SECTION_ENDS = ("0", "8")
BUCKET_ROWS = 2000
MAX_BUCKETS = 1_000_000
QUANTILES = 64

WORD_ENDS = r"[^\S\n]+"


def paragraphs(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 256))


def section_ends(nodes: Column) -> Column:
    """Numbers (from 1) of the paragraphs that end a section."""
    n = F.size(nodes)
    return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | F.substring(F.get(nodes, i - 1), 1, 1).isin(*SECTION_ENDS))


def spans(nodes: Column, ends: Column) -> Column:
    """Of each section: its node, its first paragraph (from 0), and its paragraph nodes."""
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))

    def span(a: Column, b: Column) -> Column:
        own = F.slice(nodes, a + 1, b - a)
        return F.struct(F.sha2(F.array_join(own, ""), 256).alias("node"), a.alias("first"), own.alias("nodes"))

    return F.zip_with(starts, ends, span)


def leaf_hashes(text: Column) -> Column:
    """Distinct hashes of the leaves of a text, each a run of words of one paragraph."""
    mark = lambda w: F.when((F.ascii(F.right(w, F.lit(1))) + F.length(w)) % LEAF_ENDS == 0, F.concat(w, F.lit("\n"))).otherwise(F.concat(w, F.lit(" ")))
    words = lambda p: F.filter(F.split(p, WORD_ENDS), lambda w: w != "")
    cut = F.transform(F.split(text, "\n"), lambda p: F.split(F.array_join(F.transform(words(p), mark), ""), "\n"))
    return F.array_distinct(F.transform(F.filter(F.transform(F.flatten(cut), lambda x: F.rtrim(x)), lambda x: x != ""), lambda x: F.xxhash64(x)))


def add_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds struct ``name``: root, sections (node, first paragraph, paragraph nodes), leaves (distinct leaf hashes)."""
    nodes, ends, secs = f"{name}_p", f"{name}_e", f"{name}_s"
    df = df.withColumn(nodes, paragraphs(F.col(text)))
    df = df.withColumn(ends, section_ends(F.col(nodes))).withColumn(secs, spans(F.col(nodes), F.col(ends)))
    tree = F.struct(F.sha2(F.array_join(F.col(f"{secs}.node"), ""), 256).alias("root"), F.col(secs).alias("sections"), leaf_hashes(F.col(text)).alias("leaves"))
    return df.withColumn(name, tree).drop(nodes, ends, secs)


def likeness(a: str, b: str) -> Column:
    """0 to 1 for two tree columns."""
    la, lb = F.col(f"{a}.leaves"), F.col(f"{b}.leaves")
    dice = 2.0 * F.size(F.array_intersect(la, lb)) / F.greatest(F.size(la) + F.size(lb), F.lit(1))
    return F.when(F.col(f"{a}.root") == F.col(f"{b}.root"), 1.0).otherwise(F.least(dice, F.lit(0.999999)))


def differing(a: str, b: str) -> Column:
    """Paragraph numbers (from 0) at which tree ``a`` differs from tree ``b``, rising."""

    def apart(x: str, y: str) -> Column:
        there = F.col(f"{y}.sections.node")
        return F.filter(F.col(f"{x}.sections"), lambda s: ~F.array_contains(there, s["node"]))

    others = F.flatten(F.transform(apart(b, a), lambda s: s["nodes"]))
    places = F.transform(apart(a, b), lambda s: F.filter(
        F.transform(s["nodes"], lambda n, i: F.when(~F.array_contains(others, n), s["first"] + i)), lambda i: i.isNotNull()))
    return F.when(F.col(f"{a}.root") == F.col(f"{b}.root"), F.array().cast("array<int>")).otherwise(F.flatten(places))


def neighbour_bucket(rows: DataFrame, key: str) -> Column:
    """A number that never falls as ``key`` rises, shared by about BUCKET_ROWS rows; null keys: -1.

    Quantiles cut the keys into QUANTILES spans, equal widths cut each span, so gaps between
    clusters of ids don't crowd a bucket. At most MAX_BUCKETS in all.
    """
    k = F.col(key)
    n, low, high, cuts = rows.agg(
        F.count(k), F.min(k), F.max(k), F.percentile_approx(k, [i / QUANTILES for i in range(1, QUANTILES)], 10000)).first()
    if not n:
        return F.lit(-1).cast("long")
    per_span = max(1, min(MAX_BUCKETS // QUANTILES, -(-n // (BUCKET_ROWS * QUANTILES))))
    edges = sorted({low, *(cuts or []), high + 1})
    spans, at = [], F.lit(-1).cast("long")
    for a, b in zip(edges, edges[1:]):
        width = max(1, -(-(b - a) // per_span))
        spans.append((a, b, width))
    for i, (a, _, width) in enumerate(spans):
        at = F.when(k >= a, F.lit(i * per_span) + F.floor((k - a) / width)) if i == 0 else F.when(
            k >= a, F.lit(i * per_span) + F.floor((k - a) / width)).otherwise(at)
    return F.coalesce(at, F.lit(-1)).cast("long")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, tree, next (struct text, tree): every row with the next one in descending id."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    rows = ids.select("*", F.xxhash64("text").alias("h"))
    bucket = neighbour_bucket(ids, "doc_id")
    order = F.struct("doc_id", "h")  # null ids are least
    keyed = ids.select("doc_id", F.xxhash64("text").alias("h")).withColumn("bucket", bucket)
    heads = keyed.groupBy("bucket").agg(F.max(order).alias("head"))
    # one row per bucket, at most MAX_BUCKETS: the bucket above (or, for the highest, the lowest) borrows this head
    above = F.lead("bucket").over(Window.orderBy(F.col("bucket")))
    lowest = F.min("bucket").over(Window.orderBy(F.col("bucket")))
    lent = heads.select(F.col("head.doc_id").alias("hid"), F.col("head.h").alias("hh"), F.coalesce(above, lowest).alias("to"))
    ghosts = rows.join(F.broadcast(lent), F.col("doc_id").eqNullSafe(F.col("hid")) & (F.col("h") == F.col("hh")))
    ghosts = ghosts.select("doc_id", "text", "h", F.col("to").alias("bucket"), F.lit(True).alias("ghost"))
    every = rows.withColumn("bucket", bucket).withColumn("ghost", F.lit(False)).unionByName(ghosts)
    # hashed behind the shuffle, which then moves the texts only
    every = add_tree(every.repartition("bucket"), "text", "tree")
    w = Window.partitionBy("bucket").orderBy(F.col("ghost"), F.col("doc_id").desc_nulls_last(), F.col("h").desc())
    return every.withColumn("next", F.lead(F.struct("text", "tree")).over(w)).where(~F.col("ghost")).select("doc_id", "text", "tree", "next")


def op2_merkle_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, with their likenesses."""
    rows = with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n, k = F.length("text"), F.expr("cast(length(text) div 3 as int)")
    rows = rows.withColumn("edited", F.concat(F.left(F.col("text"), n - k), F.left(F.col("next.text"), k)))
    rows = add_tree(rows, "edited", "edited_tree")
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.col("tree.root").alias("fingerprint"), F.col("edited_tree.root").alias("edited_fingerprint"),
        likeness("tree", "edited_tree").alias("near_edited"), likeness("tree", "next.tree").alias("near_next"),
        F.size(F.array_except("edited_tree.sections.node", "tree.sections.node")).cast("long").alias("edited_sections"),
        F.array_join(F.transform(differing("edited_tree", "tree"), lambda i: i.cast("string")), ",").alias("edited_paragraphs"),
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
             first(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS nx FROM documents),
e AS (SELECT doc_id, t, nx, left(t, (length(t) - length(t) // 3)::BIGINT) || left(nx, (length(t) // 3)::BIGINT) AS ed FROM d),
v AS (SELECT doc_id, 0 AS k, t AS x FROM e UNION ALL SELECT doc_id, 1, ed FROM e UNION ALL SELECT doc_id, 2, nx FROM e),
p AS (SELECT doc_id, k, unnest(range(1, len(string_split(x, chr(10))) + 1)) AS i, sha256(unnest(string_split(x, chr(10)))) AS h FROM v),
s AS (SELECT *, coalesce(sum(CASE WHEN substr(h, 1, 1) IN ('0', '8') THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sec FROM p),
q AS (SELECT doc_id, k, sec, sha256(string_agg(h, '' ORDER BY i)) AS h FROM s GROUP BY ALL),
r AS (SELECT doc_id, k, sha256(string_agg(h, '' ORDER BY sec)) AS root, list(h) AS hs FROM q GROUP BY ALL),
w AS (SELECT doc_id, k, i, unnest(range(len(ws))) AS j, unnest(ws) AS word FROM (
  SELECT doc_id, k, i, regexp_extract_all(line, '[^ \t\x0B\f\r]+') AS ws FROM (
    SELECT doc_id, k, unnest(range(len(string_split(x, chr(10))))) AS i, unnest(string_split(x, chr(10))) AS line FROM v))),
g AS (SELECT *, coalesce(sum(CASE WHEN (unicode(right(word, 1)) + length(word)) % 4 = 0 THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id, k, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS leaf FROM w),
y AS (SELECT doc_id, k, i, leaf, string_agg(word, ' ' ORDER BY j) AS x FROM g GROUP BY ALL),
l AS (SELECT v.doc_id, v.k, coalesce(list(DISTINCT y.x) FILTER (WHERE y.x IS NOT NULL), []) AS lv FROM v LEFT JOIN y ON y.doc_id = v.doc_id AND y.k = v.k GROUP BY ALL),
j AS (SELECT e.doc_id, t, ed, a.root AS r0, b.root AS r1, c.root AS r2, x.lv AS l0, y1.lv AS l1, z.lv AS l2, a.hs AS h0, b.hs AS h1
      FROM e JOIN r a ON a.doc_id = e.doc_id AND a.k = 0 JOIN r b ON b.doc_id = e.doc_id AND b.k = 1 JOIN r c ON c.doc_id = e.doc_id AND c.k = 2
      JOIN l x ON x.doc_id = e.doc_id AND x.k = 0 JOIN l y1 ON y1.doc_id = e.doc_id AND y1.k = 1 JOIN l z ON z.doc_id = e.doc_id AND z.k = 2),
sq AS (SELECT s.doc_id, s.k, s.i, s.h, q.h AS node FROM s JOIN q ON q.doc_id = s.doc_id AND q.k = s.k AND q.sec = s.sec WHERE s.k < 2),
pa AS (SELECT n.doc_id, n.k, n.i, n.h FROM sq n WHERE NOT EXISTS (SELECT 1 FROM q o WHERE o.doc_id = n.doc_id AND o.k = 1 - n.k AND o.h = n.node)),
pl AS (SELECT doc_id, string_agg(CAST(i - 1 AS VARCHAR), ',' ORDER BY i) AS places FROM pa n WHERE k = 1
       AND NOT EXISTS (SELECT 1 FROM pa o WHERE o.doc_id = n.doc_id AND o.k = 0 AND o.h = n.h) GROUP BY doc_id)
SELECT j.doc_id, length(t)::BIGINT AS n_chars, sha256(ed) AS edited_sha256, r0 AS fingerprint, r1 AS edited_fingerprint,
  CASE WHEN r0 = r1 THEN 1.0::DOUBLE ELSE least(2.0::DOUBLE * len(list_intersect(l0, l1)) / greatest(len(l0) + len(l1), 1), 0.999999::DOUBLE) END AS near_edited,
  CASE WHEN r0 = r2 THEN 1.0::DOUBLE ELSE least(2.0::DOUBLE * len(list_intersect(l0, l2)) / greatest(len(l0) + len(l2), 1), 0.999999::DOUBLE) END AS near_next,
  len(list_filter(list_distinct(h1), lambda u: NOT list_contains(h0, u)))::BIGINT AS edited_sections,
  CASE WHEN r0 = r1 THEN '' ELSE coalesce(places, '') END AS edited_paragraphs
FROM j LEFT JOIN pl ON pl.doc_id = j.doc_id
"""
