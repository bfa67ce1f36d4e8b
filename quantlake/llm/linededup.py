"""Repeated-line removal by overlapping three-line windows (operator 10).

Every run of three consecutive lines is hashed (96 bits). A window that occurs more than once anywhere
keeps its first occurrence, in the order (doc_id, row key, line); every later occurrence marks its three
lines, and the marked positions of a document merge into one set that is cut out.

Scale: one row per window moves (hash, document, line), not the text; first occurrences are a map-side
combined aggregate, and the join back only meets the hashes that repeat, so a window that a third of all
documents share is one row on the small side and is split on the other by skew handling. The text
itself moves once, to meet its document's marked lines.

Defined cases: lines are what '\\n' separates, so rejoining the kept lines is exact; a document with
fewer than three lines has no window and stays; a window of three blank lines is not counted; null
text stays null; null ids order last; rows equal in id and text are one document and share the decision
of the first; other columns, whatever their names, pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import row_key, stored, table, whole_text

WINDOW_LINES = 3


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """rk, id, line, h: one row per window of ``size`` lines, for each distinct (id, text)."""
    lines = docs.select(row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("id"), F.split(whole_text(text_col), "\n").alias("lines"))
    window = F.transform(
        F.sequence(F.lit(1), F.size("lines") - (size - 1)),
        lambda i: F.array_join(F.slice("lines", i, size), "\n"),
    )
    hit = lines.where(F.size("lines") >= size).select("rk", "id", F.posexplode(window).alias("line", "w"))
    return hit.where(F.trim(F.translate("w", "\n\r\t", "   ")) != "").select(
        "rk", "id", "line", F.xxhash64("w").alias("h1"), F.hash("w", F.length("w")).alias("h2")
    )


def later_windows(windows: DataFrame) -> DataFrame:
    """The windows that repeat an earlier one."""
    place = F.struct(F.col("id").isNull().alias("last"), "id", "rk", "line")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("final"))
    first = first.where(F.col("first") != F.col("final")).select("h1", "h2", "first")
    return windows.join(first, ["h1", "h2"]).where(place != F.col("first")).select("rk", "line")


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """rk, covered: the sorted 0-based lines that later windows cover, one row per document that has any."""
    later = later_windows(stored(line_windows(docs, id_col, text_col, size), "line-windows"))
    marks = later.groupBy("rk").agg(F.collect_set("line").alias("starts"))
    spread = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (size - 1))))
    return marks.select("rk", F.array_sort(F.array_distinct(spread)).alias("covered"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """``row`` (struct: the input row), ``kept`` (its text without the covered lines), ``n_lines``, ``n_removed``."""
    cov = covered_lines(docs, id_col, text_col, size)
    rows = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("rk"), F.col(text_col).alias("text"))
    lines = F.split("text", "\n")
    # array_except on positions keeps this linear in the number of lines
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "covered")
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return rows.join(cov, "rk", "left").select(
        "row",
        F.when(F.col("covered").isNull(), F.col("text")).otherwise(kept).alias("kept"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with its text cut; every row and column stays."""
    done = dedup_lines(docs, id_col, text_col, size)
    return done.select(*[(F.col("kept") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op10_line_dedup(spark, sf_dir):
    """Every document with its lines that repeat an earlier three-line window removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "row.doc_id", F.when(F.col("row.text").isNull(), 1).otherwise(F.col("n_lines")).cast("long").alias("n_lines"), "n_removed",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ln FROM documents),
w AS (SELECT doc_id, i, ln[i] || chr(10) || ln[i + 1] || chr(10) || ln[i + 2] AS w
      FROM (SELECT doc_id, ln, unnest(range(1, len(ln) - 1)) AS i FROM d WHERE len(ln) >= 3)),
ok AS (SELECT * FROM w WHERE trim(translate(w, chr(10) || chr(13) || chr(9), '   ')) <> ''),
rk AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM ok),
cov AS (SELECT DISTINCT doc_id, i + k AS i FROM rk, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1),
ls AS (SELECT doc_id, unnest(range(1, len(ln) + 1)) AS i, unnest(ln) AS line FROM d),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS kept, count(*) AS n
         FROM ls l LEFT JOIN cov c ON l.doc_id = c.doc_id AND l.i = c.i WHERE c.i IS NULL GROUP BY 1)
SELECT d.doc_id, len(d.ln)::BIGINT AS n_lines, (len(d.ln) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""
