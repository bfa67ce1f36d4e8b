"""Removal of word sequences that occur earlier in the corpus (operator 9): an FM-index per shard.

A window is 20 consecutive words. Each window belongs to the shard of its least 8-word gram (by hash), so equal
windows always meet. Neighbouring windows with the same least gram are one segment, the unit that is sent. Segments
whose gram occurs once cannot repeat and are dropped after exact counting. Equal segments are collapsed: every later
occurrence is covered whole, and the first ones are indexed where a gram has several different segments. A shard
concatenates its segments in corpus order, builds a wavelet-matrix FM-index, streams the segments through backward search
and reports the windows whose sequence also starts earlier; the intervals of a document are merged and cut out.

Scale: texts are read three times in place; 4 bytes per segment are shuffled to count, then the places of segments that
could repeat, the words of those that are indexed, and the texts once with their intervals. Shards hold about SHARD_WORDS words whatever the input. A gram that
is least in many places (level HOT_LEVEL or more) is sent window by window, dealt by the whole window's hash, so a
passage that a third of all documents share is spread and its equal windows collapse.

Matching statistics are kept for one length: the threshold. Two sequences count as equal when their 64-bit word
hashes agree.

Defined cases: null text has no words; texts of fewer than 20 words keep all; windows may overlap their own earlier
occurrence; order is (doc_id, row key, start), null ids last; rows equal in id and text are one document
and get one answer; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import prepare, row_key, stored, table, whole_text
from quantlake.llm.counts import count_levels, level_of, may_be_members, member_filter, sent
from quantlake.llm.fmindex import FMIndex
from quantlake.llm.wordhash import Words, joined, scramble

WINDOW = 20
GRAM = 8
LEVEL_BITS = 25
SHARD_WORDS = 1_500_000
HOT_LEVEL = 12
WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Segments:
    """Segments of a batch: arrays gram, first (word in the batch), length, and text (number of the text)."""

    def __init__(self, words: Words, texts, window: int = WINDOW, size: int = GRAM):
        self.h, counts = words.of(texts)
        self.text_start = np.cumsum(counts) - counts
        n, reach = len(self.h), window - size + 1
        self.gram = self.first = self.length = self.text = np.zeros(0, np.int64)
        if n < window:
            return
        grams = scramble(joined(self.h, size))
        least = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(n - window + 1)
        start = np.flatnonzero(np.repeat(counts - window + 1 > 0, counts))  # words of texts that have a window
        owner = np.repeat(np.arange(len(counts)), counts)
        start = start[start <= (self.text_start + counts - window)[owner[start]]]
        if not len(start):
            return
        least, owner = least[start], owner[start]
        new = np.flatnonzero(np.diff(least, prepend=-1) | np.diff(owner, prepend=-1))
        self.gram, self.first, self.text = grams[least[new]], start[new], owner[new]
        self.length = np.append(new[1:], len(start)) - new + window - 1


def segment_ids(h: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of each run of words."""
    base, inverse = np.uint64(0xD6E8FEB86659FD93), np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
    up, down = np.full(len(h) + 1, base, np.uint64), np.full(len(h) + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(scramble(h) * up[:-1], out=sums[1:])
    return scramble((sums[first + length] - sums[first]) * down[first] + length.astype(np.uint64))


def place_key(seg: np.ndarray, rk: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hash of a segment at one place."""
    at = rk.astype(np.int64).view(np.uint64) + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return scramble(seg.astype(np.int64).view(np.uint64) ^ scramble(at)).view(np.int64)


def repeated_in_shard(pieces: list[np.ndarray], window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
    """(piece, first word, length) of the stretches that windows with an earlier start cover.

    ``pieces`` are arrays of word hashes in corpus order; each has at least ``window`` words.
    """
    sizes = np.array([len(p) for p in pieces])
    numbers = np.unique(np.concatenate(pieces), return_inverse=True)[1].astype(np.int64) + 1
    begin = np.cumsum(sizes) - sizes
    text = np.zeros(len(numbers) + len(pieces), np.int64)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    text[np.arange(len(numbers)) + owner] = numbers
    place = begin + np.arange(len(pieces))  # of a piece in the text
    index = FMIndex(text, window)
    found_piece, found_at = [], []
    for piece, at, earliest in index.earliest_windows(np.split(numbers, begin[1:])):
        again = earliest < place[piece] + at
        found_piece.append(piece[again])
        found_at.append(at[again])
    if not found_piece:
        return
    piece, at = np.concatenate(found_piece), np.concatenate(found_at)
    order = np.lexsort((at, piece))
    piece, at = piece[order], at[order]
    new = np.flatnonzero((np.diff(piece, prepend=-1) != 0) | (np.diff(at, prepend=-9) != 1))
    for a, b in zip(new, np.append(new[1:], len(at))):
        yield int(piece[a]), int(at[a]), int(b - a + window - 1)


def covered_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """rk, start, length: stretches of words (overlapping ones stay apart) that repeat earlier windows."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("rk"), whole_text(text_col).alias("text"))

    def grams(batch) -> np.ndarray:
        return Segments(Words(), batch, window, gram).gram.astype(np.uint64)

    levels = sent(spark, count_levels(texts.select("text"), grams, LEVEL_BITS, 40))

    def cut(words: Words, b: pd.DataFrame):
        """Segments of a batch that could repeat: text, first word, length, segment id and the hash that deals them."""
        s = Segments(words, b["text"], window, gram)
        level = level_of(levels.value, s.gram.astype(np.uint64))
        cold, hot = (level > 0) & (level < HOT_LEVEL), np.flatnonzero(level >= HOT_LEVEL)
        many = s.length[hot] - window + 1
        single = np.repeat(s.first[hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        first = np.concatenate([s.first[cold], single])
        length = np.concatenate([s.length[cold], np.full(len(single), window)])
        seg = segment_ids(s.h, first, length) if len(first) else np.zeros(0, np.uint64)
        deal = np.concatenate([s.gram[cold].astype(np.uint64), seg[int(cold.sum()) :]])
        # 32 bits deal the grams; grams that agree in them only share a shard
        return s, np.concatenate([s.text[cold], np.repeat(s.text[hot], many)]), first, length, seg.view(np.int64), (deal >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for b in batches:
            s, text, first, length, seg, deal = cut(words, b)
            yield pd.DataFrame({
                "seg": seg, "deal": deal, "id": b["id"].astype("Int64").array[text], "rk": b["rk"].to_numpy()[text],
                "start": (first - s.text_start[text]).astype(np.int32), "length": length.astype(np.int32)})

    found = stored(texts.mapInPandas(occurrences, "seg long, deal int, id long, rk long, start int, length int"), "segments")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "rk", "start")
    first = stored(found.groupBy("seg").agg(
        F.min(place).alias("first"), F.max(place).alias("final"), F.max("deal").alias("deal"), F.max("length").alias("length")), "first")
    again = first.where("first != final").select("seg", "first")
    later = found.select("seg", "id", "rk", "start", "length").join(again, "seg").where(place != F.col("first")).select("rk", "start", "length")

    # a gram with a single segment, however often that occurs, has nothing more to find
    busy = first.groupBy("deal").agg(F.count("*").alias("n")).where("n > 1").select("deal")
    index = stored(first.join(busy, "deal").select("deal", "seg", "first.last", "first.id", "first.rk", "first.start", "length"), "indexed")
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("deal"), F.lit(shards)).cast("int").alias("shard")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"pk": place_key(*(b[c].to_numpy() for c in ("seg", "rk", "start")))})

    # a segment's words are sent from its first place only
    wanted = sent(spark, member_filter(index.select("seg", "rk", "start").mapInPandas(keyed, "pk long"), "pk"))

    def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, seen = Words(), set()
        for b in batches:
            s, text, first, length, seg, deal = cut(words, b)
            coded, keep = s.h.astype("<u8"), []
            here = place_key(seg, b["rk"].to_numpy()[text], first - s.text_start[text]) if len(seg) else seg
            for k in np.flatnonzero(may_be_members(wanted.value, here)).tolist():
                i = int(seg[k])
                if i not in seen:
                    keep.append(k)
                    if len(seen) < 1_000_000:
                        seen.add(i)
            yield pd.DataFrame({
                "seg": seg[keep], "deal": deal[keep], "words": [coded[a : a + n].tobytes() for a, n in zip(first[keep].tolist(), length[keep].tolist())]})

    text_of = texts.select("rk", "text").mapInPandas(bodies, "seg long, deal int, words binary")

    def search(places: pd.DataFrame, bodies_: pd.DataFrame) -> pd.DataFrame:
        pdf = places.drop(columns="shard").merge(bodies_[["seg", "words"]].drop_duplicates("seg"), on="seg")
        pdf = pdf.sort_values(["last", "id", "rk", "start"], ignore_index=True)
        got = list(repeated_in_shard([np.frombuffer(w, "<u8") for w in pdf["words"]], window)) if len(pdf) else []
        at = np.array([g[0] for g in got], np.int64)
        return pd.DataFrame({
            "rk": pdf["rk"].to_numpy()[at], "start": (pdf["start"].to_numpy()[at] + np.array([g[1] for g in got], np.int64)).astype(np.int32),
            "length": np.array([g[2] for g in got], np.int32)})

    left = index.select(shard, "seg", "last", "id", "rk", "start").groupBy("shard")
    right = text_of.select(shard, "seg", "words").groupBy("shard")
    return left.cogroup(right).applyInPandas(search, "rk long, start int, length int").unionByName(later)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by a space) of every row of ``docs``."""
    cuts = covered_stretches(docs, id_col, text_col, window).groupBy("rk").agg(F.collect_list(F.struct("start", "length")).alias("cuts"))
    cuts = stored(cuts, "cuts")
    # texts without cuts are finished where they are read; only the others (and a few that the filter lets through) move
    touched = sent(docs.sparkSession, member_filter(cuts, "rk"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"), row_key(id_col, text_col).alias("rk"))
    cuts = cuts.select("rk", F.col("cuts.start").alias("starts"), F.col("cuts.length").alias("lengths"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total, removed, kept = [], [], []
            if "starts" not in b:
                b = b[~may_be_members(touched.value, b["rk"].to_numpy(np.int64))].assign(starts=None, lengths=None)
            for text, starts, lengths in zip(b["text"], b["starts"], b["lengths"]):
                words = WORD.findall(text)
                total.append(len(words))
                if starts is not None and len(starts):
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + lengths, -1)
                    left = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    words = [words[i] for i in left]
                removed.append(total[-1] - len(words))
                kept.append(" ".join(words))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "n_words": total, "n_removed": removed, "kept": kept})

    @F.pandas_udf("boolean")
    def may_be_cut(rk: pd.Series) -> pd.Series:
        return pd.Series(may_be_members(touched.value, rk.to_numpy(np.int64)))

    out = "doc_id long, n_words long, n_removed long, kept string"
    moved = rows.where(may_be_cut("rk")).join(cuts, "rk", "left")
    return rows.mapInPandas(cut, out).unionAll(moved.mapInPandas(cut, out))


def op9_substring_dedup(spark, sf_dir):
    """Every document without the words of 20-word windows that start earlier in the corpus."""
    prepare(spark)
    got = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM x),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest(range(20)) AS k) WHERE n > 1),
v AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
k AS (SELECT v.doc_id, string_agg(word, ' ' ORDER BY v.i) AS kept, count(*) AS n FROM v LEFT JOIN c ON v.doc_id = c.doc_id AND v.i = c.i
      WHERE c.i IS NULL GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
