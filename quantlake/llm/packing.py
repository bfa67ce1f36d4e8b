"""Best-fit packing of tokenised documents into sequences of a fixed length (operator 1).

``tokenize_pieces`` turns each row into token ids (byte-level BPE, 50,257 ids) plus one end id, cuts
only what is longer than a sequence, and writes the pieces with their ids to the shared folder.
``pack`` packs the piece lengths by best-fit decreasing: a segment tree over the remaining capacities
0..capacity finds the tightest open bin in O(log capacity) steps per piece. Pieces are dealt by hash
into groups of about ``GROUP_PIECES``, each packed in one task; only (row, piece, length) moves.
A group holds a random sample of all lengths, so splitting costs at most about one part-filled
sequence per group. ``assemble`` joins the pieces of each sequence into one id buffer.

The ids are those of ``byte_bpe_50k.json`` read by ``tokenizers``. The merges are applied by ``tiktoken``
from the same vocabulary's rank file, which gives identical ids (tested on whole tables) five times faster. Its splitting
pattern gives up on blank runs of several hundred thousand characters, so runs of LONG_BLANKS or more are cut out first: all of
one but its last character (which may begin the next word) is a single unit for the merges, as the pattern would have it.

Defined cases: null text is empty; an empty document is one piece holding only the end id; repeated
rows and repeated ids are packed separately; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import prepare, stored, table, whole_text

SEQUENCE_TOKENS = 2048
END_ID = 0
GROUP_PIECES = 32768
SPECIAL = {"<|endoftext|>": 50256}

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def _encoding(rank_file: str):
    import public_tokenizers
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


#: Blank runs of so many characters (white space as Unicode defines it) bypass the pattern.
LONG_BLANKS = 100_000
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_BLANKS)


def token_ids(enc, text: str) -> list[int]:
    """Ids of a text of any length and content."""
    if len(text) < LONG_BLANKS:
        return enc.encode(text, allowed_special="all")
    ids, at = [], 0
    for run in BLANKS.finditer(text):
        end = run.end()
        if end < len(text) and not text.startswith(tuple(SPECIAL), end):
            end -= 1
        ids += enc.encode(text[at : run.start()], allowed_special="all")
        ids += enc._encode_single_piece(text[run.start() : end])
        at = end
    return ids + enc.encode(text[at:], allowed_special="all")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of ``n`` tokens: one if it fits, else full pieces behind a shorter first one."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n, capacity)] if n > capacity else [0]


def tokenize_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID, rank_file: str | None = None,
) -> DataFrame:
    """PIECES rows: ``ids`` are little-endian unsigned 32-bit ids, ``row`` numbers the input rows."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        enc = _encoding(rank_file or vocabulary())  # where the task runs
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["id"], batch["text"]):
                ids = token_ids(enc, text)
                ids.append(end_id)
                buf, starts = np.asarray(ids, dtype="<u4"), cut_points(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    raw = buf[a:b].tobytes()
                    out.append((row, doc_id, k, a, b - a, zlib.crc32(raw), raw))
                row += 1
            df = pd.DataFrame(out, columns=["row", "doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            df["doc_id"] = df["doc_id"].astype("Int64")
            yield df

    return docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text")).mapInPandas(encode, PIECES)


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity; a leaf is the number of open bins with that much room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int:
        """The smallest room >= need that an open bin has, or -1."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return -1
        while i < self.size:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1..capacity), longest first, each into the tightest open bin."""
    tree, open_bins = CapacityTree(capacity), [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        room = tree.tightest(need)
        if room < 0:
            room, b, made = capacity, made, made + 1
        else:
            b = open_bins[room].pop()
            tree.add(room, -1)
        bins[i], offsets[i] = b, capacity - room
        if room > need:
            open_bins[room - need].append(b)
            tree.add(room - need, 1)
    return bins, offsets


def place(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """row, piece, sequence_id, offset for stored pieces."""
    groups = max(1, math.ceil(pieces.count() / group_pieces))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "piece"], ignore_index=True)
        bins, offsets = best_fit_decreasing(pdf["length"].to_numpy(), capacity)
        return pd.DataFrame({"row": pdf["row"], "piece": pdf["piece"], "sequence_id": pdf["grp"] * 2**32 + bins, "offset": offsets})

    dealt = pieces.select("row", "piece", "length", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInPandas(fit, "row long, piece int, sequence_id long, offset long")


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset."""
    pieces = stored(tokenize_pieces(docs, id_col, text_col, capacity, end_id), "pieces")
    placed = place(pieces, capacity, group_pieces)
    return pieces.join(placed, ["row", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"
    )


def assemble(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids as one buffer. A sequence holds at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), parts.alias("parts")).select(
        "sequence_id", "tokens", F.expr("aggregate(parts.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
    )


def op1_best_fit_packing(spark, sf_dir):
    """Every document packed into sequences of 2048 tokens; one row per piece."""
    prepare(spark)
    return pack(table(spark, sf_dir, "documents")).drop("ids")
