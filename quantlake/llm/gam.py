"""Text quality by a generalised additive model with pairwise interactions (operator 12).

Each text is measured by FEATURES (lengths, shares of kinds of characters, words and lines). The model is

    logit(quality) = bias + sum over features t_i[bin_i] + sum over chosen pairs t_ij[cell_i, cell_j],

lookup tables that are learnt by cyclic boosting: one feature after the other, a tree of at most three leaves is
fitted to the gradient over that feature's bins, shrunk and added to its table, again and again. Then the pairs
whose best two-by-two cut gains most on what is left are boosted in the same way with trees of four leaves over a grid of
coarser cells. A text is scored by looking up its bins and adding.

Work: one pass measures every whole text (written as a few numbers a row); bin edges are quantiles of all rows; the
boosting itself is numpy on the driver over the bins of about MAX_FIT labelled rows at most, drawn by a hash; scoring is one
vectorised pass over the stored measures. Character and word measures are taken in pieces of PIECE characters and averaged by
their size, so a text of any length needs bounded memory and is measured whole.

Defined cases: null texts are empty, and empty texts (all measures 0) are scored like others; rows with null ids are
scored, never learnt from and not held out; of contradicting labels of one id the lower wins; null labels and
labels without a document are ignored; repeated rows score alike; without labels every score is 0.5; with labels of one
kind only, tables stay empty and the bias decides; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import free_name, prepare, stored, table, whole_text

FEATURES = (
    "length", "words", "word_length", "letters", "capitals", "digits", "marks", "symbols", "exclaimed", "bare_words", "word_repeats", "distinct_words",
    "top_word", "long_words", "capital_words", "odd_ends", "lines", "line_words", "line_repeats", "line_ends", "entropy",
)
PIECE = 1 << 18
BINS, CELLS = 48, 8          # at most, of a table's side for one feature and for a pair
MAX_FIT = 40_000             # labelled rows that are fitted on
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE, RIDGE, LEAF = 0.15, 1.0, 2.0   # shrinkage, added to a leaf's curvature, least curvature of a leaf
HELD_OUT, FOLDS, THRESHOLD = 0, 5, 0.3
LABEL = "quality"

SENTENCE_MARKS = ".,;:!?'\"()-"
LINE_ENDS = (".", "!", "?", ":", '"', "'", ")")
LETTER, UPPER, DIGIT, SPACE, MARK = 1, 2, 4, 8, 16


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kinds of the code points of the basic plane, as bits; those beyond count as symbols."""
    chars = [chr(i) for i in range(1 << 16)]
    kinds = np.zeros((1 << 16) + 1, np.uint8)
    for bit, test in ((LETTER, str.isalpha), (UPPER, str.isupper), (DIGIT, str.isdigit), (SPACE, str.isspace), (MARK, lambda c: c in SENTENCE_MARKS)):
        kinds[:-1] |= np.fromiter((bit if test(c) else 0 for c in chars), np.uint8, 1 << 16)
    return kinds


def _pieces(text: str) -> Iterator[str]:
    for at in range(0, len(text), PIECE):
        yield text[at : at + PIECE]


def measures(text: str) -> list[float]:
    """The FEATURES of one text."""
    kinds = _kinds()
    solid = letters = upper = digits = marks = symbols = cries = words = size = 0
    bare = repeats = distinct = top = long = shouted = odd = 0
    entropy = 0.0
    lines = blank_free = line_repeats = ended = 0
    for piece in _pieces(text):
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        k = kinds[np.minimum(points, 1 << 16)]
        counts = np.bincount(k, minlength=32)
        has = lambda bit: int(counts[[i for i in range(32) if i & bit]].sum())  # noqa: B023, E731
        s = len(points) - has(SPACE)
        le, di, ma = has(LETTER), has(DIGIT), has(MARK)
        solid, letters, upper, digits, marks = solid + s, letters + le, upper + has(UPPER), digits + di, marks + ma
        symbols += s - le - di - ma
        cries += piece.count("!")
        ws = piece.split()
        if ws:
            seen = Counter(ws)
            words += len(ws)
            repeats += sum(map(str.__eq__, ws, ws[1:]))
            distinct += len(seen)
            top += max(seen.values())
            for w, n in seen.items():
                last = w[-1]
                if not (last.isalnum() or last in SENTENCE_MARKS):
                    odd += n
                if len(w) > 20:
                    long += n
                if w.isupper() and len(w) > 1:
                    shouted += n
                if not any(map(str.isalnum, w)):
                    bare += n
        here, times = np.unique(points, return_counts=True)
        p = times / len(points)
        entropy += len(points) * float(-(p * np.log2(p)).sum())
        size += len(points)
        rows = [x for x in map(str.strip, piece.split("\n")) if x]
        lines += len(rows)
        line_repeats += len(rows) - len(set(rows))
        ended += sum(x.endswith(LINE_ENDS) for x in rows)
    s, w, n, le = max(1, solid), max(1, words), max(1, lines), max(1, letters)
    return [
        math.log1p(size), math.log1p(words), solid / w, letters / s, upper / le, digits / s, marks / s, symbols / s, cries / s, bare / w, repeats / w, distinct / w,
        top / w, long / w, shouted / w, odd / w, math.log1p(lines), math.log1p(words / n), line_repeats / n, ended / n, entropy / max(1, size),
    ]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))


def measure(docs: DataFrame, text_col: str = "text", name: str = "measures") -> DataFrame:
    """``docs`` with an array of its texts' FEATURES."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([measures(t) for t in texts])

    return docs.withColumn(name, of(whole_text(text_col)))


def quantile_edges(measured: DataFrame, name: str = "measures") -> list[np.ndarray]:
    """For each feature the values at which its bins begin, from quantiles over all rows."""
    at = [i / BINS for i in range(1, BINS)]
    cuts = measured.agg(*[F.percentile_approx(F.get(name, F.lit(i)), at, 10000).alias(f"c{i}") for i in range(len(FEATURES))]).first()
    return [np.unique(np.array(c or [], dtype=float)) for c in cuts]


# ---- boosting over bins (numpy) -----------------------------------------------------------------------------


def _leaf(g, h):
    return np.where(h > 0, g / (h + RIDGE), 0.0)


def _gain(g, h):
    return np.where(h >= LEAF, g * g / (h + RIDGE), -np.inf)


def line_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray | None:
    """Leaf values by bin of the best tree with two cuts, or one, over a feature's bins; None if no cut gains."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    n = len(g)
    if n < 2:
        return None
    whole = cg[-1] ** 2 / (ch[-1] + RIDGE)
    one = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1])
    cut, best = [int(one.argmax()) + 1], one.max()
    if n > 2:
        left, mid, right = _gain(cg[:-1], ch[:-1]), cg[None, :-1] - cg[:-1, None], _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1])
        two = left[:, None] + np.where(np.triu(np.ones((n - 1, n - 1), bool), 1), _gain(mid, ch[None, :-1] - ch[:-1, None]), -np.inf) + right[None, :]
        if two.max() > best:
            best, cut = two.max(), [int(i) + 1 for i in np.unravel_index(two.argmax(), two.shape)]
    if not np.isfinite(best) or best <= whole + 1e-9:
        return None
    out = np.empty(n)
    for a, b in zip([0, *cut], [*cut, n]):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values by cell of the best cut of both sides of a grid (four leaves)."""
    cg, ch = (np.cumsum(np.cumsum(a, 0), 1) for a in (g, h))
    if min(g.shape) < 2:
        return -np.inf, np.zeros_like(g)

    def corners(c):
        a = c[:-1, :-1]
        top, left = c[:-1, -1:] - a, c[-1:, :-1] - a
        return a, top, left, c[-1, -1] - a - top - left

    G, H = corners(cg), corners(ch)
    gains = sum(np.where(y > 0, x * x / (y + RIDGE), 0.0) for x, y in zip(G, H))
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    out = np.empty_like(g)
    for q, (x, y) in zip(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))), zip(G, H)):
        out[q] = _leaf(x[i, j], y[i, j])
    return float(gains[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + RIDGE)), out


@dataclass
class Model:
    """Bin edges and lookup tables; ``pairs`` holds (i, j, table over cells)."""

    bias: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], axis=1)

    def cells(self, bins: np.ndarray, i: int) -> np.ndarray:
        return bins[:, i] * min(CELLS, len(self.edges[i]) + 1) // (len(self.edges[i]) + 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        if len(x) and self.tables:
            b = self.bins(x)
            for i, t in enumerate(self.tables):
                out += t[b[:, i]]
            for i, j, t in self.pairs:
                out += t[self.cells(b, i), self.cells(b, j)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, edges: list[np.ndarray]) -> Model:
    """The model of measures ``x`` and labels ``y`` (0, 1)."""
    good = y.sum()
    model = Model(bias=float(np.log((good + 1) / (len(y) - good + 1))), edges=edges)
    if not 0 < good < len(y):
        return model
    model.tables = [np.zeros(len(e) + 1) for e in edges]
    b = model.bins(x)
    f = np.full(len(y), model.bias)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        moved = False
        for i, t in enumerate(model.tables):
            g, h = slopes()
            step = line_tree(np.bincount(b[:, i], g, len(t)), np.bincount(b[:, i], h, len(t)))
            if step is not None:
                t += RATE * step
                f += RATE * step[b[:, i]]
                moved = True
        if not moved:
            break
    cells = [model.cells(b, i) for i in range(len(edges))]
    sides = [min(CELLS, len(e) + 1) for e in edges]

    def grid(i, j, g, h):
        flat = cells[i] * sides[j] + cells[j]
        return tuple(np.bincount(flat, v, sides[i] * sides[j]).reshape(sides[i], sides[j]) for v in (g, h))

    g, h = slopes()
    ranked = sorted(((grid_tree(*grid(i, j, g, h))[0], i, j) for i in range(len(edges)) for j in range(i)), reverse=True)
    chosen = [(i, j, np.zeros((sides[i], sides[j]))) for gain, i, j in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in chosen:
            gain, step = grid_tree(*grid(i, j, *slopes()))
            if gain > 0:
                t += RATE * step
                f += RATE * step[cells[i], cells[j]]
    model.pairs = chosen
    return model


# ---- Spark ------------------------------------------------------------------------------------------------------


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", name: str = "measures", label: str = LABEL) -> Model:
    """A model from ``labels`` (doc_id, ``label``) outside the held-out rows; bin edges from all of ``measured``."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min(label).alias("_y"))
    rows = measured.select(F.col(id_col).alias("_id"), F.col(name).alias("_x")).join(known, "_id").groupBy("_id", "_x", "_y").count()
    rows = stored(rows.select("_id", "_x", "_y"), "gam-labelled")  # a row that repeats counts once
    share = min(1.0, MAX_FIT / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64("_id", "_x", F.lit(12)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = sorted(drawn.select("_id", "_x", "_y").collect())
    if not rows:
        return Model()
    x, y = np.array([r["_x"] for r in rows], dtype=float), np.array([float(r["_y"] > 0) for r in rows])
    return boost(x, y, quantile_edges(measured, name))


def score(measured: DataFrame, model: Model, name: str = "measures", out: str = "score") -> DataFrame:
    """``measured`` with the probability of label 1."""

    @F.pandas_udf("double")
    def probability(x: pd.Series) -> pd.Series:
        return pd.Series(model.probability(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    return measured.withColumn(out, probability(name))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or above."""
    name, s = free_name(docs, "measures"), free_name(docs, "score")
    measured = stored(measure(docs, name=name), "gam-measures")
    return score(measured, fit(measured, labels, name=name), name, s).where(F.col(s) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op12_quality_classifier(spark, sf_dir):
    """Every document's quality score; learnt outside the held-out fifth."""
    prepare(spark)
    measured = stored(measure(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "measures"), "gam-measures")
    scored = score(measured, fit(measured, table(spark, sf_dir, "labels").select("doc_id", LABEL)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
