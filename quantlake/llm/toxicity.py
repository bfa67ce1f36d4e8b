"""Toxicity scores by non-negative positive-unlabelled learning (operator 4).

Confirmed toxic examples P, and unlabelled text U of which a share ``prior`` is toxic too. A linear model over
words and word beginnings minimises the class-prior-corrected risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]),     l(z) = log(1 + exp(-z)),

whose second term would be negative only by overfitting; when it falls below zero the step goes against it.
Training is numpy on the driver over a bounded sample; ``prior`` is the toxic share of the labelled
rows that may be learnt from. Scores are the logistic of f, over the whole of every text.

No feature is switched off by a count: a weight is the feature's relevance times a coefficient, and the penalty
is on the coefficients, so that weak evidence must pay more for the same weight. Relevance grows from 0 to 1 with the
surplus of toxic examples in standard deviations, and is 1/2 where the largest surplus of as many features would
be by chance, sqrt(2 log features); so small label sets learn too. Coefficients start at log((np + 1) / (expected + 1)).

Bounds (parameters): at most MAX_POSITIVE toxic and about MAX_UNLABELLED unlabelled rows are fitted on, each as the
features of a vocabulary of at most MAX_FEATURES, chosen by an aggregate over that sample. The driver
holds only those index lists. Scoring reads each text once, in place; nothing is shuffled but the small tables.

Defined cases: null and empty texts have no features and score the model's bias; null ids are never learnt from
and are not held out; labels without a document, null or contradicting labels of one id (toxic wins) are
harmless; repeated rows score alike; without any toxic example every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import prepare, stored, table, whole_text

MAX_POSITIVE = 6000
MAX_UNLABELLED = 12000
MAX_FEATURES = 30000
MIN_POSITIVES = 2       # a feature of a single toxic example says nothing that its text doesn't
PREFIXES = (4, 5)
THRESHOLD = 0.3
MAX_PRIOR = 0.25        # below the threshold: a text without any evidence is not rejected
HELD_OUT = 2            # rows whose crc32(doc_id) mod 4 is this are never learnt from
EPOCHS, BATCHES, RATE, DECAY = 40, 16, 0.05, 1e-4
SHRINK, PER_BATCH = 1e-3, 4  # penalty of the coefficients; toxic examples of a batch at least, where there are few

WORD = re.compile(r"[^\W_]+")


def features(text: str) -> set[str]:
    """Distinct lower-case words, and the first letters of longer ones (marked by '*')."""
    words = set(WORD.findall(text.lower()))
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == HELD_OUT, F.lit(False))


def nnpu(x: list[np.ndarray], y: np.ndarray, prior: float, dims: int, epochs: int = EPOCHS, seed: int = 0,
         relevance: np.ndarray | None = None, start: np.ndarray | None = None, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias from feature index lists ``x``; ``y`` is 1 for confirmed, 0 for unlabelled rows.

    Weights are ``relevance`` (1) times coefficients, which begin at ``start`` (0) and bear the penalty ``decay``."""
    rng, sizes = np.random.default_rng(seed), np.array([len(i) for i in x])
    flat = np.concatenate(x) if len(x) else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    theta = np.append(np.zeros(dims) if start is None else start, np.log(prior / (1 - prior)))
    scale = np.append(np.ones(dims) if relevance is None else relevance, 1.0)
    m, v, step = np.zeros(dims + 1), np.zeros(dims + 1), 0
    pos, unl = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    batches = min(BATCHES, max(1, len(pos) // PER_BATCH))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for _ in range(epochs):
        for p, u in zip(np.array_split(rng.permutation(pos), batches), np.array_split(rng.permutation(unl), batches)):
            if not len(p) or not len(u):
                continue
            rows = np.concatenate([p, u])
            n = sizes[rows]
            owner = np.repeat(np.arange(len(rows)), n)
            at = flat[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[rows] - n, n)]
            f = np.bincount(owner, weights=(scale * theta)[at], minlength=len(rows)) + theta[dims]
            s, k = sigmoid(f), len(p)
            loss_neg = np.logaddexp(0, f)
            corrected = loss_neg[k:].mean() - prior * loss_neg[:k].mean()
            g = np.empty(len(rows))
            if corrected >= 0:
                g[:k], g[k:] = prior * (s[:k] - 1) / k - prior * s[:k] / k, s[k:] / len(u)
            else:  # go back up: the gradient of minus the corrected term
                g[:k], g[k:] = prior * s[:k] / k, -s[k:] / len(u)
            grad = scale * np.append(np.bincount(at, weights=g[owner], minlength=dims), g.sum()) + decay * np.append(theta[:dims], 0)
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return (scale * theta)[:dims], float(theta[dims])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, float], float, float]:
    """Feature weights, bias and prior, from ``labels`` (doc_id, toxic) outside the held-out rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum(F.col("toxic")), F.lit(0))).first()
    if not toxic:
        return {}, 0.0, 0.0
    prior = min(MAX_PRIOR, toxic / n)
    open_docs = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = docs.count()
    lot = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    chosen = known.where("toxic = 1").orderBy(lot, "doc_id").limit(MAX_POSITIVE).select("doc_id", F.lit(1).alias("y"))
    unlabelled = lot < int(min(1.0, MAX_UNLABELLED / max(1, rows * 0.75)) * (1 << 30))
    # at most MAX_POSITIVE ids are broadcast
    sample = open_docs.join(F.broadcast(chosen), "doc_id", "left").withColumn("u", unlabelled).where(F.col("u") | F.col("y").isNotNull())

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"p": b["p"], "u": b["u"], "feats": [sorted(features(t)) for t in b["text"]]})

    # a text counts once, however many copies of it were drawn
    once = sample.groupBy("text").agg(F.max(F.col("y").isNotNull()).alias("p"), F.max("u").alias("u"))
    sample = stored(once.select("p", "u", "text").mapInPandas(listed, "p boolean, u boolean, feats array<string>"), "toxic-sample")
    counts = sample.select("p", "u", F.explode("feats").alias("f")).groupBy("f").agg(
        F.count_if("p").alias("np"), F.count_if(~F.col("p")).alias("nu"))
    total = sample.agg(F.count_if("p"), F.count_if(~F.col("p"))).first()
    expected = F.col("nu") * (total[0] / max(1, total[1]))
    surplus = (F.col("np") - expected) / F.sqrt(expected + 1)
    found = stored(counts.where(F.col("np") >= MIN_POSITIVES).select("f", surplus.alias("z"), F.log((F.col("np") + 1) / (expected + 1)).alias("start")), "toxic-features")
    chance = (2 * np.log(max(2, found.count()))) ** 2  # the fourth power of the largest surplus by chance
    best = found.orderBy(F.col("z").desc(), "f").limit(MAX_FEATURES).collect()
    vocab = [r["f"] for r in best]
    z, start = (np.maximum(0, np.array([r[c] for r in best], dtype=float)) for c in ("z", "start"))
    relevance = z**4 / (z**4 + chance)
    place = docs.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(vocab)})

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"p": b["p"], "u": b["u"], "x": [
                np.array([place.value[f] for f in fs if f in place.value], dtype=np.int32).tobytes() for fs in b["feats"]]})

    got = sample.mapInPandas(indexed, "p boolean, u boolean, x binary").collect()
    place.destroy()
    x, y = [], []
    for r in sorted(got, key=lambda r: (r["p"], r["u"], r["x"])):  # a confirmed row of the unlabelled sample is in both
        for on, kind in ((r["p"], 1), (r["u"], 0)):
            if on:
                x.append(np.frombuffer(r["x"], dtype=np.int32).astype(np.int64))
                y.append(kind)
    weights, bias = nnpu(x, np.array(y), prior, len(vocab), relevance=relevance, start=start, decay=SHRINK)
    return {f: float(w) for f, w in zip(vocab, weights) if w}, bias, prior


def score(docs: DataFrame, model: tuple[dict[str, float], float, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (struct: the input row) and ``score`` of every row."""
    weights, bias, prior = model
    if not prior:
        return docs.select(F.struct("*").alias("row"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def logistic(texts: pd.Series) -> pd.Series:
        w = shared.value
        f = np.array([bias + sum([w[x] for x in features(t) & w.keys()]) for t in texts])
        return pd.Series(1 / (1 + np.exp(-np.clip(f, -40, 40))))

    return docs.select(F.struct("*").alias("row"), logistic(whole_text(text_col)).alias("score"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    return score(docs, fit(docs, labels)).where(F.col("score") < threshold).select("row.*")


def op4_toxicity(spark, sf_dir):
    """Every document's toxicity score; learnt outside the held-out quarter."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return scored.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
