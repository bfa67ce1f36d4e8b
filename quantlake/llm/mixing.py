"""Soft-membership mixing to target weights (operator 5). DataFrame functions only.

1. A naive Bayes classifier over hashed words learns domains from a labelled table and gives every document a
   posterior over domains. Evidence is tempered (mean log-likelihood per word times at most EVIDENCE words), so
   memberships stay soft for long texts.
2. Rates r >= floor are fitted so that the expected tokens of each domain, T_k(r) = sum_d r_d n_d p_dk, match
   its share b_k of the token budget: projected-gradient least squares on |T(r) - b|^2, scaled by the inverse of
   M = sum_d n_d p_d p_d'. A step is r_d <- max(floor, r_d - p_d . M^-1 (T(r) - b)); it starts from r = 1 and ends
   at TOLERANCE. M sums the documents that are above the floor; after a step that didn't help, all of them.
3. ``copies`` rounds a rate up or down by the document's own hash, so that expected totals are kept.

Scale: texts are read once and kept as hashed words (one int each). Training counts are a map-side combined
aggregate of at most FEATURES x (targets + 1) numbers; that table is what is broadcast. Each gradient step is one
aggregate over (weight, posterior) rows that returns one number per domain. Rounds are expressions over the
stored posteriors; every STORE_EVERY of them the rates are written, so plans stay short. A round's moves are data, so
rounds add no compiled code to the driver and the executors.

Defined cases: null text is empty and has the prior as posterior and no tokens; rows equal in id and text share
a rate; a domain that no document belongs to is left out and the targets of the others rescaled; labelled
domains without a target, however many, are one domain OTHER, which by default keeps the share of tokens that it has (the
targets then divide the rest); of contradicting labels of one id the least domain counts; a label without language or
quality is none; without labels or tokens every rate is 1; extra columns pass. What a domain should and does reach is
returned with its rows, so a target that MAX_ROUNDS or the floor left unmet is seen.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quantlake.llm.common import row_key, stored, table, whole_text

FEATURES = 8192
MAX_DOMAINS = 64         # named in the targets, OTHER included
OTHER = "other"
SMOOTH = 0.5
EVIDENCE = 24
TOLERANCE = 1e-4
MAX_ROUNDS = 60
STORE_EVERY = 6
RIDGE = 1e-6

#: Target share of tokens by domain: language / quality label.
TARGETS = {
    "en/1": 0.42, "en/0": 0.08,
    "de/1": 0.15, "de/0": 0.025,
    "fr/1": 0.15, "fr/0": 0.025,
    "es/1": 0.13, "es/0": 0.02,
}


def hashed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rk, doc_id, words (array<int>): every row's words as feature numbers."""
    words = F.filter(F.split(F.lower(whole_text(text_col)), r"\s+"), lambda w: w != "")
    return docs.select(
        row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("doc_id"),
        F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(FEATURES))).alias("words"),
    )


def domain_model(words: DataFrame, labelled: DataFrame) -> tuple[list[str], DataFrame, list[float]]:
    """Domains, a table (f, l0, l1, ...) of log-likelihoods, and log priors, from ``labelled`` (doc_id, domain)."""
    labelled = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = words.join(labelled, "doc_id")
    counts = stored(known.select("domain", F.explode("words").alias("f")).groupBy("domain", "f").agg(F.count("*").alias("c")), "counts")
    totals = {r["domain"]: r["n"] for r in counts.groupBy("domain").agg(F.sum("c").alias("n")).collect()}
    names = sorted(totals)
    per = [F.sum(F.when(F.col("domain") == d, F.col("c")).otherwise(0)).alias(f"c{k}") for k, d in enumerate(names)]
    wide = words.sparkSession.range(FEATURES).select(F.col("id").cast("int").alias("f")).join(counts.groupBy("f").agg(*per), "f", "left") if names else None
    logs = [F.log((F.coalesce(F.col(f"c{k}"), F.lit(0)) + SMOOTH) / (totals[d] + SMOOTH * FEATURES)).alias(f"l{k}") for k, d in enumerate(names)]
    whole = sum(totals.values())
    return names, wide.select("f", *logs) if names else None, [float(np.log(totals[d] / whole)) for d in names]


def posteriors(words: DataFrame, model: tuple[list[str], DataFrame, list[float]]) -> DataFrame:
    """rk, rows, n (tokens of one row), p (array of posteriors): one row per distinct (id, text)."""
    names, logs, priors = model
    sizes = words.groupBy("rk").agg(F.count("*").alias("rows"), F.max(F.size("words")).cast("double").alias("n"))
    # FEATURES rows of at most MAX_DOMAINS doubles are broadcast; a repeated row doesn't change a mean
    means = words.select("rk", F.explode("words").alias("f")).join(F.broadcast(logs), "f").groupBy("rk").agg(
        *[F.avg(f"l{k}").alias(f"m{k}") for k in range(len(names))])
    both = sizes.join(means, "rk", "left")
    score = F.array(*[F.lit(pr) + F.least(F.col("n"), F.lit(float(EVIDENCE))) * F.coalesce(F.col(f"m{k}"), F.lit(0.0)) for k, pr in enumerate(priors)])
    both = both.withColumn("s", score).withColumn("top", F.array_max("s"))
    both = both.withColumn("e", F.transform("s", lambda x: F.exp(x - F.col("top"))))
    both = both.withColumn("z", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    return both.select("rk", "rows", "n", F.transform("e", lambda x: x / F.col("z")).alias("p"))


def fit_rates(members: DataFrame, shares: np.ndarray, budget: float | None = None, floor: float = 0.0) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``members`` (rk, rows, n, p) with ``rate``; the targets and the totals reached. A share that is nan is the one that
    the domain has at rate 1; the others then divide the rest.

    ``budget``: tokens in all; None: as many as there are; negative: the fewest at which no domain has to shrink.
    """
    dims = len(shares)
    weight, p = F.col("rows") * F.col("n"), [F.get("p", F.lit(k)) for k in range(dims)]

    def stepped(rows: DataFrame, moves: list[np.ndarray]) -> DataFrame:
        """``rows`` with ``rate``: r after the moves. They come as a row of data, filled up to STORE_EVERY with moves of
        nothing, not as constants of the expression: every round then runs the code that the first one compiled."""
        if not moves:
            return rows.withColumn("rate", F.col("r"))
        flat = np.concatenate([*moves, np.zeros((STORE_EVERY - len(moves)) * dims)]).tolist()
        names = [[f"move{k}_{i}" for i in range(dims)] for k in range(STORE_EVERY)]
        schema = StructType([StructField(n, DoubleType(), False) for one in names for n in one])
        rate = F.col("r")
        for one in names:
            dot = F.lit(0.0)
            for i in range(dims):
                dot = dot + p[i] * F.col(one[i])
            rate = F.greatest(F.lit(float(floor)), rate - dot)
        # one row is broadcast
        return rows.crossJoin(F.broadcast(rows.sparkSession.createDataFrame([flat], schema))).select(*rows.columns, rate.alias("rate"))

    def measured(rows: DataFrame, rate: Column, on: Column) -> tuple[np.ndarray, np.ndarray]:
        """Expected totals at ``rate``, and the Gram matrix of the rows that ``on`` marks."""
        rows = rows.select((weight * rate).alias("w"), F.when(on, weight).otherwise(0.0).alias("v"), "p")
        sums = rows.agg(
            *[F.coalesce(F.sum(F.col("w") * p[k]), F.lit(0.0)).alias(f"t{k}") for k in range(dims)],
            *[F.coalesce(F.sum(F.col("v") * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i in range(dims) for j in range(i, dims)]).first()
        gram = [[sums[f"m{min(i, j)}_{max(i, j)}"] for j in range(dims)] for i in range(dims)]
        return np.array([sums[f"t{k}"] for k in range(dims)]), np.array(gram)

    totals, whole = measured(members, F.lit(1.0), F.lit(True))
    tokens = float(totals.sum())
    kept = np.where(np.isnan(shares), totals / max(tokens, 1e-300), 0.0)
    shares = np.where((totals > 1e-9 * max(tokens, 1.0)) & ~np.isnan(shares), shares, 0.0)
    shares = kept + shares / max(shares.sum(), 1e-300) * (1 - kept.sum())
    if tokens <= 0 or shares.sum() <= 0:
        return members.withColumn("rate", F.lit(1.0)), totals, totals
    shares = shares / shares.sum()
    if budget is not None and budget < 0:
        budget = max(t / s for t, s in zip(totals, shares) if s > 0)
    goal = shares * (tokens if budget is None else budget)
    state, moves, gram, best = members.withColumn("r", F.lit(1.0)), [], whole, np.inf
    for _ in range(MAX_ROUNDS):
        off = np.abs(totals - goal).max()
        if off <= TOLERANCE * goal.sum():
            break
        metric = gram if off < best else whole
        best = min(best, off)
        moves.append(np.linalg.solve(metric + RIDGE * np.eye(dims) * max(np.trace(whole), 1e-12), totals - goal))
        if len(moves) == STORE_EVERY:
            state, moves = stored(stepped(state, moves).drop("r").withColumnRenamed("rate", "r"), "rates"), []
        totals, gram = measured(stepped(state, moves), F.col("rate"), F.col("rate") > floor)
    return stepped(state, moves).drop("r"), goal, totals


def mix(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None, floor: float = 0.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """rk, n_tokens, domain, membership, rate, copies, and the tokens that its domain should and does reach: one row per
    distinct (id, text) of ``docs``. ``targets`` may name OTHER; else its share stays as it is."""
    if len(targets.keys() | {OTHER}) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} targets")
    labelled = labelled.select("doc_id", F.when(F.col("domain").isin(list(targets)), F.col("domain")).when(F.col("domain").isNotNull(), F.lit(OTHER)).alias("domain"))
    words = stored(hashed_words(docs, id_col, text_col), "words")
    names, logs, priors = domain_model(words, labelled)
    if not names:
        return words.groupBy("rk").agg(F.max(F.size("words")).cast("long").alias("n_tokens")).select(
            "rk", "n_tokens", F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("membership"),
            F.lit(1.0).alias("rate"), F.lit(1).alias("copies"), F.lit(None).cast("double").alias("target_tokens"), F.lit(None).cast("double").alias("reached_tokens"))
    members = stored(posteriors(words, (names, logs, priors)), "members")
    rated, goal, reached = fit_rates(members, np.array([targets.get(d, np.nan) for d in names]), budget, floor)
    u = F.pmod(F.xxhash64("rk", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    best = F.array_max("p")
    at = (F.array_position("p", best) - 1).cast("int")
    of = lambda values: F.get(F.array(*[F.lit(v) for v in values]), at)
    return rated.select(
        "rk", F.col("n").cast("long").alias("n_tokens"), of(names).alias("domain"), best.alias("membership"), "rate",
        F.floor(F.col("rate") + u).cast("int").alias("copies"), of(map(float, goal)).alias("target_tokens"), of(map(float, reached)).alias("reached_tokens"))


def language_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table: (doc_id, domain) of labelled documents, domain = language / quality, null if either is."""
    return docs.select("doc_id", "lang").join(labels.select("doc_id", "quality"), "doc_id").select(
        "doc_id", F.concat("lang", F.lit("/"), F.col("quality").cast("string")).alias("domain"))


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, floor: float = 1.0) -> DataFrame:
    """``docs`` with each row as often as its rate says; by default none is left out, scarce domains repeat."""
    plan = mix(docs, labelled, targets, budget=-1.0, floor=floor).select("rk", "copies")
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("rk")).join(plan, "rk")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("k")).select("row.*") if floor >= 1 else rows.where(
        "copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("k")).select("row.*")


def op5_mixing(spark, sf_dir):
    """Every document's domain, rate and copies under TARGETS, for as many tokens as there are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    plan = mix(docs.select("doc_id", "text"), language_quality(docs, table(spark, sf_dir, "labels")), TARGETS)
    return docs.select("doc_id", row_key().alias("rk")).join(plan, "rk").drop("rk")
