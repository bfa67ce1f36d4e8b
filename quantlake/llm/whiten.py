"""Whitening of embeddings by incremental eigendecomposition (operator 13).

1. Entries become integers x = floor(64 c) + 1000000; the number n of vectors and the sums S of each dimension are exact.
2. Every partition keeps the spectrum (mean, eigenvalues, eigenvectors) of the scatter of its rows so far. A row moves it
   by a centred rank-one update: in the eigenbasis a diagonal plus rho z z'. Entries of z that are zero and poles that
   coincide are deflated; the other eigenvalues are the roots of the secular equation
   1 + rho sum z_i^2 / (d_i - t) = 0, one between each two poles; eigenvectors follow from the z that has
   exactly these roots, so they stay orthogonal. Equal rows of a batch are one update of that weight.
3. Spectra meet FAN_IN at a time, level by level: one takes in the other's eigenvectors and the difference of the means
   by successive rank-one updates.
4. Rayleigh-Ritz refinement: the final basis, made orthonormal, meets all rows once more; the small matrix of their
   exactly centred coordinates is summed over partitions and its eigenvectors turn the basis. This takes out the
   rounding of all updates, whatever their number.

Work: three passes over integer vectors stored once. What leaves a partition is d x d numbers, and the driver sees
one such matrix; nothing is broadcast but the basis.

Defined cases: null vectors, and those that hold null or non-finite entries or none at all, take no part; where
lengths differ, only vectors of the most frequent length (of ties the longer) do; null and repeated ids and repeated vectors
stay rows of their own; directions without variance (eigenvalue within rounding of 0) whiten to 0.0, explain 0.0 and don't
count for the identity error; a deviation beyond 64 bits is null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.llm.common import prepare, stored, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
FIT_ROWS = 4096      # rows of a partition that keeps a spectrum
FAN_IN = 16
EPS = np.finfo(float).eps


# ---- spectra (numpy) ----------------------------------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho sum z^2 / (d - t), for rising poles ``d``: the pole nearest each root, and its offset from it."""
    k = len(d)
    z2 = rho * z * z
    total = z2.sum()
    gap = np.append(np.diff(d), total)
    below = np.tri(k)  # poles up to a root's own
    delta = d[None, :] - d[:, None]
    half = gap / 2
    at_half = 1 + (z2 / (delta - half[:, None])).sum(1)
    right = (at_half < 0) & (np.arange(k) < k - 1)
    origin = np.arange(k) + right
    delta = d[None, :] - d[origin][:, None]
    lo, hi = np.where(right, -half, 0.0), np.where(right, 0.0, np.where(np.arange(k) < k - 1, half, gap))
    t = (lo + hi) / 2
    a = delta[np.arange(k), np.arange(k)]
    b = np.append(delta[np.arange(k - 1), np.arange(1, k)], np.inf)
    live = np.arange(k)
    for _ in range(80):
        inverse = 1 / (delta[live] - t[live, None])
        terms = z2 * inverse
        left, every = np.einsum("ij,ij->i", terms, below[live]), terms.sum(1)
        f, over = 1 + every, every - left  # terms of poles below a root are negative, those above positive
        lo[live], hi[live] = np.where(f < 0, t[live], lo[live]), np.where(f > 0, t[live], hi[live])
        open_ = (np.abs(f) > 32 * EPS * (1 + over - left)) & (hi[live] - lo[live] > 2 * EPS * np.abs(t[live]))
        if not open_.any():
            break
        if not open_.all():
            live, inverse, terms, left, over = live[open_], inverse[open_], terms[open_], left[open_], over[open_]
        slope = terms * inverse
        left_slope = np.einsum("ij,ij->i", slope, below[live])
        over_slope = slope.sum(1) - left_slope
        la, lb = a[live] - t[live], b[live] - t[live]
        s = left_slope * la * la
        last = ~np.isfinite(lb)
        lb1 = np.where(last, 1.0, lb)
        big_s = np.where(last, 0.0, over_slope * lb1 * lb1)
        c = 1 + left - left_slope * la + np.where(last, 0.0, over - over_slope * lb1)
        # c (la - u)(lb - u) + s (lb - u) + S (la - u) = 0 for the step u from t; the last root has one pole
        q1, q0 = c * (la + lb1) + s + big_s, c * la * lb1 + s * lb1 + big_s * la
        root = np.sqrt(np.maximum(q1 * q1 - 4 * c * q0, 0))
        w = q1 + np.copysign(root, q1)
        u1, u2 = 2 * q0 / w, w / (2 * c)
        u = np.where(last, la + s / c, np.where((u1 > la) & (u1 < lb), u1, u2))
        new = t[live] + u
        good = np.isfinite(new) & (new > lo[live]) & (new < hi[live])
        t[live] = np.where(good, new, (lo[live] + hi[live]) / 2)
    return origin, t


def rank_one(lam: np.ndarray, q: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of q diag(lam) q' + rho v v' (rho > 0)."""
    z = v @ q
    size = float(z @ z)
    if not rho * size > 0:
        return lam, q
    rho, z = rho * size, z / np.sqrt(size)
    order = np.argsort(lam, kind="stable")
    lam, z, q = lam[order], z[order], q[:, order]
    tol = 8 * EPS * max(float(np.abs(lam).max()), rho)
    starts = np.flatnonzero(np.append(True, np.diff(lam) > tol))
    if len(starts) < len(lam):  # coinciding poles: a reflection leaves one entry of z for all of them
        for i, j in zip(starts, np.append(starts[1:], len(lam))):
            norm = np.sqrt(z[i:j] @ z[i:j])
            if j - i > 1 and norm > 0:
                u = z[i:j].copy()
                u[-1] += np.copysign(norm, u[-1])
                u /= np.sqrt(u @ u)
                q[:, i:j] -= 2 * np.outer(q[:, i:j] @ u, u)
                z[i : j - 1], z[j - 1] = 0, -np.copysign(norm, z[j - 1])
    live = np.flatnonzero(rho * np.abs(z) > tol)
    if not len(live):
        return lam, q
    d, y = lam[live], z[live]
    with np.errstate(all="ignore"):
        origin, t = secular_roots(d, y, rho)
        away = (d[None, :] - d[origin][:, None]) - t[:, None]          # root j (row) from pole i (column): d_i - root_j
        poles = d[None, :] - d[:, None]
        np.fill_diagonal(poles, 1)
        exact = np.exp((np.log(np.abs(away)).sum(0) - np.log(np.abs(poles)).sum(0)) / 2) * np.sign(y)
        turn = (exact[None, :] / away).T
        turn /= np.sqrt((turn * turn).sum(0))
    if np.isfinite(turn).all():
        new = d[origin] + t
    else:  # a root that fell onto its pole in spite of deflation
        new, turn = np.linalg.eigh(np.diag(d) + rho * np.outer(y, y))
    out = lam.copy()
    out[live] = new
    q[:, live] = q[:, live] @ turn
    return out, q


@dataclass
class Spectrum:
    """Scatter about the mean of ``n`` rows: q diag(lam) q'."""

    n: float
    mean: np.ndarray
    lam: np.ndarray
    q: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0.0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, x: np.ndarray, weight: float = 1.0) -> None:
        off = x - self.mean
        if self.n:
            self.lam, self.q = rank_one(self.lam, self.q, self.n * weight / (self.n + weight), off)
        self.n += weight
        self.mean = self.mean + off * (weight / self.n)

    def join(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.lam, self.q = other.n, other.mean, other.lam, other.q
            return
        off = other.mean - self.mean
        for value, vector in zip(other.lam, other.q.T):
            if value > 0:
                self.lam, self.q = rank_one(self.lam, self.q, value, vector)
        self.lam, self.q = rank_one(self.lam, self.q, self.n * other.n / (self.n + other.n), off)
        self.mean = self.mean + off * (other.n / (self.n + other.n))
        self.n += other.n

    def row(self, at: int) -> dict:
        return {"at": at, "n": self.n, "m": np.concatenate([self.mean, self.lam, self.q.ravel()]).tobytes()}

    @classmethod
    def of(cls, n: float, m: bytes) -> Spectrum:
        a = np.frombuffer(m).copy()
        d = int(np.sqrt(len(a) + 1)) - 1
        return cls(n, a[:d], a[d : 2 * d], a[2 * d :].reshape(d, d))


# ---- Spark ------------------------------------------------------------------------------------------------------

PARTS = "at long, n double, m binary"


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x of every vector that takes part."""
    c = F.col(vector_col)
    whole = F.forall(c, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    rows = vectors.where(c.isNotNull() & (F.size(c) > 0) & whole)
    x = F.transform(c, lambda e: F.floor(e.cast("double") * SCALE) + SHIFT)
    rows = rows.select(F.col(id_col).alias("vec_id"), x.alias("x"))
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (size["d"] if size else 0))


def _together(parts: DataFrame, merge, name: str):
    """The one row that all ``parts`` (PARTS) become, FAN_IN at a time; None if there are none."""
    parts = stored(parts, name)
    top = parts.agg(F.max("at")).first()[0]
    while top:
        parts = stored(parts.groupBy(F.floor(F.col("at") / FAN_IN).alias("k")).applyInPandas(merge, PARTS), name)
        top //= FAN_IN
    return parts.first()


def _join_spectra(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("at")
    out = Spectrum.empty(0)
    for n, m in zip(g["n"], g["m"]):
        out.join(Spectrum.of(n, m))
    return pd.DataFrame([out.row(int(g["at"].iloc[0]) // FAN_IN)])


def _add_matrices(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("at")
    m = sum(np.frombuffer(b) for b in g["m"])
    return pd.DataFrame([{"at": int(g["at"].iloc[0]) // FAN_IN, "n": g["n"].sum(), "m": m.tobytes()}])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit integers where they hold it, else Python's."""
    bound = n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(map(abs, sums))
    if bound < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def fit(x: DataFrame) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """n, exact sums, eigenvalues (falling) and unit eigenvectors (columns) of the covariance of stored ``x``."""
    n = x.count()
    # one sum for each dimension
    total = x.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(total)]
    d = len(sums)
    origin = np.array([round(s / n) for s in sums], dtype=np.int64)

    def spectrum(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Spectrum.empty(d)
        for b in batches:
            if len(b):
                rows, times = np.unique(np.stack(b["x"].to_numpy()) - origin, axis=0, return_counts=True)
                for r, w in zip(rows, times):
                    own.add(r.astype(float), float(w))
        if own.n:
            yield pd.DataFrame([own.row(TaskContext.get().partitionId())])

    dealt = x.select("x").repartition(max(1, -(-n // FIT_ROWS)))
    got = _together(dealt.mapInPandas(spectrum, PARTS), _join_spectra, "spectra")
    basis, _ = np.linalg.qr(Spectrum.of(got["n"], got["m"]).q)

    def coordinates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros((d, d)), 0
        for b in batches:
            if len(b):
                y = (_centred(np.stack(b["x"].to_numpy()), n, sums) / n).astype(float) @ basis
                total += y.T @ y
                rows += len(b)
        if rows:
            yield pd.DataFrame([{"at": TaskContext.get().partitionId(), "n": float(rows), "m": total.tobytes()}])

    m = np.frombuffer(_together(x.select("x").mapInPandas(coordinates, PARTS), _add_matrices, "ritz")["m"]).reshape(d, d) / n
    e, turn = np.linalg.eigh((m + m.T) / 2)
    return n, sums, e[::-1].copy(), (basis @ turn)[:, ::-1].copy()


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    x = stored(integer_vectors(vectors, id_col, vector_col), "vectors")
    out = "vec_id long, deviation long, w array<double>"
    if x.isEmpty():
        return x.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    n, sums, e, basis = fit(x)
    d = len(e)
    k = min(components, d)
    flat = e <= d * EPS * max(float(e[0]), 0.0)
    scale = np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, e)))[:k]
    project = basis[:, :k] * scale

    def whitened(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        off = _centred(np.stack(b["x"].to_numpy()), n, sums)
        return off, (off / n).astype(float) @ project

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros((k + 1, k)), 0
        for b in batches:
            if len(b):
                w = whitened(b)[1]
                total[:k] += w.T @ w
                total[k] += w.sum(0)
                rows += len(b)
        if rows:
            yield pd.DataFrame([{"at": TaskContext.get().partitionId(), "n": float(rows), "m": total.tobytes()}])

    m = np.frombuffer(_together(x.select("x").mapInPandas(moments, PARTS), _add_matrices, "identity")["m"]).reshape(k + 1, k) / n
    apart = np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k))[~flat[:k]][:, ~flat[:k]]
    error = float(apart.max()) if apart.size else 0.0
    explained = [float(v) for v in np.where(flat, 0.0, e)[:k] / max(float(e.sum()), np.finfo(float).tiny)]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                off, w = whitened(b)
                if off.dtype != object and float(np.abs(off).max()) ** 2 * d < 2.0**62:
                    dev = (off * off).sum(1)
                else:
                    dev = [v if v < 1 << 63 else None for v in (off.astype(object) ** 2).sum(1)]
                yield pd.DataFrame({"vec_id": b["vec_id"].astype("Int64"), "deviation": pd.Series(dev, dtype="Int64"), "w": list(w)})

    got = x.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInPandas(rows, out)
    got = got.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return got.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.lit(explained), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_embedding_whitening(spark, sf_dir):
    """Every embedding on the first 32 whitened components."""
    prepare(spark)
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
