"""Operators 11 to 13: brute force, odd tables, numeric properties."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantlake.llm import gam, manifest, whiten
from quantlake.llm.common import prepare
from quantlake.llm.queries import QUERIES

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def small_batches(spark):
    prepare(spark)


# ---- operator 11 --------------------------------------------------------------------------------------------


def test_compressed_bitmaps_rank():
    rng = np.random.default_rng(1)
    top = 1 << manifest.LOW_BITS
    sets = [np.array([5]), np.arange(top), np.arange(100, 4000), np.unique(rng.integers(0, top, 40)), np.unique(rng.integers(0, top, 6000)),
            np.concatenate([np.arange(10), np.arange(50, 90), np.arange(8000, top)]), np.arange(0, top, 2)]
    kinds = set()
    for s in sets:
        payload = manifest.compress(s)
        kinds.add(payload[:1])
        assert (manifest.members(payload) == s).all() and len(payload) <= 1 + top // 8 + 2 * top // 512
        q = np.arange(top)
        assert (manifest.rank(payload, q) == np.searchsorted(s, q)).all()
    assert kinds == {b"a", b"r", b"b"}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_forest(leaves):
    """leaves: (source, doc_id, leaf) -> per leaf (in order) its subroot and proof, and the root."""
    def climb(level):
        paths, groups = [[] for _ in level], [[i] for i in range(len(level))]
        while len(level) > 1:
            for i in range(0, len(level), 3):
                run = level[i : i + 3]
                for k in range(len(run)):
                    for leaf in groups[i + k]:
                        paths[leaf] += ["".join(run[:k]), "".join(run[k + 1 :])]
            groups = [sum(groups[i : i + 3], []) for i in range(0, len(level), 3)]
            level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
        return level[0], paths

    by = collections.defaultdict(list)
    for s, i, leaf in leaves:
        by[s].append((i is not None, i, leaf))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    sub = {s: climb([x[2] for x in sorted(by[s], key=lambda x: (x[0], x[1] or 0, x[2]))]) for s in order}
    root, tops = climb([sub[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, i, leaf), path in zip(sorted(by[s], key=lambda x: (x[0], x[1] or 0, x[2])), sub[s][1]):
            out.append((s, i, leaf, sub[s][0], path + top))
    return root, out


@pytest.mark.parametrize("level, group_ids", [(7, 40000), (1, 3), (2, 50)])
def test_manifest_matches_brute_force(spark, monkeypatch, level, group_ids):
    monkeypatch.setattr(manifest, "LEVELS", level)
    monkeypatch.setattr(manifest, "BLOCK", 3**level)
    monkeypatch.setattr(manifest, "GROUP_IDS", group_ids)
    rng = random.Random(5)
    rows = [(i * rng.choice([1, 1, 70000]) - 40, rng.choice(["a", "b", "é", "", None, "hot", "hot", "hot"]), h(str(i))) for i in range(160)]
    rows += [(7, "hot", h("same"))] * 9 + [(7, "hot", h("other")), (None, "b", h("x")), (None, "b", h("y")), (None, None, h("z")), (2**62, "a", h("far")), (-(2**62), "a", h("low"))]
    df = spark.createDataFrame(rows, "doc_id long, s string, leaf string").repartition(4)
    leaves = df.select(manifest.tree_key(F.col("s")).alias("tree"), "doc_id", "leaf", F.lit(None).cast("string").alias("note"))
    got = manifest.manifest(leaves).withColumn("up", manifest.fold(F.col("leaf"), F.col("proof"))).collect()
    root, want = brute_forest([(s, i, leaf) for i, s, leaf in rows])
    assert {r["root"] for r in got} == {root} == {r["up"] for r in got}
    key = lambda s: "-" if s is None else "s" + s
    assert sorted((r["tree"], str(r["doc_id"]), r["leaf"], r["subroot"], r["proof"]) for r in got) == sorted((key(s), str(i), leaf, sub, path) for s, i, leaf, sub, path in want)


def test_manifest_hashes_odd_rows(spark, tmp_path):
    rows = [(1, "a\nb", "en", "s", 3), (2, None, None, None, None), (3, "", "en", "", 0), (None, "n\nn", "en", "s", 3), (5, "ü\n" * 40000, "de", "s", 1), (1, "a\nb", "en", "s", 3)]
    df = spark.createDataFrame(rows, DOC).withColumn("tree", F.lit("x")).withColumn("leaf", F.lit(0)).withColumn("n", F.lit(1))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [r.asDict() for r in manifest.op11_merkle_manifest(spark, str(tmp_path)).collect()]
    piece = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, la, s, n: h(*map(piece, (i, s, la, n, t)))
    assert sorted(r["leaf"] for r in got) == sorted(leaf(*r) for r in rows)
    assert len({r["root"] for r in got}) == 1
    text = {(r[0], leaf(*r)): r for r in rows}
    for r in got:
        i, t, *_ = text[r["doc_id"], r["leaf"]]
        changed = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and "\n" in (t or "")
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert manifest.op11_merkle_manifest(spark, f"{tmp_path}/empty").count() == 0


# ---- operator 12 --------------------------------------------------------------------------------------------


def test_line_tree_is_the_best_of_all():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 9):
        g, c = rng.normal(size=n), rng.uniform(3, 9, size=n)
        value = lambda cuts: sum(g[a:b].sum() ** 2 / (c[a:b].sum() + gam.RIDGE) for a, b in zip([0, *cuts], [*cuts, n]))  # noqa: B023, E731
        ways = [[i] for i in range(1, n)] + [[i, j] for i in range(1, n) for j in range(i + 1, n)]
        got = gam.line_tree(g, c)
        if not ways or max(map(value, ways)) <= value([]):
            assert got is None
            continue
        best = max(ways, key=value)
        want = np.concatenate([np.full(b - a, g[a:b].sum() / (c[a:b].sum() + gam.RIDGE)) for a, b in zip([0, *best], [*best, n])])
        assert np.allclose(got, want)


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(1500, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    edges = [np.quantile(x[:, i], np.linspace(0, 1, gam.BINS + 1)[1:-1]) for i in range(3)]
    model = gam.boost(x, y, edges)
    assert ((model.probability(x) >= 0.5) == (y == 1)).mean() > 0.93
    assert (2, 0) in [(i, j) for i, j, _ in model.pairs]
    b = model.bins(x)  # the score is a sum of lookups
    whole = model.bias + sum(t[b[:, i]] for i, t in enumerate(model.tables)) + sum(t[model.cells(b, i), model.cells(b, j)] for i, j, t in model.pairs)
    assert np.allclose(whole, model.logit(x))


def test_measures_of_odd_and_long_texts():
    for t in ("", " \n\t", "\0", "a", "\ud800", "😀" * 3, "| | |", "x" * (3 * gam.PIECE)):
        m = gam.measures(t)
        assert len(m) == len(gam.FEATURES) and np.isfinite(m).all()
    base = "Some words of a line.\n" * 100
    short, long = gam.measures(base), gam.measures(base * 500)
    rates = [i for i, f in enumerate(gam.FEATURES) if f in ("letters", "capitals", "marks", "symbols", "word_repeats", "line_ends")]
    assert np.allclose(np.array(short)[rates], np.array(long)[rates], atol=2e-3)


def quality_docs(spark, n=600):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(40)]
        rows.append((i, " | ".join(words) if i % 5 == 1 else " ".join(words) + "."))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(i, int(i % 5 != 1)) for i in range(n)], "doc_id long, quality int")


def test_quality_is_learnt_without_held_out_labels(spark):
    docs, labels = quality_docs(spark)
    measured = gam.measure(docs)
    twisted = labels.withColumn("quality", F.when(gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, gam.score(measured, gam.fit(measured, x)).select("doc_id", "score").collect())) for x in (labels, twisted))
    assert a == b and all((s >= gam.THRESHOLD) == (i % 5 != 1) for i, s in a)
    kept = gam.good_documents(docs.withColumn("score", F.lit("x")).withColumn("measures", F.lit(1)), labels)
    assert kept.columns == ["doc_id", "text", "score", "measures"] and {r["doc_id"] % 5 for r in kept.collect()} == {0, 2, 3, 4}


def test_quality_odd_tables(spark):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "x | y"), (3, "x | y"), (4, "word " * 90000), (5, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (4, None), (None, 1), (99, 0)], "doc_id long, quality int")
    measured = gam.measure(docs)
    got = gam.score(measured, gam.fit(measured, labels)).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in gam.score(measured, gam.fit(measured, labels.limit(0))).collect()} == {0.5}
    only = gam.score(measured, gam.fit(measured, labels.where("quality = 1"))).collect()
    assert len({r["score"] for r in only}) == 1
    assert gam.good_documents(docs.limit(0), labels).count() == 0


def test_quality_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op12_quality_classifier"](spark, sf).collect()}
    assert len(got) == 1000 and all((r["score"] >= 0.3) == (r["predicted"] == 1) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    labels = [(r["quality"], got[r["doc_id"]]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in got]
    bad, good = ([r["predicted"] for y, r in labels if r["held_out"] and y == k] for k in (0, 1))
    assert sum(bad) <= 0.2 * len(bad) and sum(good) >= 0.97 * len(good)


# ---- operator 13 --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("d, n", [(1, 5), (2, 40), (7, 3), (16, 200), (33, 80)])
def test_rank_one_updates_give_the_spectrum(d, n):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(n, d)) * rng.choice([0.0, 1.0, 1000.0], size=d)
    x[n // 2 :] = np.where(rng.random((n - n // 2, 1)) < 0.4, x[0], x[n // 2 :])
    parts = [whiten.Spectrum.empty(d) for _ in range(3)]
    for i, row in enumerate(x):
        parts[i % 3].add(row, 2.0)
    one = parts[0]
    for p in parts[1:]:
        one.join(whiten.Spectrum.of(p.n, p.row(0)["m"]))
    c = 2 * (x - x.mean(0)).T @ (x - x.mean(0))
    size = max(1e-300, np.abs(c).max())
    assert one.n == 2 * n and np.allclose(one.mean, x.mean(0))
    assert np.abs(one.q * one.lam @ one.q.T - c).max() < 1e-10 * size and np.abs(one.q.T @ one.q - np.eye(d)).max() < 1e-10


def test_secular_roots_lie_between_poles():
    rng = np.random.default_rng(6)
    for k in (1, 2, 12):
        d = np.sort(rng.uniform(0, 100, k)) + np.arange(k)
        z, rho = rng.normal(size=k), 3.7
        origin, t = whiten.secular_roots(d, z, rho)
        assert np.allclose(d[origin] + t, np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z)), rtol=1e-12)


def check_whitening(rows, got, components=32):
    good = [(i, [int(np.floor(np.float64(np.float32(x)) * 64)) + 1000000 for x in v]) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    d = collections.Counter(len(v) for _, v in good).most_common(1)[0][0]
    good = [(i, v) for i, v in good if len(v) == d]
    n, sums = len(good), [sum(v[k] for _, v in good) for k in range(d)]
    centred = np.array([[(n * v[k] - sums[k]) / n for k in range(d)] for _, v in good])
    e = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    k = min(components, d)
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    exact = sorted((str(i), sum((n * v[q] - sums[q]) ** 2 for q in range(d))) for i, v in good)
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1) == exact
    by = collections.defaultdict(dict)
    for r in got:
        by[r["component"]].setdefault(r["vec_id"], []).append(r["whitened"])
        assert r["identity_error"] <= 1e-4 and abs(r["explained"] - e[r["component"] - 1] / e.sum()) <= 1e-9
    ids = sorted(by[1], key=str)
    w = np.array([[x for i in ids for x in sorted(by[c][i])] for c in sorted(by)])
    flat = e[:k] <= 1e-9 * e[0]
    assert np.allclose((w * w).mean(1), np.where(flat, 0, 1)) and np.abs(w.mean(1)).max() < 1e-8


def test_whitening_matches_numpy(spark, monkeypatch):
    monkeypatch.setattr(whiten, "FIT_ROWS", 30)
    monkeypatch.setattr(whiten, "FAN_IN", 3)
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=6) * [1, 2, 3, 4, 5, 0]]) for i in range(300)]
    rows += [(1000 + i, [0.25, -0.5, 1.0, 0.0, 0.125, 0.0]) for i in range(150)]
    rows += [(2000, None), (2050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6), (0, rows[1][1]), (2200, [1.0]), (None, rows[2][1]), (2300, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("n", F.lit("n")).repartition(5)
    got = whiten.whiten(df).collect()
    check_whitening(rows, got)
    wide = sorted((r["vec_id"], r["whitened"]) for r in got if r["component"] == 1 and r["vec_id"] is not None)
    again = sorted((r["vec_id"], r["whitened"]) for r in whiten.whiten(df.repartition(9)).collect() if r["component"] == 1 and r["vec_id"] is not None)
    sign = np.sign(wide[5][1] * again[5][1])
    assert all(a[0] == b[0] and abs(a[1] - sign * b[1]) < 1e-9 for a, b in zip(wide, again))


def test_whitening_small_and_large_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whiten.whiten(make([])).count() == 0 and whiten.whiten(make([(1, None), (2, [])])).count() == 0
    one = whiten.whiten(make([(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    far = [(i, [float(2.0**50) * (i % 2), 1.0 * i]) for i in range(4)]
    got = whiten.whiten(make(far)).collect()
    assert len(got) == 8 and {r["deviation"] for r in got} == {None}
    check = [(i, [1.0 * i, 2.0 * (i % 3), -1.0]) for i in range(50)]
    check_whitening(check, whiten.whiten(make(check)).collect())


def test_whitening_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(rows, QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001").collect())
