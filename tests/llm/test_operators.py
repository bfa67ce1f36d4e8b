"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import collections
import random
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantlake.llm import jaccard, knn, linededup, merkle, mixing, packing, sharding, substring, toxicity, urlfilter
from quantlake.llm.common import prepare
from quantlake.llm.components import connected_components

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def small_batches(spark):
    prepare(spark)


def docs(spark, texts, first=0, extra=()):
    rows = [(i + first, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + list(extra)
    return spark.createDataFrame(rows, DOC).repartition(3)


def odd(spark):
    """Null and empty texts, a long one, repeated rows, null ids, ties."""
    line = "the same line here\nand one more of them\nand a third line of words\n"
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, line * 2, "en", "s", 1), (3, line * 2, "en", "s", 1), (4, line + "tail", "fr", "t", 2),
        (5, long, "en", "s", 3), (6, long + " end", "en", "s", 3), (None, "null id", "en", "s", 4), (None, line, "en", None, 4), (7, " \n\t\n ", "en", "s", 5),
        (8, "one", "en", "s", 3), (9, "one", "en", "s", 3),
    ]
    return spark.createDataFrame(rows, DOC).repartition(4)


CLASH = ("rk", "row", "bucket", "key", "h", "cls", "n", "rule", "words", "covered", "next", "id", "score", "component", "__rk")


def clashing(df):
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    return df


RUNS = {
    1: lambda d: packing.pack(d),
    2: lambda d: merkle.with_next(d),
    3: lambda d: sharding.shard(d),
    7: lambda d: jaccard.jaccard_components(d),
    9: lambda d: substring.dedup_substrings(d),
    10: lambda d: linededup.dedup_lines(d),
}


@pytest.mark.parametrize("op", RUNS)
def test_odd_rows_and_empty_table(spark, op):
    df = clashing(odd(spark))
    got = RUNS[op](df).collect()
    ids = [(r["row"]["doc_id"] if op == 10 else r["doc_id"]) for r in got if op != 1 or r["piece"] == 0]
    assert collections.Counter(ids) == collections.Counter(r["doc_id"] for r in odd(spark).collect())
    assert RUNS[op](df.limit(0)).count() == 0


def test_odd_rows_toxicity_and_mixing(spark):
    df, labels = clashing(odd(spark)), spark.createDataFrame([(3, 1), (4, 0), (None, 1), (99, 1), (8, None), (3, 0)], "doc_id long, toxic int")
    got = toxicity.clean_documents(df, labels)
    assert got.columns == df.columns and got.count() <= 12
    assert toxicity.clean_documents(df, labels.limit(0)).count() == 12
    assert toxicity.clean_documents(df.limit(0), labels).count() == 0
    labelled = spark.createDataFrame([(3, "a"), (4, "b"), (5, "a"), (None, "b"), (6, None)], "doc_id long, domain string")
    mixed = mixing.mixed_documents(df, labelled, {"a": 0.5, "b": 0.5})
    assert mixed.columns == df.columns and mixed.count() >= 12
    assert mixing.mixed_documents(df, labelled.limit(0), {"a": 1.0}).count() == 12
    assert mixing.mixed_documents(df.limit(0), labelled, {"a": 1.0}).count() == 0


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline as P

    df = odd(spark).withColumn("rk", F.lit(1))
    spark.createDataFrame([(3, 1, 0), (4, 0, 0), (8, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert 4 <= len(P.STAGES) <= 5
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns and out.count() >= 6, name
        out.write.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
        df = spark.read.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
    packed = P.STAGES[-1][1](spark, df, str(tmp_path))
    assert packed.where("piece = 0").count() == df.count()


def test_components_match_union_find(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (30, 20), (200, 150), (60, 300)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(None, 1), (2, 2)]
        edges += [(500 + i, 501 + i) for i in range(40)] + [(900, 901 + i) for i in range(40)]  # a path and a star
        parent = {}

        def find(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a is not None and a != b:
                a, b = sorted((find(a), find(b)))
                parent[b] = a
        got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for x in parent}


def test_merkle_equality_and_edits(spark):
    a = "\n".join(f"paragraph number {i} has some words of its own" for i in range(40))
    b = a.replace("number 7 ", "number seven ")
    df = merkle.add_tree(merkle.add_tree(spark.createDataFrame([(a, b), (a, a), ("", ""), ("", "x")], "a string, b string"), "a", "ta"), "b", "tb")
    got = df.select(F.col("ta.root") == F.col("tb.root"), merkle.likeness("ta", "tb"), merkle.differing("ta", "tb")).collect()
    assert [r[0] for r in got] == [False, True, True, False] and got[1][1] == 1.0 and 0.9 < got[0][1] < 1 and got[3][1] == 0
    assert got[0][2] == [7] and got[1][2] == []


def test_merkle_inserted_words_and_moved_paragraphs(spark):
    """A word in front of one long line; paragraphs put in, taken out and moved; equal paragraphs elsewhere don't hide an edit."""
    rng = random.Random(2)
    line = " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) for _ in range(400))
    paras = [f"paragraph {i} " + "".join(rng.choices("xyz", k=9)) for i in range(200)]
    put_in = paras[:50] + ["a new paragraph"] + paras[50:]
    cases = [(line, "Inserted " + line), (line, line.replace(" ", " more ", 1)), ("\n".join(put_in), "\n".join(paras)), ("\n".join(paras), "\n".join(put_in)),
             ("\n".join(paras[:120] + ["changed"] + paras[121:]), "\n".join(paras)), ("", "one"), (" \n ", "\n")]
    df = spark.createDataFrame(cases, "a string, b string")
    df = merkle.add_tree(merkle.add_tree(df, "a", "ta"), "b", "tb")
    got = df.select(merkle.likeness("ta", "tb").alias("near"), merkle.differing("ta", "tb").alias("places")).collect()
    assert got[0]["near"] > 0.95 and got[1]["near"] > 0.95
    assert [r["places"] for r in got] == [[0], [0], [50], [], [120], [0], [0, 1]]


def test_next_document_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BUCKET_ROWS", 3)
    ids = [5, 1, 900, 901, 902, 903, 10**12, 10**12 + 1, 7, 8, 9, 10, 11, 12, None]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next"]["text"] for r in merkle.with_next(df).collect()}
    order = sorted([i for i in ids if i is not None], reverse=True) + [None]
    assert got == {i: f"text {j}" for i, j in zip(order, order[1:] + order[:1])}


def test_shards_of_a_hot_text_are_even(spark):
    rng = random.Random(1)
    texts = ["hot text " * 20] * 400 + ["".join(rng.choices("abc ", k=rng.randrange(400))) for _ in range(800)]
    got = sharding.shard(docs(spark, texts)).collect()
    loads = collections.Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    mean = sum(loads.values()) / 8
    assert len(got) == 1200 and len(loads) == 8 and max(abs(x - mean) for x in loads.values()) < 0.05 * mean


@pytest.mark.parametrize("range_rows", [5000, 10])
def test_groups_of_equal_texts_stay_whole(spark, monkeypatch, range_rows):
    """1,000 groups of 20, each 0.8 % of a shard, however finely the work is cut."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), (F.col("id") % 1000).cast("string")).alias("text"))
    got = sharding.shard(df)
    spread = got.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).agg(F.max("n")).first()[0]
    loads = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert spread == 1 and max(loads) < 1.02 * min(loads) and got.count() == 20_000


def test_repeated_rows_are_drawn_as_few(spark, monkeypatch):
    """15,000 equal rows in 40,000: they reach the driver as a sample does, and no range holds them all."""
    seen, ranges = [], []
    draw, cut = sharding.draw, sharding.splitters_for
    monkeypatch.setattr(sharding, "draw", lambda *a: (seen.append(draw(*a)), seen[-1])[1])
    monkeypatch.setattr(sharding, "splitters_for", lambda *a: (ranges.append(cut(*a)), ranges[-1])[1])
    df = spark.range(25_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    df = df.unionByName(spark.range(15_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("again and again").alias("text"))).repartition(8)
    got = sharding.shard(df)
    loads = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    slots = got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b")).collect()
    assert got.count() == 40_000 and max(loads) - min(loads) < 200 and all((r["a"], r["b"]) == (0, r["n"] - 1) for r in slots)
    assert max(map(len, seen)) < 2000 and max(n for _, n in ranges[0][1].values()) < 40_000 / 4


def test_held_out_labels_are_not_read(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=40) + (["vile", "nasty"] if i % 6 == 0 else [])) for i in range(900)]
    df = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(900)], "doc_id long, toxic int")
    twisted = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(df, toxicity.fit(df, x)).select("row.doc_id", "score").collect() for x in (labels, twisted))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 6 == 0) for r in a)


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(6)
    p = rng.dirichlet([0.4, 0.4, 0.4], 500)
    members = spark.createDataFrame([(i, 1, float(rng.integers(1, 200)), [float(x) for x in q]) for i, q in enumerate(p)], "rk long, rows long, n double, p array<double>")
    for shares, floor, budget in (([0.2, 0.3, 0.5], 0.0, None), ([0.9, 0.05, 0.05], 0.0, None), ([0.3, 0.3, 0.4], 1.0, -1.0)):
        rated, goal, totals = mixing.fit_rates(members, np.array(shares), budget, floor)
        got = rated.collect()
        reached = sum(r["n"] * r["rate"] * np.array(r["p"]) for r in got)
        assert min(r["rate"] for r in got) >= floor and np.allclose(reached, totals)
        assert np.abs(reached - goal).max() < 2e-3 * goal.sum()


def test_rounds_run_code_that_is_compiled_once(spark):
    rng = np.random.default_rng(5)
    members = spark.createDataFrame(
        [(i, 1, float(20 + i % 40), p) for i, p in enumerate(rng.dirichlet([0.4] * 3, 60).tolist())], "rk long, rows long, n double, p array<double>")
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    made = []
    for shares in ([0.7, 0.2, 0.1], [0.1, 0.65, 0.25]):
        before = compiled.getCount()
        rated, goal, totals = mixing.fit_rates(members, np.array(shares))
        assert np.abs(goal - totals).max() <= 1e-4 * goal.sum() and {r["rate"] for r in rated.collect()} != {1.0}
        made.append(compiled.getCount() - before)
    assert made[1] == 0, made


def test_domains_are_learnt(spark):
    texts = [" ".join(random.Random(i).choices(["chat", "chien", "maison"] if i % 3 else ["dog", "cat", "house"], k=30)) for i in range(120)]
    labelled = spark.createDataFrame([(i, "fr" if i % 3 else "en") for i in range(60)], "doc_id long, domain string")
    df = docs(spark, texts)
    plan = mixing.mix(df, labelled, {"en": 0.5, "fr": 0.5})
    got = df.select("doc_id", mixing.row_key().alias("rk")).join(plan, "rk").collect()
    assert all(r["domain"] == ("fr" if r["doc_id"] % 3 else "en") and r["membership"] > 0.9 for r in got)
    assert sum(r["rate"] * r["n_tokens"] for r in got if r["domain"] == "en") == pytest.approx(1800, rel=0.02)


def test_domains_without_target_keep_their_share(spark):
    """70 languages of which two have targets; contradicting, incomplete and null labels."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"l{i % 70}w{k}" for k in range(6)], k=20 + i % 30)) for i in range(700)]
    df = docs(spark, texts).select("doc_id", "text", F.concat(F.lit("l"), (F.col("doc_id") % 70).cast("string")).alias("lang"))
    labels = spark.createDataFrame([(i, 1) for i in range(0, 700)] + [(3, 0), (4, None), (None, 1), (9999, 1)], "doc_id long, quality int")
    plan = mixing.mix(df, mixing.language_quality(df, labels), {"l0/1": 0.8, "l1/1": 0.2}, 20000.0)
    got = df.select("doc_id", mixing.row_key().alias("rk")).join(plan, "rk").collect()
    assert {r["domain"] for r in got} == {"l0/1", "l1/1", mixing.OTHER}
    tokens = {d: sum(r["n_tokens"] * r["rate"] for r in got if r["domain"] == d) for d in ("l0/1", "l1/1", mixing.OTHER)}
    share = sum(r["n_tokens"] for r in got if r["domain"] == mixing.OTHER) / sum(r["n_tokens"] for r in got)
    want = {"l0/1": 0.8 * (1 - share), "l1/1": 0.2 * (1 - share), mixing.OTHER: share}
    assert all(tokens[d] == pytest.approx(20000 * want[d], rel=0.05) for d in want)
    for r in got:
        assert r["target_tokens"] == pytest.approx(20000 * want[r["domain"]], rel=0.02) and abs(r["reached_tokens"] - r["target_tokens"]) <= 2e-4 * 20000
    with pytest.raises(ValueError):
        mixing.mix(df, mixing.language_quality(df, labels), {f"x{i}": 1.0 for i in range(64)})


def test_mixing_query_on_a_whole_table(spark):
    """Posteriors, targets and copies of the query against numpy over the same hashed words."""
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in mixing.op5_mixing(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    words = {r["doc_id"]: (r["rk"], r["words"]) for r in mixing.hashed_words(rows).collect()}
    known = {r["doc_id"]: r["domain"] for r in mixing.language_quality(rows, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r["domain"]}
    names = sorted({d for i, d in known.items() if words[i][1]})
    counts = {d: np.zeros(mixing.FEATURES) for d in names}
    for i, d in known.items():
        np.add.at(counts[d], words[i][1], 1)
    logs = np.array([np.log((counts[d] + mixing.SMOOTH) / (counts[d].sum() + mixing.SMOOTH * mixing.FEATURES)) for d in names])
    prior = np.log([counts[d].sum() / sum(c.sum() for c in counts.values()) for d in names])
    assert set(got) == set(words)
    totals = np.zeros(len(names))
    for i, (_, w) in words.items():
        s = prior + (min(len(w), mixing.EVIDENCE) * logs[:, w].mean(1) if w else 0)
        p = np.exp(s - s.max())
        p /= p.sum()
        assert got[i]["n_tokens"] == len(w) and got[i]["membership"] == pytest.approx(p.max(), rel=1e-6) and got[i]["domain"] == names[int(p.argmax())]
        assert got[i]["rate"] >= 0 and 0 <= got[i]["copies"] - np.floor(got[i]["rate"]) <= 1
        totals += len(w) * got[i]["rate"] * p
    shares = np.array([mixing.TARGETS[d] for d in names])
    goal = shares / shares.sum() * sum(len(w) for _, w in words.values())
    assert np.abs(totals - goal).max() <= 2 * mixing.TOLERANCE * goal.sum()


def test_redirects_carry_blocks(spark):
    link = lambda u: f'<head><LINK href="{u}" rel=canonical></head>'
    pages = [
        (1, "http://example.org/es/x", ""), (2, "http://a.net/1", link("https://example.org/es/x#frag")), (3, "http://b.net/2", '<meta http-equiv="Refresh" content="0; url=http://a.net/1">'),
        (4, "http://c.net/3", link("http://example.org/es/y")), (5, "http://example.org/es/y", ""), (6, "http://shop.com/fr/", link("http://example.org/es/y")), (7, None, None),
        (8, "no scheme", link("/x")), (9, "HTTP://WWW.Example.ORG/en/12?q", None), (10, "http://x.com/de/1", ""), (11, "http://net", ""), (2, "http://a.net/1", ""), (12, "http://notexample.org/es/", ""),
        (13, "http://x.com?to=http://y.com/de/1", ""), (14, "ftp://example.org#://x/es/", ""),
    ]
    df = clashing(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = collections.defaultdict(set)
    for r in urlfilter.judge(df, urlfilter.RULES).collect():
        got[r["page_id"]].add((r["host"], r["path"], r["rule"], r["verdict"]))
    assert got[1] == {("example.org", "/es/x", "example.org/es/", "block")} and got[2] == {("a.net", "/1", None, "block")}
    assert got[3] == {("b.net", "/2", None, "block")} and got[4] == {("c.net", "/3", None, "allow")}  # page 6 is allowed explicitly
    assert got[5] == {("example.org", "/es/y", "example.org/es/", "block")} and got[6] == {("shop.com", "/fr/", "com/fr/", "allow")}
    assert got[7] == {("", "", None, "allow")} and got[9] == {("www.example.org", "/en/12", "example.org/en/1", "block")}
    assert got[10] == {("x.com", "/de/1", "com/de/", "block")} and got[11] == {("net", "", None, "allow")}
    assert got[13] == {("x.com", "", None, "allow")} and got[14] == {("example.org", "", None, "allow")}
    assert got[12] == {("notexample.org", "/es/", "org/", "allow")}
    assert urlfilter.judge(df.limit(0), urlfilter.RULES).count() == 0


def test_link_targets_that_are_no_rows(spark):
    link = lambda u: f'<link rel="canonical" href="{u}">'
    pages = [
        (1, "http://a.net/1", link("http://example.org/es/x")), (2, "http://b.net/2", link("http://b.net/3")),
        (3, "http://b.net/4", link("http://b.net/3") + link("http://example.org/es/y")),
        (4, "http://c.net/1", link("http://example.org/es/z") + link("http://shop.com/fr/1")),  # an allowed target wins
        (5, "http://d.net/p/q?x=1", link("../r.html")), (6, "http://d.net/r.html", link("http://example.org/es/r")),
        (7, "http://e.net/login", link("/login?to=http://example.org/es/x")), (8, "http://f.net/a", link("?x=1&amp;y=2")),
        (9, "http://f.net/a?x=1&y=2", link("http://example&#46;org/es/w")), (10, "http://g.net", link("mailto:x@example.org/es/")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(df, urlfilter.RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "block", 7: "allow", 8: "block", 9: "block", 10: "allow"}


def test_link_targets_are_resolved(spark):
    cases = [  # as urllib.parse.urljoin, host and path
        ("http://h.org/b/c/d?q", t) for t in ("g", "./g", "g/", "/g", "//x.net/y", "?y", "g?y", "#s", "g#s", "../g", "../../g", "../../../g", ".", "..", "./", "../", "g?y/../x", "http://z.org/k?a#b")
    ] + [("http://h.org", "x.html"), ("http://h.org?q", "x.html"), ("http://h.org/a", "/b/../c")]
    df = spark.createDataFrame(cases, "url string, target string")
    got = {(r["url"], r["target"]): r["a"] for r in df.select("url", "target", urlfilter.address(urlfilter.resolved(F.col("target"), F.col("url"))).alias("a")).collect()}
    for u, t in cases:
        assert got[u, t] == urljoin(u, t).split("://", 1)[1].split("#")[0], (u, t)


def near_copies(rng, n):
    out = []
    for _ in range(n):
        base = rng.choice(out).split() if out and rng.random() < 0.6 else rng.choices([f"v{i}" for i in range(400)], k=rng.randrange(3, 90))
        for _ in range(rng.randrange(0, 4)):
            if base:
                base[rng.randrange(len(base))] = f"v{rng.randrange(400)}"
        out.append(" ".join(base))
    return out


def test_blocks_of_a_list_are_skipped_by_position(monkeypatch):
    """Pairs of one list equal those of all pairs; blocks whose sets have too little left are not looked at."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = np.random.default_rng(5)
    m = 400
    n = rng.integers(40, 60, m)
    pos = rng.integers(0, 25, m)
    bits = np.zeros((m, jaccard.PARITY // 64), np.uint64)
    ids = np.arange(m)
    looked = []
    may = jaccard.may_link
    monkeypatch.setattr(jaccard, "may_link", lambda *a: (looked.append(len(a[0])), may(*a))[1])
    got = {tuple(sorted(p)) for x, y in jaccard.listed_pairs(ids, n, pos, ids, bits, 85) for p in zip(x.tolist(), y.tolist())}
    i, j = np.triu_indices(m, 1)
    ok = (np.minimum(n[i], n[j]) * 100 >= 85 * np.maximum(n[i], n[j])) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= jaccard.min_overlap(n[i], n[j], 85))
    assert got >= set(zip(i[ok].tolist(), j[ok].tolist())) and sum(looked) < 0.5 * len(i)


@pytest.mark.parametrize("rows", [8192, 4])
def test_jaccard_components_match_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(jaccard, "LIST_ROWS", rows)
    texts = near_copies(random.Random(8), 220) + ["", None, "a b", "A B", "x"]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                a, b = sorted((comp[i], comp[j]))
                comp = [a if c == b else c for c in comp]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs(spark, texts), size=3, percent=80).collect()}
    assert got == {i: (len(s), comp[i]) for i, s in enumerate(sets)}
    links = {i: sum(100 * len(s & t) >= 80 * len(s | t) for j, t in enumerate(sets) if i != j and s) for i, s in enumerate(sets)}
    counted = {r["doc_id"]: r["n_links"] for r in jaccard.link_counts(docs(spark, texts), size=3, percent=80).collect()}
    assert counted == links and max(links.values()) > 3
    if rows == 4:
        kept = jaccard.first_of_groups(docs(spark, texts), size=3, percent=80).collect()
        assert sorted(r["doc_id"] for r in kept) == sorted(set(comp))


def test_tables_sent_to_tasks_are_freed(spark, monkeypatch):
    prepare(spark)
    sent, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: sent.append(send(x)) or sent[-1])
    words = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(i, words + " " + str(i % 3)) for i in range(9)], "doc_id long, text string")
    rows, edges = jaccard.joined_classes(df, "doc_id", "text", 4, 50, True, every=False)
    assert len(sent) == 2 and not any(b._jbroadcast.isValid() for b in sent)
    assert rows.count() == 9 and edges.count() > 0


def test_tables_pass_the_driver_compressed(spark, monkeypatch):
    """Levels of hashes and member bits, against counting; of 16 MB each, no more than 1 MB comes in or goes out."""
    import pickle

    from pyspark.sql.classic.dataframe import DataFrame

    from quantlake.llm import counts

    came, went, collect = [], [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: came.append(collect(self)) or came[-1])
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x, send=spark.sparkContext.broadcast: went.append(len(pickle.dumps(x, 5))) or send(x))
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    h = np.concatenate([h, h[:500], np.repeat(h[:9], 40)])
    df = spark.createDataFrame([(" ".join(map(str, x)),) for x in h.reshape(-1, 2).tolist()], "text string").repartition(3)
    hashes = lambda texts: np.array([x for t in texts for x in t.split()], np.uint64)
    levels = counts.count_levels(df, hashes, 24, 5)
    want = np.zeros(1 << 24, np.uint8)
    for x, n in collections.Counter(h.tolist()).items():
        want[x >> 40] = max(want[x >> 40], int(np.log2(n)))
    assert (levels == want).all()
    keys = h.view(np.int64)
    bits = counts.member_filter(spark.createDataFrame([(x,) for x in keys.tolist()], "k long").repartition(3), "k")
    assert len(bits) == 1 << 24 and counts.may_be_members(bits, keys).all() and np.bitwise_count(bits).sum() == len(set((h >> np.uint64(37)).tolist()))
    assert sum(len(v) for rows in came for r in rows for v in r if isinstance(v, (bytes, bytearray))) < 1 << 20
    for table in (levels, bits):
        b = counts.sent(spark, table)
        got = spark.sparkContext.parallelize([0], 1).map(lambda _: (type(b.value).__name__, len(b.value), int(b.value.sum()))).first()
        assert got == ("ndarray", 1 << 24, int(table.sum()))
    assert len(went) >= 2 and max(went) < 1 << 20


def test_knn_sends_queries_only_where_they_can_win(spark, monkeypatch):
    """Four far clusters in eight groups: a query goes to those around its own."""
    rng = np.random.default_rng(3)
    centres = np.eye(4) * 40
    rows = [(i, [float(x) for x in centres[i % 4] + rng.normal(size=4) * 0.1]) for i in range(2000)]
    met = []
    stored = knn.stored
    monkeypatch.setattr(knn, "stored", lambda df, name: (met.append(df) if name == "queries" else None, stored(df, name))[1])
    got = knn.knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), cells=16, groups=8, block_rows=200).collect()
    assert max(len(r["grps"]) for r in met[0].collect()) <= 4 and {(r["query_id"] - r["vec_id"]) % 4 for r in got} == {0}
    ints = {i: [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v] for i, v in rows}
    for q in range(0, 2000, 500):
        want = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, -s) for s, i in want]


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(1000 + i, [0.25, -0.5, 1.0, 0.0, 0.125, 2.0]) for i in range(150)]  # one vector many times
    rows += [(2000, None), (2050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6), (0, rows[0][1]), (2200, [1.0])]
    got = knn.knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=50, cells=7, groups=3, block_rows=100).collect()
    good = {i: [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v] for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(want)
    few = spark.createDataFrame(rows[:2] + [(50, [1.0] * 6)], "vec_id long, embedding array<float>")
    assert knn.knn_join(few).count() == 4 and knn.knn_join(few.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [12, 1])
def test_substrings_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_LEVEL", hot)
    rng = random.Random(10)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randrange(5, 60))) for _ in range(12)]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(0, 4)) + rng.choices("abcdefghij", k=rng.randrange(30))) for _ in range(60)] + ["a " * 70, None]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        w, gone = (t or "").split(), set()
        for k in range(len(w) - 19):
            g = tuple(w[k : k + 20])
            if g in seen:
                gone |= set(range(k, k + 20))
            seen.add(g)
        want[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.dedup_substrings(docs(spark, texts)).collect()}
    assert got == want


def test_lines_match_brute_force(spark):
    rng = random.Random(11)
    pool = [f"line {i}" for i in range(9)] + ["", " "]
    texts = ["\n".join(rng.choices(pool, k=rng.randrange(0, 14))) for _ in range(80)] + [None, "\n\n\n\n"]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        ls, gone = (t or "").split("\n"), set()
        for k in range(len(ls) - 2):
            g = tuple(ls[k : k + 3])
            if any(x.strip() for x in g):
                if g in seen:
                    gone |= {k, k + 1, k + 2}
                seen.add(g)
        want[i] = (len(gone), None if t is None else "\n".join(x for k, x in enumerate(ls) if k not in gone))
    got = {r["row"]["doc_id"]: (r["n_removed"], r["kept"]) for r in linededup.dedup_lines(docs(spark, texts)).collect()}
    assert got == want
