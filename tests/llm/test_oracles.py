"""The registered queries against their DuckDB twins, and SQL-less ones against brute force, on whole tables."""

import os
import sys
import zlib

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import duck, rows_key  # noqa: E402

import __spark_entry__ as ep  # noqa: E402
from quantlake.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(ep.queries())
    assert set(ORACLE_SQL) <= set(ep.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.sql(ORACLE_SQL[name])
    want = res.fetchall()
    assert sorted(cols) == sorted(res.columns) and len(rows) == len(want)
    assert rows_key(cols, rows) == rows_key(res.columns, want)


def test_packing_whole_table(spark, con):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(con.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    got = [r.asDict() for r in QUERIES["op1_best_fit_packing"](spark, SF).collect()]
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for doc_id, text in texts.items():
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        total += len(ids)
        pieces, at = sorted(by_doc[doc_id], key=lambda r: r["piece"]), 0
        for k, r in enumerate(pieces):
            assert r["piece"] == k and r["start"] == at
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert k == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids) and (len(pieces) == 1 or len(ids) > 2048)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_seq) <= -(-total // 2048) * 1.02 + 1


def test_sharding_whole_table(spark, con):
    texts = dict(con.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    got = [r.asDict() for r in QUERIES["op3_sharding"](spark, SF).collect()]
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    loads, slots = [0] * 8, [[] for _ in range(8)]
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(r["size"] for r in got)
    assert max(loads) - min(loads) <= 2 * largest


def test_toxicity_whole_table(spark, con):
    got = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01").collect()
    labels = dict(duck("/root/testdata/sf0.01").sql("SELECT doc_id, toxic FROM labels").fetchall())
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    out = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, y in out if y], [s for s, y in out if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.7 and sum(n >= 0.3 for n in neg) <= 0.05 * len(neg)


@pytest.mark.parametrize("sf, least", [("sf0.001", 1), ("sf0.01", 6)])
def test_toxicity_learns_from_few_labels(spark, sf, least):
    """Of 2 held-out toxic rows (9 to learn from) and of 14 (37 to learn from)."""
    got = QUERIES["op4_toxicity"](spark, f"/root/testdata/{sf}").where("held_out").collect()
    labels = dict(duck(f"/root/testdata/{sf}").sql("SELECT doc_id, toxic FROM labels").fetchall())
    pos, neg = ([r["score"] for r in got if labels.get(r["doc_id"]) == y] for y in (1, 0))
    assert sum(s >= 0.3 for s in pos) >= least and sum(s >= 0.3 for s in neg) <= 0.05 * len(neg)
    assert sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) > 0.6 * len(pos) * len(neg)
