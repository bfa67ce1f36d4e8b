"""The numpy parts against plain Python."""

import numpy as np
import pytest

from quantlake.llm.fmindex import FMIndex, WaveletMatrix
from quantlake.llm.jaccard import listed_pairs, min_overlap, parity_bits, prefix_length
from quantlake.llm.packing import best_fit_decreasing, cut_points
from quantlake.llm.sharding import LOWEST, quantiles
from quantlake.llm.substring import WORD, Segments, repeated_in_shard, segment_ids
from quantlake.llm.toxicity import nnpu
from quantlake.llm.wordhash import Words, shingle_sets


def test_wavelet_rank():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 13, 500)
    w = WaveletMatrix(s, 12)
    c, at = rng.integers(0, 13, 300), rng.integers(0, 501, 300)
    assert [int(x) for x in w.rank(c, at)] == [int((s[:p] == x).sum()) for x, p in zip(c, at)]


@pytest.mark.parametrize("depth,alphabet", [(2, 2), (3, 3), (5, 2), (20, 1), (20, 2)])
def test_repeats_match_brute_force(depth, alphabet):
    rng = np.random.default_rng(depth * 7 + alphabet)
    for _ in range(20):
        pieces = [rng.integers(0, alphabet, rng.integers(depth, 3 * depth + 10)).astype(np.uint64) for _ in range(rng.integers(1, 7))]
        seen, want = set(), set()
        for k, p in enumerate(pieces):
            for i in range(len(p) - depth + 1):
                key = tuple(p[i : i + depth])
                if key in seen:
                    want |= {(k, j) for j in range(i, i + depth)}
                seen.add(key)
        got = {(k, j) for k, a, n in repeated_in_shard(pieces, depth) for j in range(a, a + n)}
        assert got == want


def test_backward_search_finds_first_place():
    text = np.array([1, 2, 1, 2, 3, 0, 1, 2, 3, 0])
    index = FMIndex(text, 2)
    got = {(int(p), int(a)): int(e) for ps, at, es in index.earliest_windows([text[:5], text[6:9]]) for p, a, e in zip(ps, at, es)}
    assert got == {(0, 0): 0, (0, 1): 1, (0, 2): 0, (0, 3): 3, (1, 0): 0, (1, 1): 3}


TEXTS = ["", " ", "a", "a b\tc\n\nd\x0be\x0cf\rg", " x y é ß", "x" * 5000 + " " + "y " * 3000, "A b C a B c", "Ä ä"]


def test_words_follow_the_pattern():
    h, counts = Words().of(TEXTS)
    want = [WORD.findall(t) for t in TEXTS]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(h.tolist())) == len(set(flat)) and len(set(zip(h.tolist(), flat))) == len(set(flat))


def test_words_do_not_depend_on_chunks(monkeypatch):
    import quantlake.llm.wordhash as W

    whole = Words().of(TEXTS)
    monkeypatch.setattr(W, "CHUNK", 7)
    cut = Words().of(TEXTS)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_shingle_sets_sizes():
    low = [len(s) for s in shingle_sets(Words(True), ["", "a b", "A B", "a b c d a b c d", "a b c d e"], 4)]
    assert low == [0, 1, 1, 4, 2]
    a, b = list(shingle_sets(Words(True), ["a b", "A B"], 4))
    assert (a == b).all()


def test_segments_cover_all_windows_once_and_agree():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 4, n))) for n in (0, 5, 19, 20, 21, 60, 200)]
    words = Words()
    s = Segments(words, texts)
    got = sorted((int(t), int(f - s.text_start[t]) + k) for t, f, n in zip(s.text, s.first, s.length) for k in range(n - 19))
    assert got == [(t, i) for t, x in enumerate(texts) for i in range(max(0, len(x.split()) - 19))]
    gram = {}
    for t, f, n, g in zip(s.text, s.first, s.length, s.gram):
        for k in range(n - 19):
            assert gram.setdefault(s.h[f + k : f + k + 20].tobytes(), g) == g  # equal windows go to one shard
    ids = segment_ids(s.h, s.first, s.length)
    body = {}
    for i, f, n in zip(ids, s.first, s.length):
        assert body.setdefault(int(i), s.h[f : f + n].tobytes()) == s.h[f : f + n].tobytes()
    assert len(set(body.values())) == len(body)


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 100):
        lengths = rng.integers(1, capacity + 1, 200)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        rooms, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            fit = [r for r in rooms if r >= lengths[i]]
            if fit:
                rooms[rooms.index(min(fit))] -= lengths[i]
            else:
                rooms.append(capacity - lengths[i])
        loads = np.bincount(bins, weights=lengths)
        assert loads.max() <= capacity and len(loads) == len(rooms)
        assert sorted(capacity - loads) == sorted(rooms)
        for b in range(len(loads)):
            at = 0
            for i in sorted(np.flatnonzero(bins == b), key=lambda i: offsets[i]):
                assert offsets[i] == at
                at += lengths[i]
        del want


def test_cut_points():
    assert cut_points(1, 4) == [0] and cut_points(4, 4) == [0] and cut_points(5, 4) == [0, 1]
    assert cut_points(8, 4) == [0, 4] and cut_points(11, 4) == [0, 3, 7]


def test_prefix_and_overlap_bounds():
    for percent in (80, 85):
        for a in range(1, 60):
            for b in range(1, 60):
                least = next((i for i in range(min(a, b) + 1) if 100 * i >= percent * (a + b - i)), None)
                if least is not None:
                    assert least == min_overlap(a, b, percent)
                    assert least >= a - prefix_length(a, percent) + 1


def test_lists_lose_no_link():
    rng = np.random.default_rng(3)
    sets, percent = [], 80
    for _ in range(150):
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.7 else frozenset(rng.integers(0, 60, 12).tolist())
        s = set(base)
        for _ in range(rng.integers(0, 3)):
            s.symmetric_difference_update({int(rng.integers(0, 60))})
        sets.append(frozenset(s) or frozenset({1}))
    found = set()
    for token in range(60):
        at = [i for i, s in enumerate(sets) if token in sorted(s)[: prefix_length(len(s), percent)]]
        if len(at) > 1:
            n, pos = np.array([len(sets[i]) for i in at]), np.array([sorted(sets[i]).index(token) for i in at])
            bits = np.array([np.frombuffer(parity_bits(np.array(sorted(sets[i]), np.uint64)), "<u8") for i in at])
            for x, y in listed_pairs(np.array(at), n, pos, np.array(at), bits, percent):
                found |= {(min(p), max(p)) for p in zip(x.tolist(), y.tolist())}
    for i in range(150):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                assert (j, i) in found


@pytest.mark.parametrize("block", [256, 2])
def test_lists_together_equal_lists_alone(monkeypatch, block):
    import quantlake.llm.jaccard as J

    monkeypatch.setattr(J, "BLOCK", block)
    rng = np.random.default_rng(12)
    n = rng.integers(5, 30, 60)
    rows = np.array([(t, 0, 0, c, n[c], rng.integers(0, 4), c % 40) for t in range(50) for c in rng.integers(0, 60, rng.integers(1, 9))])
    got = {tuple(r) for d in J.pairs_of_lists(rows, np.zeros((len(rows), 8), np.uint64), 80) for r in d.to_numpy().tolist()}
    want = set()
    for t in range(50):
        best = {}
        for _, _, _, c, _, p, _ in rows[rows[:, 0] == t]:
            best[c] = min(p, best.get(c, 99))
        for x in best:
            for y in best:
                fits = min(n[x], n[y]) * 100 >= max(n[x], n[y]) * 80
                if x < y and x % 40 != y % 40 and fits and min(n[x] - best[x], n[y] - best[y]) >= min_overlap(n[x], n[y], 80):
                    want.add((x, y))
    assert got == want


def test_quantiles_split_a_hot_key():
    rows = [{"key": 5, "tie": t, "w": 1.0} for t in range(100)] + [{"key": k, "tie": k, "w": 1.0} for k in (1, 9)]
    cuts = quantiles(rows, 10)
    assert (5, LOWEST) in cuts and len([c for c in cuts if c[0] == 5]) >= 8


def test_nnpu_separates_and_ignores_noise():
    rng = np.random.default_rng(0)
    x, y, truth = [], [], []
    for i in range(3000):
        toxic = i % 10 == 0
        x.append(np.array([0] * toxic + rng.integers(1, 50, 5).tolist()))
        y.append(int(toxic and i % 20 == 0))
        truth.append(toxic)
    w, b = nnpu(x, np.array(y), 0.1, 50)
    s = np.array([b + w[i].sum() for i in x])
    p = 1 / (1 + np.exp(-s))
    assert ((p >= 0.3) == np.array(truth)).mean() > 0.98


def test_long_blank_runs_keep_their_ids(monkeypatch):
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from quantlake.llm import packing

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing._encoding(packing.vocabulary())
    ids = lambda t: tok.encode(t, add_special_tokens=False).ids
    for t in ("a" + " " * 1_000_000 + "b", "a" + "\n" * 1_000_000, "\t" * 1_000_000 + "!x", "x" + "\u3000 " * 500_000 + "y", "z" * 1_000_000):
        assert packing.token_ids(enc, t) == ids(t)
    assert len(packing.token_ids(enc, "a" + " " * 10_000_000 + "b")) == 10_000_001      # what the pattern gives: a, the run, ' b'
    rng = random.Random(1)
    monkeypatch.setattr(packing, "LONG_BLANKS", 3)                                       # the same cuts on short runs
    monkeypatch.setattr(packing, "BLANKS", packing.re.compile(packing.BLANKS.pattern.replace("100000", "3")))
    pieces = [" ", "  ", "\n", "\t", "\x1c", "\xa0", "\u2003", "a", "é", "12", "'s", "!?", "<|endoftext|>", "中"]
    for _ in range(3000):
        t = "".join(rng.choices(pieces, k=rng.randrange(3, 14)))
        assert packing.token_ids(enc, t) == ids(t), repr(t)
