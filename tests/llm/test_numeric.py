"""Vectorised text primitives and small solvers against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from framequarry.llm import dense, packing, textnum

ALPHABET = "ab \n\t\x0b\x1cé中.X"


def texts(n=200, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(n)] + [None, "", " ", "a" * 5000]


def test_words_equal_regex():
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for size in (7, 1 << 20):
        got = []
        for i, j, data, off in textnum.slices(pa.array(texts()), size):
            st, en, row = textnum.words(data, off)
            got += [(i + r, bytes(data[s:e]).decode()) for s, e, r in zip(st, en, row)]
        assert got == [(i, w) for i, t in enumerate(texts()) for w in word.findall(t or "")]


def test_span_hashes_tell_spans_apart():
    col = pa.array(texts())
    seen = {}
    for _, _, data, off in textnum.slices(col):
        st, en, _ = textnum.words(data, off)
        for s, e, h in zip(st, en, textnum.span_hashes(data, st, en)):
            assert seen.setdefault(h, bytes(data[s:e])) == bytes(data[s:e])


def test_shingles_short_rows():
    h = np.arange(1, 12, dtype=np.uint64)
    row = np.array([0, 0, 0, 1, 1, 1, 1, 1, 1, 3, 3])
    _, at = textnum.shingles(h, row, 5, 5)
    assert sorted(at.tolist()) == [0, 1, 1, 3]


def test_inverse_and_cholesky():
    a = np.random.default_rng(0).normal(size=(30, 30))
    assert np.allclose(dense.inverse(a) @ a, np.eye(30))
    k = a @ a.T + np.eye(30)
    low = dense.cholesky(k)
    assert np.allclose(low @ low.T, k) and np.allclose(np.triu(low, 1), 0)


def test_cutting_stock_is_exact_and_tight():
    rng, edges = np.random.default_rng(0), packing.bin_edges(4096)
    for n in (1, 3, 200, 5000):
        bins = np.searchsorted(edges, np.minimum(4096, rng.lognormal(6.5, 1, n).astype(int) + 1))
        used, count = np.unique(bins, return_counts=True)
        plan = packing.cutting_stock(edges[used], count, 4096)
        assert (sum(p * k for p, k in plan) == count).all()
        assert all((p * edges[used]).sum() <= 4096 for p, _ in plan)
        least = (edges[used] * count).sum() / 4096
        assert sum(k for _, k in plan) <= least * 1.02 + 3
    assert packing.cutting_stock(edges[:0], np.zeros(0, int), 4096) == []


def test_knapsack_by_brute_force():
    sizes, values = np.array([3, 4, 7]), np.array([1.0, 1.5, 3.0])
    best = max(a * 1.0 + b * 1.5 + c * 3.0 for a in range(6) for b in range(5) for c in range(3) if 3 * a + 4 * b + 7 * c <= 17)
    worth, used = packing.knapsack(values, sizes, 17)
    assert worth == best and (used * sizes).sum() <= 17


def test_word_cache_equals_tokenizer():
    cache = packing.WordCache(packing.tokenizer_path())
    r = random.Random(1)
    letters = "ab 'stre\n\t\r\x0b\x1c\x85\xa0é\u0301Ω9!<|endoftext|>中文 ſİH\u0331Σ.,*$AKß"
    for _ in range(3000):
        s = "".join(r.choice(letters) for _ in range(r.randint(0, 25))) + r.choice(["", "<|endoftext|>", " it's we'll"])
        assert np.frombuffer(cache.ids(s), "<u4").tolist() == cache.tokenizer.encode(s, add_special_tokens=False).ids
