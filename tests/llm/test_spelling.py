"""Spelling variants against brute force; the trie's neighbours against all pairs; crc32 and letter runs against plain Python."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framequarry.llm.spelling import crc_of, letter_runs, spelling_groups
from framequarry.llm.textnum import buffers
from framequarry.llm.trie import Trie

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, every=199, least=6, least_n=5):
    counts = {}
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] = counts.get(w, 0) + 1
    n = {w: c for w, c in counts.items() if len(w) >= least and c >= least_n}
    around = {w: [o for o in n if near(w, o)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(around[w]), n[form[w]] if form[w] else None) for w in n)


def run(df, **kw):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_groups(df, **kw).collect())


def corpus(seed=3, docs=60):
    """Words of a few stems, rarer ones that differ from them by a letter, and still rarer ones that differ from those, so that chains come up."""
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeé×") for _ in range(r.randrange(6, 9))) for _ in range(12)]
    pool = []
    for w in stems:
        for n in (300, 55, 9):
            pool += [w] * n
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + "f" + w[i:], w[:i] + "g" + w[i + 1 :]])
    r.shuffle(pool)
    return [(i, " ".join(w if r.random() < 0.8 else w.upper() for w in pool[i::docs])) for i in range(docs)]


def test_against_brute_force(spark, docs):
    rows = corpus()
    want = brute(rows, every=19)
    assert run(docs(rows), every=19) == want
    assert any(r[2] != r[1] and r[1] for r in want), "a chain of two links"


def test_many_small_shards_and_broadcasts(spark, docs):
    rows = corpus(seed=4)
    assert run(docs(rows), every=19, shard_words=3, broadcast_bytes=400) == brute(rows, every=19)


def test_ties_repeats_nulls_and_other_letters(spark, docs):
    rows = [(1, "Straße straßé " * 30), (1, "Straße straßé " * 30), (None, "straßen " * 5 + "STRASSEN " * 6), (2, None), (3, ""), (4, "aÀbbccdd " * 7 + "1234567 ŁŁŁŁŁŁŁ " * 9)]
    assert run(docs(rows)) == brute(rows)


def test_long_words_and_texts(spark, docs):
    long = "ab" * 50_000
    rows = [(1, (long + " ") * 5), (2, (long[:-1] + " ") * 25), (3, "wörter " * 400_000)]
    assert run(docs(rows)) == brute(rows)


def test_empty_tables_and_clashing_names(spark, docs):
    assert run(docs([])) == [] and run(docs([(1, "too few words")])) == []
    rows = corpus(docs=8)
    clash = docs(rows).withColumns({c: F.lit("x") for c in ("word", "n", "id", "form", "root", "trie")})
    assert run(clash) == brute(rows)


@pytest.mark.parametrize("block", [5, 1 << 13])
def test_neighbours_against_all_pairs(block):
    r = random.Random(2)
    words = sorted({"".join(r.choice("abcé") for _ in range(r.randrange(0, 7))) for _ in range(900)})
    asked = [*words[::4], "zzz", "abx"]
    q, w = Trie.from_bytes(Trie.build(words).to_bytes()).neighbours(asked, block)
    assert sorted(zip(q.tolist(), w.tolist(), strict=True)) == sorted((i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if near(a, b))


def test_runs_and_checksums():
    texts = ["abc", "déf1Ünd", None, "", "x", "é", "日本abc ÷×ø", "a" * 200 + " b"]
    data, off = buffers(pa.array(texts))
    s, e, row = letter_runs(data, off)
    assert [(int(r), data[a:b].tobytes().decode()) for a, b, r in zip(s, e, row, strict=True)] == [(i, w) for i, t in enumerate(texts) for w in RUN.findall(t or "")]
    seed = np.array([zlib.crc32(f"{r}:".encode()) for r in row], np.uint32)
    assert crc_of(data, s, e - s, seed).tolist() == [zlib.crc32(f"{r}:".encode() + data[a:b].tobytes()) for a, b, r in zip(s, e, row, strict=True)]
