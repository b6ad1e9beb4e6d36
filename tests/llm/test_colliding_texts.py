"""Long words of a self-similar pattern, whose polynomial hashes modulo 2^64 are equal, are told apart everywhere."""

import numpy as np
import pytest

import corpus_pipeline
from framequarry.llm import textnum
from framequarry.llm.jaccard import near_duplicates
from framequarry.llm.perplexity import measures


def thue_morse(n):
    a = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


SIZES = pytest.mark.parametrize("size", [1024, 4096, 65536])


@SIZES
def test_hashes(size):
    a, b = thue_morse(size)
    data = np.frombuffer((a + " " + b).encode(), np.uint8)
    for key in (0, 12345):
        h = textnum.span_hashes(data, np.array([0, size + 1]), np.array([size, 2 * size + 1]), key)
        assert h[0] != h[1]


@SIZES
def test_jaccard_links_none_of_them(spark, docs, size):
    a, b = thue_morse(size)
    five = lambda w: " ".join([w, "x", "y", "z", "u", w])
    got = {r.doc_id: r.component_id for r in near_duplicates(docs([(1, a), (2, b), (3, a), (4, five(a)), (5, five(b))])).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_the_pipeline_deletes_none_of_them(spark, docs):
    texts = [t for n in (1024, 4096, 65536) for t in thue_morse(n)]
    kept = corpus_pipeline.one_of_each_group(spark, docs(list(enumerate(texts))), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(6))


@SIZES
def test_base_counts(size):
    a, b = thue_morse(size)
    text = f"{a}\n{b}\n{a} q r\n{b} q r".encode()
    m = measures(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert m["n_dup_lines"].tolist() == [0] and m["n_repeat_words"].tolist() == [0]
    twice = f"{a}\n{a}".encode()
    assert measures(np.frombuffer(twice, np.uint8), np.array([0, len(twice)]))["n_dup_lines"].tolist() == [1]


def test_spans_of_all_lengths_with_zero_bytes():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 4000).astype(np.uint8)
    start = rng.integers(0, 3900, 3000)
    end = start + rng.integers(0, 40, 3000)
    seen = {}
    for s, e, h in zip(start, end, textnum.span_hashes(data, start, end, 7), strict=True):
        assert seen.setdefault(h, data[s:e].tobytes()) == data[s:e].tobytes()
    assert len(seen) == len(set(seen.values()))
