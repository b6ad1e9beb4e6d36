"""The skip-chain field: marginals against enumeration, planted mentions, and the query against brute force."""

import hashlib
import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framequarry.llm import pii
from tests.llm.test_text_operators import plain_pii

DIR = "/root/testdata/sf0.01"


def random_field(seed, n_features):
    rng = np.random.default_rng(seed)
    field = pii.SkipChainField(pii.Graph())
    field.unary = rng.normal(0, 0.6, (n_features, pii.N_LABELS))
    field.chain = rng.normal(0, 0.8, (pii.N_LABELS, pii.N_LABELS))
    s = rng.normal(0, 0.8, (pii.N_LABELS, pii.N_LABELS))
    field.skip = s + s.T
    return field


def enumerated(field, graph):
    """Exact marginals by summing over all labellings."""
    z, n = pii.features(graph) @ field.unary, len(graph.seen)
    out = np.zeros((n, pii.N_LABELS))
    for labels in itertools.product(range(pii.N_LABELS), repeat=n):
        if any(o and o != k for o, k in zip(graph.seen, labels)):
            continue
        score = sum(z[i, k] for i, k in enumerate(labels) if not graph.seen[i])
        score += sum(field.chain[labels[a], labels[b]] for a, b in graph.chain) + sum(field.skip[labels[a], labels[b]] for a, b in graph.skip)
        out[np.arange(n), labels] += np.exp(score)
    return out / out.sum(1, keepdims=True)


def graph_of(text):
    graph = pii.Graph()
    graph.add(0, text, pii.base_spans(text))
    return graph


@pytest.mark.parametrize("text", ["a1b2c3 x y1", "call +1 (988) 555-2485 now", "z9z9z9 and then z9z9z9 or 12", "1 2 3 4 5"])
def test_marginals_equal_enumeration_on_trees(text):
    graph = graph_of(text)
    field = random_field(len(text), pii.N_SHAPE + 2)
    assert len(graph.seen) >= 2 and np.allclose(field.marginals(graph), enumerated(field, graph), atol=1e-3)


def test_marginals_are_close_on_loops():
    graph = graph_of("ab12cd ef34gh ab12cd ef34gh")
    field = random_field(3, pii.N_SHAPE + 2)
    field.chain, field.skip = field.chain / 2, field.skip / 2
    assert len(graph.chain) == 3 and len(graph.skip) == 2
    assert np.abs(field.marginals(graph) - enumerated(field, graph)).max() < 0.05


def planted(prose, n, seed):
    """Texts with an entity and a later, changed mention of it, and what the field has to add."""
    r, rows = random.Random(seed), []
    for i in range(n):
        digits = "".join(r.choice("0123456789") for _ in range(7))
        secret = "".join(r.choice("0123456789abcdef") for _ in range(40))
        kind = i % 4
        first, second = [
            (f"name{i}.{i % 90}@mail{i % 9}.example.com", f"name{i}.{i % 90}@mail{i % 9}"),
            (f"+1 ({r.randint(200, 999)}) {digits[:3]}-{digits[3:]}", f"{digits[:3]}-{digits[3:]}"),
            (f'token = "{secret}"', secret),
            (f"api_key: {secret}", f"<{secret}>"),
        ][kind]
        rows.append((i, f"{prose(30, i)} {first} {prose(40, i + 1)} {second} {prose(10, i + 2)}", second.strip("<>")))
    return rows


def test_planted_second_mentions_are_found(docs, prose):
    fit = planted(prose, 300, 1)
    clean = [(1000 + i, f"{prose(40, i)} {i} rooms, 555-2{i:03d} or item 98{i:014d} of 2024, version 1.{i}.x9 {prose(20, i)}") for i in range(200)]
    field = pii.fit_field(docs([(i, t) for i, t, _ in fit] + clean))
    fresh = planted(prose, 200, 2)
    added = [[t[s:e] for k, s, e, base in found if not base] for (_, t, _), found in zip(fresh, pii.search([t for _, t, _ in fresh], field))]
    assert sum(want in got for (_, _, want), got in zip(fresh, added)) >= 0.9 * len(fresh)
    assert not [x for found in pii.search([t for _, t in clean], field) for x in found if not x[3]]


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables aren't here")
def test_query_keeps_base_spans_and_adds(spark):
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    out = pii.op6_pii(spark, DIR).collect()
    assert sorted(r.doc_id for r in out) == sorted(text)
    for r in out:
        base = plain_pii(text[r.doc_id])
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for k, _, _ in base) for j in range(4)]
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert set(line.split(",")) - {""} <= set(r.spans.split(",")) and len(spans) == r.n_spans == len(base) + r.n_added
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), int(x[1])))
    assert sum(r.n_added for r in out) > 0


def test_five_megabytes_repeats_and_empty(docs):
    long = "x y 12 " * 700_000 + "mail bob.42@mail8.example.com token = abcdef0123456789abcdef01"
    rows = [(1, long), (2, "10.0.0.1"), (2, "10.0.0.1"), (3, None), (4, "")]
    field = pii.fit_field(docs([]))
    assert field.empty
    got = [(r.doc_id, [(s.kind, s.base) for s in r.spans]) for r in pii.find_private(docs(rows).withColumn("spans", F.lit(1)), field).collect()]
    assert sorted(got) == [(1, [("email", True)]), (2, [("ip", True)]), (2, [("ip", True)]), (3, []), (4, [])]
    assert pii.find_private(docs([]), field).count() == 0
