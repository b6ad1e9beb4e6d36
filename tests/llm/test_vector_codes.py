"""Vector codes against plain Lloyd over all vectors in Python integers, and on odd rows."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.llm.vector_codes import MOST, PARTS, compress

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, rounds=6, entries=16):
    kept = [(i, v, c) for i, v, c in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // PARTS)
    cut = []
    for i, v, c in kept:
        q = [max(-MOST, min(MOST, math.floor(x * 4096))) for x in v] + [0] * (width * PARTS - len(v))
        cut.append((i, c, [tuple(q[p * width : (p + 1) * width]) for p in range(PARTS)]))
    first = sorted(cut, key=lambda r: (r[0] is None, r[0] or 0))[:entries]
    books = [[r[2][p] for r in first] for p in range(PARTS)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(PARTS):
            mine = {}
            for r in cut:
                mine.setdefault(near(r[2][p], books[p])[1], []).append(r[2][p])
            books[p] = [tuple(sum(x) // len(mine[e]) for x in zip(*mine[e], strict=True)) if e in mine else old for e, old in enumerate(books[p])]
    out = []
    for i, c, parts in cut:
        found = [near(parts[p], books[p]) for p in range(PARTS)]
        out.append((i, c, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    total = {}
    for r in out:
        total[r[1]] = total.get(r[1], 0) + r[3]
    return sorted(((i, code, d, total[c]) for i, c, code, d in out), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)
    out, books = compress(df, **kw)
    return sorted(((r.vec_id, f"{r.code:016x}", r.error, r.label_error) for r in out.collect()), key=str), books


def vectors(n, size, seed=1, distinct=None):
    """Components that 32 bits hold, so that Python and Spark start from the same numbers."""
    r = random.Random(seed)
    pool = [[r.randrange(-3000, 3000) / 4096 + r.choice([0, 1 / 8192]) for _ in range(size)] for _ in range(distinct or n)]
    return [(i, r.choice(pool) if distinct else pool[i], r.choice([None, 1, 2, 3])) for i in range(n)]


def test_against_plain_lloyd(spark):
    for size, n, distinct in ((16, 120, None), (24, 90, 20)):
        rows = vectors(n, size, distinct=distinct)
        assert run(spark, rows)[0] == brute(rows)


def test_hot_vector_hot_label_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr("framequarry.llm.common.HOT_SHARE", 5)
    rows = vectors(80, 8)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, 7 if i % 2 else c) for i, v, c in rows]
    assert run(spark, rows)[0] == brute(rows)
    assert run(spark, rows[:5])[0] == brute(rows[:5])


def test_dropped_rows_odd_lengths_and_large_components(spark):
    good = vectors(20, 10)
    bad = [(100, None, 1), (101, [1.0] * 9 + [None], 1), (102, [float("nan")] * 10, 1), (103, [float("-inf")] + [0.0] * 9, 2)]
    odd = [(104, [], None), (105, [0.5] * 3, 2), (106, [1e30, -1e30] + [0.0] * 8, 3), (None, [0.25] * 10, 1), (None, [0.25] * 10, 1)]
    got, books = run(spark, good + bad + odd)
    assert got == brute(good + bad + odd)
    assert len(got) == 25 and books.shape == (PARTS, 16, 2)
    assert run(spark, [(1, [], None), (2, [], 3)])[0] == [(1, "0" * 16, 0, 0), (2, "0" * 16, 0, 0)]


def test_repeated_ids_keep_their_rows(spark):
    rows = vectors(30, 8)
    rows += rows[:10]
    assert run(spark, rows)[0] == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, [])[0] == [] and run(spark, [(1, None, 1)])[0] == []
    rows = vectors(20, 8)
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("code", "error", "n", "p", "part", "fq_row", "parts")})
    assert sorted(r.vec_id for r in compress(clash)[0].collect()) == list(range(20))


def test_entries_are_bounded(spark):
    with pytest.raises(ValueError):
        run(spark, vectors(3, 8), entries=129)
