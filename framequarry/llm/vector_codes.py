"""Vector code compression (12): product codes from weighted Lloyd over the distinct integer parts of the vectors.

1. Components become integers, floor(4096 * x), and each vector is cut into 8 equal consecutive parts.
2. Equal parts of one position are one weighted row: (position, part, number of vectors).
3. Lloyd runs over these distinct rows. In each round tasks assign their rows to the nearest of a position's 16 entries
   and send sums and weights of each entry; these 8 x 16 rows of sums are all that reaches the driver.
4. The distinct rows get their final code and error, which are joined back to the parts of the vectors
   (``join_counted``: a part that many vectors share is broadcast, all others are shuffled) and put together per vector.

So a vector that a third of all rows repeat is assigned once a round, and the codebooks (8 x 16 entries) are the only
model. Errors per label are sums of sums, joined back in the same way.

Defined results: rows whose vector is null or holds a null or non-finite component are left out. Integers are held within
2^24 either way (components beyond 4096), so that squared distances fit 64 bits. All vectors take the length of the longest,
rounded up to a multiple of 8; shorter ones end in zeros. Codebooks start from the smallest ids, null ids last, and of
rows with one id those with the smaller parts first; with fewer than 16 rows there are as many entries as rows. Repeated
rows come back as often as they went in, an empty table gives an empty result, null labels are one label. Columns other
than id, vector and label are not read. Vectors of any length are taken whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import Scratch, join_counted, table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Largest integer of a component.
MOST = 1 << 24


def integer_parts(vectors: pa.ListArray, width: int) -> np.ndarray:
    """(rows, PARTS, width) integers of a column of finite vectors without nulls, cut or filled up with zeros."""
    values = np.asarray(vectors.flatten(), dtype=np.float64)
    size = np.asarray(vectors.value_lengths(), dtype=np.int64)
    whole = np.clip(np.floor(values * SCALE), -MOST, MOST).astype(np.int32)
    out = np.zeros((len(vectors), PARTS * width), np.int32)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(whole)) - np.repeat(np.cumsum(size) - size, size)] = whole
    return out.reshape(len(vectors), PARTS, width)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the first of the nearest entries of ``book`` and the squared distance to it."""
    best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
    for e, entry in enumerate(book):
        d = ((x - entry) ** 2).sum(axis=1)
        closer = d < best
        best[closer], at[closer] = d[closer], e
    return at, best


def assigned(batch: pa.RecordBatch, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Position, components, nearest entry and distance of distinct rows."""
    p = np.asarray(batch.column("p"), dtype=np.int64)
    x = np.frombuffer(b"".join(batch.column("part").to_pylist()), np.int32).reshape(len(p), books.shape[2]).astype(np.int64)
    at, error = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    for k in range(PARTS):
        here = np.flatnonzero(p == k)
        at[here], error[here] = nearest(x[here], books[k])
    return p, x, at, error


def lloyd_round(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks (PARTS, entries, width) after one round; an entry that no part is nearest to stays."""
    _, k, width = books.shape

    def partial(batches):
        sums, weight = np.zeros((PARTS * k, width), np.int64), np.zeros(PARTS * k, np.int64)
        for b in batches:
            p, x, at, _ = assigned(b, books)
            n = np.asarray(b.column("n"), dtype=np.int64)
            np.add.at(sums, p * k + at, x * n[:, None])
            np.add.at(weight, p * k + at, n)
        used = np.flatnonzero(weight)
        slot, j = np.repeat(used, width + 1), np.tile(np.arange(width + 1), len(used))
        total = np.concatenate([sums[used], weight[used, None]], axis=1).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total)], names=["slot", "j", "total"])

    found = distinct.mapInArrow(partial, "slot int, j int, total long").groupBy("slot", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r.slot, r.j): int(r.total) for r in found}
    out = books.copy()
    for (slot, j), s in total.items():
        if j < width:
            out[slot // k, slot % k, j] = s // total[slot, width]
    return out


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """Per kept row: vec_id, label, code (bigint, a byte for each part), error and label_error; and the codebooks (PARTS, entries, width)."""
    if not 0 < entries <= 128:  # a code's first byte must leave a bigint's sign alone
        raise ValueError("1 to 128 entries")
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vec"))
    kept = source.where(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    width = -(-(kept.agg(F.max(F.size("vec"))).first()[0] or 0) // PARTS)

    def cut(batches):
        for b in batches:
            parts = integer_parts(b.column("vec"), width)
            flat = parts.reshape(len(parts) * PARTS, width)
            offsets = np.arange(len(flat) + 1, dtype=np.int32) * (4 * width)
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])
            rows = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * PARTS), blobs)
            yield pa.RecordBatch.from_arrays([b.column("fq_row"), b.column("vec_id"), b.column("label"), rows], names=["fq_row", "vec_id", "label", "parts"])

    numbered = kept.withColumn("fq_row", F.monotonically_increasing_id())
    schema = numbered.select("fq_row", "vec_id", "label", F.lit(None).cast("array<binary>").alias("parts")).schema
    rows = scratch.write(numbered.mapInArrow(cut, schema))
    parts = rows.select("fq_row", "vec_id", "label", F.posexplode("parts").alias("p", "part"))
    distinct = scratch.write(parts.groupBy("p", "part").agg(F.count("*").alias("n")))

    first = [r.parts for r in rows.select("vec_id", "parts").orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(entries).collect()]
    books = np.array([[np.frombuffer(r[k], np.int32) for r in first] for k in range(PARTS)], np.int64).reshape(PARTS, len(first), width)
    for _ in range(rounds if first else 0):
        books = lloyd_round(distinct, books)

    def final(batches):
        for b in batches:
            _, _, at, error = assigned(b, books)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at), pa.array(error)], names=["p", "part", "n", "code", "error"])

    codes = scratch.write(distinct.mapInArrow(final, "p int, part binary, n long, code long, error long"))
    shifted = F.expr(f"shiftleft(code, 8 * ({PARTS - 1} - p))")
    coded = join_counted(parts, codes, ["p", "part"], "n").groupBy("fq_row", "vec_id", "label").agg(F.sum(shifted).alias("code"), F.sum("error").alias("error"))
    coded = scratch.write(coded.drop("fq_row"))
    scratch.drop(rows, distinct, codes)
    labels = scratch.write(coded.groupBy("label").agg(F.count("*").alias("n"), F.sum("error").alias("label_error")))
    return join_counted(coded, labels, ["label"], "n").drop("n"), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    code = F.lower(F.lpad(F.hex("code"), 2 * PARTS, "0"))
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle() -> str:
    """The same by plain Lloyd over all vectors, for DuckDB: one row for each component."""
    ctes = [
        "k as materialized (select row_number() over () as r, vec_id, label, embedding from embeddings where embedding is not null"
        " and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"u as (select r, len(embedding) // {PARTS} as width, unnest(range(len(embedding))) as i, unnest(embedding) as x from k)",
        f"c as materialized (select r, i // width as p, i % width as j, cast(floor(cast(x as double) * {SCALE}) as bigint) as v from u)",
        f"f as (select r, row_number() over (order by vec_id nulls last) - 1 as e from k qualify e < {ENTRIES})",
        "b0 as materialized (select p, e, j, v from c join f using (r))",
    ]
    for t in range(ROUNDS + 1):
        ctes.append(f"d{t} as (select r, p, e, sum((c.v - b.v) * (c.v - b.v)) as d from c join b{t} b using (p, j) group by all)")
        ctes.append(f"a{t} as materialized (select r, p, arg_min(e, d * {ENTRIES} + e) as e, min(d) as d from d{t} group by all)")
        if t < ROUNDS:
            ctes.append(f"s{t} as (select p, e, j, cast(floor(sum(v) / count(*)) as bigint) as v from c join a{t} using (r, p) group by all)")
            ctes.append(f"b{t + 1} as materialized (select p, e, j, coalesce(s.v, b.v) as v from b{t} b left join s{t} s using (p, e, j))")
    ctes.append(f"o as (select r, string_agg(lower(printf('%02x', e)), '' order by p) as code, cast(sum(d) as bigint) as error from a{ROUNDS} group by r)")
    ctes.append(f"h as (select sha256(string_agg(cast(v as varchar), ',' order by p, e, j)) as codebooks_sha256 from b{ROUNDS})")
    return f"with {', '.join(ctes)} select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from k join o using (r), h"


ORACLE = oracle()
