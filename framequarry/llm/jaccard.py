"""N-gram Jaccard join (3): documents whose word-shingle sets have a similarity of 0.8 or more, and what they connect.

Method: size-banded tiles with hashed bitmap signatures and exact verification, made sub-quadratic without losing a link.

1. Shingle statistics. Chunks of whole documents send their distinct shingles (56 bits of a hash keyed anew for each run, sorted, delta-coded) to
   hash ranges. A shingle that a chunk has more than once goes out once, so no range gathers more entries of it than
   there are chunks. Ranges return the document frequency of every shingle that more than one document has.
2. A document can only link if at least 0.8 of its set is shared. Of such documents the prefix is kept: with shingles in
   order of frequency, two sets that link have one in common among each one's first n - ceil(0.8 n) + 1.
3. Documents of equal sets become one node (128-bit signature of the set).
4. Tiles: nodes by prefix shingle and size band; bands are a quarter wide, so that sets that link are in the same or in
   neighbouring bands, and a node is in its own band's tile and the next one's.
5. Leaders. Each tile first names one leader, then ``LEADERS`` more. Pairs of a leader and another node of its tile, of
   different components and suitable sizes, are bounded from above by bit counts of their signatures (parity bitmaps: at
   least as many elements differ as bits do); what passes is verified by intersecting the sorted arrays, and links of the
   first round merge components. A leader has then met its whole tile and leaves it; a tile whose nodes are all of one
   component is done. So a group of near copies costs about one comparison for each member.
   Blocks. Tiles that still hold several components are dealt out in pairs of blocks of about ``BLOCK`` nodes. A block
   bounds all its pairs by bit counts and, where any passes, gets the exact sizes of all common parts of the nodes
   concerned from one product of incidence matrices. A spanning forest of its links leaves it. No pair of different
   components is left unchecked.
   Hot tiles and hot leaders: a tile of many nodes is joined with its leaders in parts of ``HOT`` nodes, and so is a
   leader that has many pairs with their bitmaps and tokens.
6. Components: large-star and small-star steps over the links of representatives.

Nothing is gathered on the driver; tables between steps are in the shared folder.

Defined results: null and empty texts, and texts without words, have n_shingles 0 and link with nothing; texts of any length
are read whole; rows that repeat an id and text share a node, and each has a result; documents at exactly the threshold
(ties) link; a component of which no document has an id has a null id; an empty table gives an empty result; columns other
than the id and text are not read, so their names can't clash.
"""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.llm.common import Scratch, look_up, table
from framequarry.llm.textnum import LOWER, mix, shingles, slices, span_hashes, words

K, PERCENT = 5, 80
CHUNK_BYTES, RANGE_BYTES, CHUNK_DOCS = 8 << 20, 8 << 20, 60_000
TOKEN_BITS, BAND, BITMAP = 56, 1.26, 1024
#: Rows whose numbers fit above a token's bits.
ROWS = 1 << (64 - TOKEN_BITS)
LEADERS, BLOCK, COLUMNS, HOT = 24, 512, 8192, 2048
_MANY = 65_535
_TOKEN = np.uint64((1 << TOKEN_BITS) - 1)


def pack_sorted(t: np.ndarray) -> bytes:
    """Ascending uint64 as byte planes of the differences; the shuffle's compression removes the empty planes."""
    return np.diff(t, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() if len(t) else b""


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64) if b else np.zeros(0, np.uint64)


def shingle_sets(col: pa.Array, key: int):
    """(first row, last row, tokens, rows) of slices: distinct tokens of each row, sorted by row and token."""
    for i, j, data, off in slices(col):
        data = LOWER[data]
        st, en, row = words(data, off)
        value, at = shingles(span_hashes(data, st, en, key), row, j - i, K)
        order = np.argsort(at, kind="stable")
        value, at = value[order] >> np.uint64(64 - TOKEN_BITS), at[order]
        for a in range(0, j - i, ROWS):
            here = slice(*np.searchsorted(at, [a, a + ROWS]))
            both = np.unique(((at[here] - a).astype(np.uint64) << np.uint64(TOKEN_BITS)) | value[here])
            yield i + a, min(j, i + a + ROWS), both & _TOKEN, (both >> np.uint64(TOKEN_BITS)).astype(np.int64)


PACKED = [("chunk", T.LongType()), ("kind", T.IntegerType()), ("tokens", T.BinaryType()), ("docs", T.BinaryType()), ("counts", T.BinaryType())]


def _signature(tokens: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, 2), np.uint64)
    for c, salt in enumerate((0x51ED270B, 0x2545F491)):
        s = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens + np.uint64(salt << 13)), dtype=np.uint64)])
        b = np.searchsorted(rows, np.arange(n + 1))
        out[:, c] = s[b[1:]] - s[b[:-1]]
    return out


def _send(ranges: int, key: int):
    edges = np.array([(b << TOKEN_BITS) // ranges for b in range(ranges + 1)], np.uint64)

    def flush(chunk: int, ids: list, parts: list, n_docs: int):
        t, d = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int32)
        parts.clear()
        sizes = np.bincount(d, minlength=n_docs)
        sig = _signature(t, d, n_docs)
        order = np.argsort(t, kind="stable")
        t, d = t[order], d[order]
        first = np.flatnonzero(np.diff(t, prepend=np.uint64(1 << 63)) != 0)
        count = np.diff(np.append(first, len(t)))
        once = count == 1
        home = int(mix(np.array([chunk], np.uint64))[0] % np.uint64(ranges))
        kept, batch = pa.BufferOutputStream(), pa.RecordBatch.from_arrays([pa.chunked_array(ids).combine_chunks()], names=["id"])
        with pa.ipc.new_stream(kept, batch.schema) as stream:
            stream.write_batch(batch)
        rows = [(home, chunk, 1, sizes.astype("<i4").tobytes(), sig.astype("<u8").tobytes(), kept.getvalue().to_pybytes())]
        local = np.repeat(~once, count)
        rows.append((home, chunk, 2, pack_sorted(t[local]), d[local].astype("<u2").tobytes(), None))
        u, where = t[first], np.where(once, d[first], _MANY).astype("<u2")
        # Only ranges that the chunk has tokens of: the work grows with the chunk, not with the number of ranges.
        home_of = np.searchsorted(edges, u, side="right") - 1
        cut = np.flatnonzero(np.diff(home_of, prepend=-1))
        for i, j in zip(cut, np.append(cut[1:], len(u))):
            rows.append((int(home_of[i]), chunk, 0, pack_sorted(u[i:j]), where[i:j].tobytes(), count[i:j][~once[i:j]].astype("<u4").tobytes()))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[3:])], names=["key", *(n for n, _ in PACKED)])

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        ids, parts, n, size = [], [], 0, 0
        for b in batches:
            for i, j, t, row in shingle_sets(b.column(1), key):
                if n and (size >= CHUNK_BYTES or n + j - i > CHUNK_DOCS):
                    yield from flush(chunk, ids, parts, n)
                    chunk, ids, parts, n, size = chunk + 1, [], [], 0, 0
                ids.append(b.column(0).slice(i, j - i))
                parts.append((t, (row + n).astype(np.int32)))
                n, size = n + j - i, size + 8 * len(t)
        if n:
            yield from flush(chunk, ids, parts, n)

    return run


def _frequencies(pdf: pd.DataFrame) -> pd.DataFrame:
    """One hash range: shared tokens back to their chunks (kind 3, counts: frequencies); other kinds pass."""
    mine, rest = pdf[pdf["kind"] == 0], pdf[pdf["kind"] != 0].drop(columns="key")
    if not len(mine):
        return rest
    toks = [unpack_sorted(b) for b in mine["tokens"]]
    docs = [np.frombuffer(b, "<u2") for b in mine["docs"]]
    n = [np.ones(len(d), np.int64) for d in docs]
    for a, d, c in zip(n, docs, mine["counts"]):
        a[d == _MANY] = np.frombuffer(c, "<u4")
    t, src = np.concatenate(toks), np.repeat(np.arange(len(toks)), [len(x) for x in toks])
    order = np.argsort(t, kind="stable")
    s = t[order]
    first = np.flatnonzero(np.diff(s, prepend=np.uint64(1 << 63)) != 0)
    total = np.add.reduceat(np.concatenate(n)[order], first)
    df = np.empty(len(t), np.int64)
    df[order] = np.repeat(total, np.diff(np.append(first, len(s))))
    keep = df > 1
    t, src, df, docs = t[keep], src[keep], np.minimum(df[keep], 65_535), np.concatenate(docs)[keep]
    cut, rows = np.searchsorted(src, np.arange(len(toks) + 1)), []
    for k, chunk in enumerate(mine["chunk"]):
        i, j = cut[k], cut[k + 1]
        if i < j:
            rows.append((chunk, 3, pack_sorted(t[i:j]), docs[i:j].astype("<u2").tobytes(), df[i:j].astype("<u2").tobytes()))
    return pd.concat([pd.DataFrame(rows, columns=rest.columns), rest]) if len(rest) else pd.DataFrame(rows, columns=rest.columns)


def _least(n: np.ndarray) -> np.ndarray:
    """Fewest common elements of a set of n with any set that links with it."""
    return -(-n * PERCENT // 100)


def bitmaps(tokens: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Parity bitmaps: bit h of a row is the parity of the number of its tokens that hash to h."""
    h = (mix(tokens ^ np.uint64(0x3C6EF372FE94F82B)) % np.uint64(BITMAP)).astype(np.int64)
    odd = np.bincount(rows * BITMAP + h, minlength=n * BITMAP).reshape(n, BITMAP) & 1
    return np.packbits(odd.astype(bool), axis=1)


NODE_FIELDS = [("n", T.LongType()), ("own", T.IntegerType()), ("sig", T.BinaryType()), ("tokens", T.BinaryType()), ("prefix", T.BinaryType()), ("bits", T.BinaryType())]


def _assemble(pdf: pd.DataFrame) -> pd.DataFrame:
    """One chunk: for each document its set's size and signature, and tokens, prefix and bitmap if it can link."""
    of = {k: g for k, g in pdf.groupby("kind")}
    head = of[1].iloc[0]
    ids = pa.ipc.open_stream(head["counts"]).read_all().column(0).to_pylist()
    size = np.frombuffer(head["tokens"], "<i4").astype(np.int64)
    sig = np.frombuffer(head["docs"], "<u8").reshape(-1, 2)
    t = d = f = np.zeros(0, np.int64)
    if 3 in of:
        back = of[3]
        t = np.concatenate([unpack_sorted(b) for b in back["tokens"]])
        d = np.concatenate([np.frombuffer(b, "<u2") for b in back["docs"]]).astype(np.int64)
        f = np.concatenate([np.frombuffer(b, "<u2") for b in back["counts"]]).astype(np.int64)
        lt, ld = unpack_sorted(of[2].iloc[0]["tokens"]), np.frombuffer(of[2].iloc[0]["docs"], "<u2").astype(np.int64)
        many = np.flatnonzero(d == _MANY)
        many = many[np.argsort(t[many])]
        lf = f[many][np.searchsorted(t[many], lt)] if len(lt) else np.zeros(0, np.int64)
        one = d != _MANY
        t, d, f = np.concatenate([t[one], lt]), np.concatenate([d[one], ld]), np.concatenate([f[one], lf])
    shared = np.bincount(d, minlength=len(size))
    can = (size > 0) & (shared >= _least(size))
    keep = can[d]
    t, d, f = t[keep].astype(np.uint64), d[keep], f[keep]
    order = np.lexsort((t, f, d))
    tf, df = t[order], d[order]
    order = np.lexsort((t, d))
    ts = t[order]
    at = np.searchsorted(df, np.arange(len(size) + 1))
    out = {"tokens": [None] * len(size), "prefix": [None] * len(size), "bits": [None] * len(size)}
    first = size - _least(size) + 1 - (size - shared)
    some = np.flatnonzero(can)
    for lo in range(0, len(some), 2000):
        part = some[lo : lo + 2000]
        inside = np.concatenate([np.arange(at[i], at[i + 1]) for i in part])
        bits = bitmaps(ts[inside], np.repeat(np.arange(len(part)), at[part + 1] - at[part]), len(part))
        for k, i in enumerate(part):
            out["tokens"][i] = ts[at[i] : at[i + 1]].astype("<u8").tobytes()
            out["prefix"][i] = tf[at[i] : at[i] + first[i]].astype("<u8").tobytes()
            out["bits"][i] = bits[k].tobytes()
    return pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "n": size, "own": (size - shared).astype(np.int32), "sig": [s.tobytes() if n else None for s, n in zip(sig, size)], **out})


def shingle_table(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: doc_id, n, sig (null where n is 0), and tokens, prefix and bits of those that can link."""
    src = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    id_field = src.schema[0]
    packed = T.StructType([T.StructField(n, t) for n, t in PACKED])
    sent = src.mapInArrow(_send(ranges, secrets.randbits(64)), T.StructType([T.StructField("key", T.IntegerType()), *packed.fields]))
    back = sent.groupBy("key").applyInPandas(_frequencies, packed)
    return back.groupBy("chunk").applyInPandas(_assemble, T.StructType([T.StructField("doc_id", id_field.dataType), *(T.StructField(n, t) for n, t in NODE_FIELDS)]))


def _tiles(batches):
    for b in batches:
        n = np.asarray(b.column(1))
        pre = [np.frombuffer(x.as_py(), "<u8") for x in b.column(2)]
        size = np.array([len(x) for x in pre])
        t = np.concatenate(pre) if len(pre) else np.zeros(0, np.uint64)
        band = np.repeat(np.floor(np.log(n) / np.log(BAND)).astype(np.uint64), size)
        at = np.repeat(np.arange(len(n)), size)
        tile = np.concatenate([mix(t * np.uint64(2654435761) + (band + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)) for k in (0, 1)])
        at = np.concatenate([at, at])
        for i in range(0, len(at), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(tile[i : i + 200_000].view(np.int64)), b.column(0).take(pa.array(at[i : i + 200_000])), pa.array(n[at[i : i + 200_000]]), b.column(3).take(pa.array(at[i : i + 200_000]))], names=["tile", "sig", "n", "own"])


def _may_link(batches):
    """Pairs whose bit counts allow enough common elements."""
    for b in batches:
        na, nb = np.asarray(b.column("na")), np.asarray(b.column("nb"))
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64).reshape(-1, BITMAP // 64) for c in ("bits_a", "bits_b"))
        common = (na + nb - np.bitwise_count(x ^ y).sum(1)) // 2
        ok = pa.array(100 * common >= PERCENT * (na + nb - common))
        yield b.select(["a", "b", "na", "nb"]).filter(ok)


def _verify(batches):
    for b in batches:
        na, nb, hit = np.asarray(b.column("na")), np.asarray(b.column("nb")), np.zeros(b.num_rows, bool)
        for i, (x, y) in enumerate(zip(b.column("tokens_a"), b.column("tokens_b"))):
            s = np.sort(np.concatenate([np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")]), kind="stable")
            common = int((s[1:] == s[:-1]).sum())
            hit[i] = 100 * common >= PERCENT * (na[i] + nb[i] - common)
        yield b.select(["a", "b"]).filter(pa.array(hit))


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links among the nodes of a pair of blocks of a tile."""
    pdf = pdf.drop_duplicates("sig")
    n, root, side = pdf["n"].to_numpy(), pd.factorize(pdf["root"])[0], pdf["side"].to_numpy()
    mixed = len(set(side)) > 1
    bits = np.frombuffer(b"".join(pdf["bits"]), np.uint64).reshape(len(pdf), -1)
    maybe = np.zeros((len(pdf), len(pdf)), bool)
    for i in range(len(pdf) - 1):
        common = (n[i] + n[i + 1 :] - np.bitwise_count(bits[i] ^ bits[i + 1 :]).sum(1)) // 2
        ok = (100 * common >= PERCENT * (n[i] + n[i + 1 :] - common)) & (root[i + 1 :] != root[i])
        maybe[i, i + 1 :] = ok & (side[i + 1 :] != side[i]) if mixed else ok
    at = np.flatnonzero(maybe.any(0) | maybe.any(1))
    if not len(at):
        return pd.DataFrame({"a": [], "b": []})
    toks = [np.frombuffer(pdf["tokens"].iloc[i], "<u8") for i in at]
    t, row = np.concatenate(toks), np.repeat(np.arange(len(at)), [len(x) for x in toks])
    keys, col, often = np.unique(t, return_inverse=True, return_counts=True)
    keep = often[col] > 1
    col, row = (np.cumsum(often > 1) - 1)[col[keep]], row[keep]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    common = np.zeros((len(at), len(at)))
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        here = slice(*np.searchsorted(col, [lo, lo + COLUMNS]))
        m = np.zeros((len(at), COLUMNS), np.float32)
        m[row[here], col[here] - lo] = 1
        common += m @ m.T
    total = n[at][:, None] + n[at][None, :] - common
    i, j = np.nonzero(maybe[np.ix_(at, at)] & (100 * common >= PERCENT * total))
    sig, kept, parent = pdf["sig"].to_numpy()[at], [], {}

    def top(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    # A spanning forest of the links, over the components known so far: it connects what all of them connect.
    group = root[at]
    for k, (x, y) in enumerate(zip(group[i].tolist(), group[j].tolist())):
        x, y = top(x), top(y)
        if x != y:
            parent[x] = y
            kept.append(k)
    return pd.DataFrame({"a": sig[i[kept]], "b": sig[j[kept]]})


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node and its component's smallest node, for every node of ``edges`` (columns a and b)."""
    e = scratch.write(edges.where("a <> b").selectExpr("greatest(a, b) as v", "least(a, b) as u").distinct(), thin=True)

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()

    before = state(e)
    while before[0]:
        # Large star: a node's larger neighbours are tied to the smallest node it knows.
        both = e.selectExpr("v as x", "u as y").unionByName(e.selectExpr("u as x", "v as y"))
        least = both.groupBy("x").agg(F.min("y").alias("y")).selectExpr("x as c", "least(x, y) as m")
        large = both.where("y > x").join(least, both.x == least.c).selectExpr("y as v", "m as u").distinct()
        large = scratch.write(large, thin=True)
        # Small star: its smaller neighbours and itself are tied to the smallest of these.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low.withColumnRenamed("v", "c"), F.col("v") == F.col("c")).selectExpr("u as v", "m as u").unionByName(low.selectExpr("v", "m as u")).where("v <> u").distinct()
        new = scratch.write(small, thin=True)
        scratch.drop(e, large)
        e, now = new, state(new)
        if now == before:
            break
        before = now
    return e.selectExpr("v as node", "u as root").unionByName(e.selectExpr("u as node", "u as root").distinct())


def _live(posts: DataFrame, labels: DataFrame | None, round_no: int, leaders: int, scratch: Scratch) -> DataFrame:
    """The posts of tiles with at least two components, with root, the tile's size and whether the node leads: the one
    with the fewest elements of its own, likely what the others are copies of, and about ``leaders`` more by hash."""
    tagged = posts.withColumn("root", F.col("sig"))
    if labels is not None:
        # A long document is in as many tiles as its prefix has shingles.
        tagged = look_up(posts, labels.withColumnRenamed("node", "sig"), ["sig"], F.col("tile"), "left", nulls=False).withColumn("root", F.coalesce("root", "sig"))
    rank = F.xxhash64("sig", F.lit(round_no))
    first = F.struct("own", rank.alias("rank"))
    stats = tagged.groupBy("tile").agg(F.count("*").alias("size"), F.min("root").alias("r0"), F.max("root").alias("r1"), F.min(first).alias("lead")).where("r0 <> r1").select("tile", "size", "lead")
    share = F.lit(float(leaders)) / F.col("size") * float(2**64) - float(2**63)
    leads = (first == F.col("lead")) | (rank.cast("double") < share)
    live = look_up(tagged, stats, ["tile"], F.col("sig"), nulls=False)
    return scratch.write(live.withColumn("leads", leads).select("tile", "sig", "n", "own", "root", "size", "leads"))


def _ways(n: str) -> Column:
    return F.ceil(F.col(n) / HOT)


def _hot(pairs: DataFrame, scratch: Scratch) -> DataFrame | None:
    """node and ways: into how many parts the pairs of a node go that has more than ``HOT`` of them."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    hot = scratch.write(ends.groupBy("node").agg(F.count("*").alias("m")).where(F.col("m") > HOT).select("node", _ways("m").alias("ways")), thin=True)
    return None if hot.isEmpty() else hot


def _with(pairs: DataFrame, nodes: DataFrame, column: str, hot: DataFrame | None) -> DataFrame:
    """``pairs`` with ``column`` of both their nodes."""
    for end, other in (("a", "b"), ("b", "a")):
        side = nodes.selectExpr(f"sig as {end}", f"{column} as {column}_{end}")
        if hot is None:
            pairs = pairs.join(side, end)
            continue
        mine = hot.withColumnRenamed("node", end)
        ways = F.coalesce("ways", F.lit(1))
        left = look_up(pairs, mine, [end], F.col(other), "left", nulls=False, few=True).withColumn("way", F.pmod(F.xxhash64(other), ways)).drop("ways")
        right = side.join(mine, end, "left").withColumn("way", F.explode(F.sequence(F.lit(0).cast("long"), ways - 1))).drop("ways")
        pairs = left.join(right, [end, "way"]).drop("way")
    return pairs


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", trace: list | None = None) -> DataFrame:
    """Per row of ``df``: doc_id, n_shingles, component_id. ``trace`` gathers the number of pairs of each round."""
    scratch = Scratch(df.sparkSession)
    rows = scratch.write(shingle_table(df, doc_id, text))
    can = rows.where("prefix is not null")
    nodes = scratch.write(can.groupBy("sig").agg(F.first("n").alias("n"), F.first("own").alias("own"), F.first("tokens").alias("tokens"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits")))
    posts = nodes.select("sig", "n", "prefix", "own").mapInArrow(_tiles, "tile long, sig binary, n long, own int")
    links = labels = None
    for round_no, leaders in enumerate((0, LEADERS)):
        live = _live(posts, labels, round_no, leaders, scratch)
        lead = live.where("leads").select("tile", F.explode(F.sequence(F.lit(0).cast("long"), _ways("size") - 1)).alias("part"), F.col("sig").alias("ls"), F.col("n").alias("ln"), F.col("root").alias("lr"))
        met = live.withColumn("part", F.pmod(F.xxhash64("sig"), _ways("size"))).join(lead, ["tile", "part"])
        met = met.where("root <> lr").where(f"100 * least(n, ln) >= {PERCENT} * greatest(n, ln)")
        pairs = scratch.write(met.selectExpr("least(sig, ls) as a", "greatest(sig, ls) as b", "if(sig < ls, n, ln) as na", "if(sig < ls, ln, n) as nb").distinct())
        hot = _hot(pairs, scratch)
        may = _with(pairs, nodes, "bits", hot).mapInArrow(_may_link, "a binary, b binary, na long, nb long")
        sure = scratch.write(_with(may, nodes, "tokens", hot).mapInArrow(_verify, "a binary, b binary"))
        if trace is not None:
            trace.append((round_no, live.count(), may.count(), sure.count()))
        links = sure if links is None else links.unionByName(sure)
        if labels is None and not sure.isEmpty():
            labels = components(sure, scratch)
        scratch.drop(pairs)
        posts = live.where("not leads").select("tile", "sig", "n", "own")
    live = _live(posts, labels, 2, 0, scratch)
    many = F.ceil(F.col("size") / BLOCK)
    mine = F.pmod(F.xxhash64("sig"), many)
    dealt = live.withColumns({"many": many, "side": mine}).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)))
    dealt = dealt.select("tile", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "root", "sig").join(nodes.select("sig", "n", "bits", "tokens"), "sig")
    found = scratch.write(dealt.groupBy("tile", "lo", "hi").applyInPandas(_block, "a binary, b binary").distinct())
    if trace is not None:
        trace.append((2, live.count(), found.count()))
    if not (found.isEmpty() and sure.isEmpty()):
        labels = components(links.unionByName(found), scratch)
    own = rows.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("first"))
    if labels is not None:
        tied = labels.join(own, F.col("node") == F.col("sig")).select("node", "root", "first")
        least = tied.groupBy("root").agg(F.min("first").alias("least"))
        named = tied.join(least, "root").select(F.col("node").alias("sig"), "least")
        own = own.join(named, "sig", "left").select("sig", F.coalesce("least", "first").alias("first"))
    out = look_up(rows.select("doc_id", "n", "sig"), own, ["sig"], F.col("doc_id"), "left", nulls=False)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
