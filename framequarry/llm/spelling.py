"""Spelling variant grouping (13): words at an edit distance of one, found by automata in broadcast tries.

1. Tasks cut whole texts into runs of letters, lower-case A-Z, apply the deletion rule below and count words in bounded
   dictionaries; Spark adds the counts up.
2. The vocabulary is sorted by range and built into tries of at most ``SHARD_WORDS`` words, one row of bytes each.
3. Shards are broadcast a few at a time, up to ``BROADCAST_BYTES`` together. Every word's distance-one Levenshtein
   automaton is intersected with each of them depth-first (``trie.py``); a shard without a word's first letters ends it at
   once. A task reduces a word's neighbours to their number and the best one before anything is emitted.
4. Counts are added and the best of the shards' best forms is taken. Roots follow forms by pointer doubling: n grows fivefold at
   each step, so a chain has at most log5(largest n) links and the number of rounds is known beforehand.

Deletion rule: of a run whose crc32 of ``<doc_id>:<run>`` is divisible by ``EVERY``, the code point crc32 % length goes; this plants
known misspellings.

Defined results: a null text has no words, a null id counts as the text ``null``; runs of any length are taken whole; repeated
rows count again; of forms alike in n the first in code-point order counts; an empty table gives an empty result. Only ids
and texts are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import Scratch, table
from framequarry.llm.textnum import LOWER, slices
from framequarry.llm.trie import Trie

#: crc32 values divisible by this take a letter out.
EVERY = 199
LEAST_LETTERS = 6
LEAST_N = 5
#: A form occurs at least so many times as often as its variant.
TIMES = 5
#: Words of a shard, about 25 bytes each.
SHARD_WORDS = 250_000
BROADCAST_BYTES = 32 << 20
#: Words that a task looks up at once, and in all, a second's work for each shard.
QUERIES, TASK_WORDS = 2048, 20_000
#: Bytes of words that a task counts at once.
COUNTED = 16 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c


CRC = _crc_table()


def letter_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of the maximal runs of A-Z, a-z and U+00C0 to U+00FF, which UTF-8 writes as 0xC3 and one more byte, and their rows."""
    mask = _LETTER[data]
    lead = data == 0xC3
    mask |= lead
    mask[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[:-1] = mask
    edge[1:-1] &= ~mask[:-1]
    inner = off[(off > 0) & (off < len(data))]
    edge[inner] |= mask[inner]  # a text begins: a run of the one before ends there
    starts = np.flatnonzero(edge[:-1])
    stop = np.zeros(len(data) + 1, bool)
    stop[1:] = mask
    stop[1:-1] &= ~mask[1:]
    stop[inner] |= mask[inner - 1]
    return starts, np.flatnonzero(stop), np.searchsorted(off, starts, side="right") - 1


def crc_of(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each span, carried on from ``seed`` (crc32 of what comes before it). Long spans go one by one."""
    out = np.zeros(len(start), np.uint32)
    long = size > 64
    for i in np.flatnonzero(long):
        out[i] = zlib.crc32(data[start[i] : start[i] + size[i]].tobytes(), int(seed[i]))
    order = np.argsort(-size, kind="stable")
    order = order[np.count_nonzero(long) :]
    s, at, n = ~seed[order].astype(np.uint32), start[order], size[order]
    for j in range(int(n[0]) if len(n) else 0):
        m = int(np.searchsorted(-n, -j, side="left"))  # spans of more than j bytes
        s[:m] = CRC[(s[:m] ^ data[at[:m] + j]) & 0xFF] ^ (s[:m] >> np.uint32(8))
    out[order] = ~s
    return out


def _without_one(word: str, h: int) -> str:
    i = h % len(word)
    return word[:i] + word[i + 1 :]


def count_words(batches: Iterator[pa.RecordBatch], every: int, least: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        found = pc.value_counts(pa.chunked_array(held, pa.string()))
        return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])

    for b in batches:
        ids = b.column("id").to_pylist()
        for i, j, data, off in slices(b.column("text")):
            starts, ends, row = letter_runs(data, off)
            letters = np.zeros(len(data) + 1, np.int64)
            np.cumsum(data & 0xC0 != 0x80, out=letters[1:])
            length = letters[ends] - letters[starts]
            enough = length >= least
            starts, ends, row, length = starts[enough], ends[enough], row[enough], length[enough]
            low = LOWER[data]
            seeds = np.array([zlib.crc32(f"{x}:".encode()) for x in ids[i:j]], np.uint32)
            h = crc_of(low, starts, ends - starts, seeds[row])
            hit = h % np.uint32(every) == 0
            cut = [_without_one(low[s:e].tobytes().decode(), int(x)) for s, e, x in zip(starts[hit], ends[hit], h[hit], strict=True)]
            starts, ends = starts[~hit], ends[~hit]
            n = ends - starts
            offsets = np.zeros(len(n) + 1, np.int32)
            np.cumsum(n, out=offsets[1:])
            body = low[np.repeat(starts - offsets[:-1], n) + np.arange(offsets[-1])]
            held.append(pa.StringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(body)))
            if kept := [w for w in cut if len(w) >= least]:
                held.append(pa.array(kept, pa.string()))
            size += int(offsets[-1])
            if size > COUNTED:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = EVERY, least: int = LEAST_LETTERS, least_n: int = LEAST_N) -> DataFrame:
    """word and n of words of at least ``least`` code points that occur at least ``least_n`` times."""
    source = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("id"), F.col(text).alias("text"))
    parts = source.mapInArrow(lambda batches: count_words(batches, every, least), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def trie_shards(words: DataFrame, total: int, shard_words: int) -> DataFrame:
    """Rows (size, first, trie, ns): tries of ranges of at most ``shard_words`` words, with the words' counts as 64-bit integers."""

    def build(batches):
        held: list[pa.RecordBatch] = []

        def shard(rows: pa.Table) -> pa.RecordBatch:
            w = rows.column("word").to_pylist()
            blob = Trie.build(w).to_bytes()
            text = "\n".join(w).encode()
            ns = np.asarray(rows.column("n").combine_chunks(), dtype=np.int64).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([len(blob) + len(text) + len(ns)]), pa.array([w[0]]), pa.array([blob], pa.binary()), pa.array([text], pa.binary()), pa.array([ns], pa.binary())], names=["size", "first", "trie", "words", "ns"])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= shard_words:
                rows = pa.Table.from_batches(held)
                while rows.num_rows >= shard_words:
                    yield shard(rows.slice(0, shard_words))
                    rows = rows.slice(shard_words)
                held = rows.to_batches()
        if sum(x.num_rows for x in held):
            yield shard(pa.Table.from_batches(held))

    ranges = max(1, -(-total // shard_words))
    return words.repartitionByRange(ranges, "word").sortWithinPartitions("word").mapInArrow(build, "size long, first string, trie binary, words binary, ns binary")


def near_words(words: DataFrame, total: int, shards: DataFrame, broadcast_bytes: int, scratch: Scratch) -> DataFrame:
    """word, n_near and best (-n, word) of the near words in each group of shards that is broadcast together."""
    spark = words.sparkSession
    groups, room = [], 0
    for r in shards.select("first", "size").orderBy("first").collect():  # a row for each SHARD_WORDS words
        if not groups or r["size"] > room:
            groups.append([])
            room = broadcast_bytes
        groups[-1].append(r["first"])
        room -= r["size"]
    out = words.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    for firsts in groups:
        rows = shards.where(F.col("first").between(firsts[0], firsts[-1])).select("trie", "words", "ns").collect()
        sent = spark.sparkContext.broadcast([(bytes(r.trie), bytes(r.words), bytes(r.ns)) for r in rows])

        def look_up(batches, sent=sent):
            tries = [(Trie.from_bytes(t), np.array(w.decode().split("\n"), object), np.frombuffer(ns, np.int64)) for t, w, ns in sent.value]
            for b in batches:
                for a in range(0, b.num_rows, QUERIES):
                    asked = b.column("word").slice(a, QUERIES).to_pylist()
                    count, best_n, best = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64), np.full(len(asked), None, object)
                    for trie, names, ns in tries:
                        q, w = trie.neighbours(asked)
                        if not len(q):
                            continue
                        count += np.bincount(q, minlength=len(asked))
                        order = np.lexsort((w, -ns[w], q))  # numbers of a shard's words follow code points
                        q, w = q[order], w[order]
                        top = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
                        for i, j in zip(q[top], w[top], strict=True):  # shards come in the order of their words, so the first of equals stays
                            if ns[j] > best_n[i]:
                                best_n[i], best[i] = ns[j], names[j]
                    hit = np.flatnonzero(count)
                    yield pa.RecordBatch.from_arrays([pa.array([asked[i] for i in hit], pa.string()), pa.array(count[hit]), pa.array(best_n[hit]), pa.array(list(best[hit]), pa.string())], names=["word", "n_near", "best_n", "best"])

        found = words.select("word").repartition(max(1, -(-total // TASK_WORDS)), "word").mapInArrow(look_up, "word string, n_near long, best_n long, best string")
        out = out.unionByName(scratch.write(found))
        sent.unpersist()
    return out.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))).alias("best"))


def roots(forms: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """word and root of the words that have a form: each round doubles the links that a row has followed."""
    links = scratch.write(forms.select("word", F.col("form").alias("root")))
    chain, power = 1, LEAST_N * TIMES
    while power <= most:
        chain, power = chain + 1, power * TIMES
    for _ in range((chain - 1).bit_length()):
        on = links.select(F.col("word").alias("fq_word"), F.col("root").alias("fq_root"))
        before, links = links, scratch.write(links.join(on, F.col("root") == F.col("fq_word"), "left").select("word", F.coalesce("fq_root", "root").alias("root")))
        scratch.drop(before)
    return links


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS, broadcast_bytes: int = BROADCAST_BYTES, **rules: int) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    scratch = Scratch(docs.sparkSession)
    words = scratch.write(vocabulary(docs, doc_id, text, **rules))
    total, most = words.agg(F.count("*"), F.max("n")).first()
    shards = scratch.write(trie_shards(words, total, shard_words))
    near = near_words(words, total, shards, broadcast_bytes, scratch)
    follows = F.col("best.m") * -1 >= F.col("n") * TIMES
    named = words.join(near, "word").select("word", "n", "n_near", F.when(follows, F.col("best.w")).alias("form"), F.when(follows, -F.col("best.m")).alias("form_n"))
    named = scratch.write(named)
    scratch.drop(words, shards)
    ends = roots(named.where("form is not null"), most or 0, scratch)
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
