"""Packing (1): cutting-stock column generation over a histogram of piece lengths.

1. Every text is tokenised whole, ends with ``end_id`` and is cut into pieces of ``capacity`` and a rest.
2. The rests' lengths are counted in bins (exact up to 64, then about 1 in 32 wide at most; an item has its bin's upper edge).
3. A linear program picks patterns, that is multisets of bins that fit into a sequence: Gilmore-Gomory column generation
   by revised simplex, where a knapsack by dynamic programming prices the next pattern from the duals. It starts
   from greedy patterns and stops within ``gap`` of its lower bound.
4. Pattern counts are rounded down and the few pieces left over (bounded by the number of bins) go first-fit decreasing.
5. Pieces are ranked within their bin by prefix sums over partitions; the rank names the pattern, the copy and the slot.

What reaches the driver is the histogram, one number for each bin, however large the input is.

Defined results: null or empty text is the one id ``end_id``; texts of any length are tokenised whole; ties and repeated
rows are packed as they come; an empty table gives no pieces. Columns of the input other than the id and text are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.llm.common import Scratch, table
from framequarry.llm.dense import inverse as invert

CAPACITY = 4096
CACHE_WORDS = 500_000


#: ASCII punctuation that always is a run of its own; the apostrophe is not, it may begin a suffix.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: From here on code points may combine with others or have lower-case forms that depend on their neighbours.
_HARD = re.compile("[\u0130\u0300-\U0010ffff]").search


def splits_at_spaces(made: dict) -> bool:
    """Whether a tokenizer's file says that it lower-cases, drops white space and takes runs of letters, single digits and
    runs of marks apart before a byte-level merge model sees them."""
    norm, pre, model = made.get("normalizer") or {}, made.get("pre_tokenizer") or {}, made.get("model") or {}
    steps = [(x.get("type"), (x.get("pattern") or {}).get("Regex"), x.get("content")) for x in norm.get("normalizers", [])]
    cuts = pre.get("pretokenizers", [])
    if steps != [("NFC", None, None), ("Replace", "\\s+", " "), ("Lowercase", None, None)] or [x.get("type") for x in cuts] != ["Split", "ByteLevel"]:
        return False
    split, level = cuts
    runs = (split["pattern"].get("Regex") or "").split("|")
    return (
        split.get("behavior") == "Removed" and split.get("invert") is True and not level.get("add_prefix_space") and not level.get("use_regex")
        and runs[-3:] == ["[\\p{L}]+", "[\\p{N}]", "[^\\s\\p{L}\\p{N}]+"] and all(re.fullmatch("'[a-z]+", x) for x in runs[:-3])
        and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    )


class WordCache(dict):
    """Ids (little-endian uint32 bytes) of strings between spaces. The tokenizer drops white space and never joins across
    it, so a text's ids are those of its parts in order; it also lower-cases, and splits letters from the marks after
    them, so such parts share entries, and a word of letters is one unit of its merge model. Texts with code points of
    which this isn't certain are encoded as a whole. Entries not met again while the cache filled up once more are
    dropped, which changes no result. All this holds for one make of tokenizer, which is looked up in its file
    (``splits_at_spaces``); with any other, every text is encoded as a whole."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.old = Tokenizer.from_file(path), {}
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.by_parts, self.special = splits_at_spaces(made), [x["content"].lower() for x in made.get("added_tokens") or []]
        self.units = self.tokenizer.model.tokenize
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x300)}

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            if part.isalpha():
                ids = array("I", [t.id for t in self.units(part.translate(self.table))]).tobytes()
            else:
                core = part.rstrip(_MARKS)
                if core and len(core) < len(part) and core.isalpha():
                    ids = self[core] + self[part[len(core) :]]
                else:
                    ids = self.encode(part)
        if len(part) <= 100:
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not self.by_parts or _HARD(text):
            return self.encode(text)
        low = text.lower()
        if any(x in low for x in self.special):  # these are matched in texts as they are written
            return self.encode(text)
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, low.replace("\n", " ").replace("\t", " ").split(" ")))


_caches: dict[str, WordCache] = {}


def bin_edges(capacity: int) -> np.ndarray:
    """Upper edges of the bins, the last is ``capacity``."""
    edges, step, at = [], 1, 0
    while at < capacity:
        if at >= 64 * step and step < 32:
            step *= 2
        at = min(capacity, at + step)
        edges.append(at)
    return np.array(edges)


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool, names: list[str]):
    edges = bin_edges(capacity)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        cache = _caches.get(path) or _caches.setdefault(path, WordCache(path))
        part, seen = TaskContext.get().partitionId(), np.zeros(len(edges), np.int64)
        for b in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, text in enumerate(texts):
                got = cache.ids(text) + end
                n = len(got) // 4
                for s in range(0, n, capacity):
                    cut = got[4 * s : 4 * (s + capacity)]
                    row.append(i)
                    start.append(s)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(cut, "<u4").astype(np.int32))
            bins = np.searchsorted(edges, np.array(length, np.int64))
            # Rank among the pieces of the same bin in this partition.
            order = np.argsort(bins, kind="stable")
            counts = np.bincount(bins, minlength=len(edges))
            rank = np.empty(len(bins), np.int64)
            rank[order] = np.arange(len(bins)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
            seen += counts
            cols = [b.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            cols += [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            cols += [pa.array(np.full(len(bins), part, np.int32)), pa.array(bins.astype(np.int32)), pa.array(rank)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of items within the capacity; sizes ascending."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(int(sizes[0]), capacity + 1):
        got = best[c - sizes[: fits[c]]] + values[: fits[c]]
        j = int(got.argmax())
        if got[j] > best[c - 1]:
            best[c], pick[c] = got[j], j
        else:
            best[c] = best[c - 1]
    used, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            used[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(best[capacity]), used


def greedy_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns as columns, one for each size: fill the sequence with the largest sizes left, repeat the pattern until a
    size is used up, which becomes that column's pivot. The matrix is triangular up to order, hence regular."""
    m = len(sizes)
    basis, left = np.zeros((m, m)), demand.astype(float)
    for col in range(m):
        pattern, room = np.zeros(m), capacity
        for j in np.flatnonzero(left > 0)[::-1]:
            n = min(room // int(sizes[j]), int(np.ceil(left[j])))
            pattern[j] = n
            room -= n * int(sizes[j])
            if room < sizes[0]:
                break
        at = np.flatnonzero(pattern)
        if not len(at):
            break
        times = left[at] / pattern[at]
        pivot = at[times.argmin()]
        left[at] = np.maximum(left[at] - times.min() * pattern[at], 0)
        basis[:, pivot] = pattern
        done = at[left[at] <= 1e-9]
        left[done] = 0
        for j in done[done != pivot]:  # used up at the same time: it stays out of later patterns
            basis[j, j] = capacity // sizes[j]
    return basis


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-3, max_steps: int = 300) -> list[tuple[np.ndarray, int]]:
    """(pattern, copies) that together hold ``demand`` items of each size exactly; sizes ascending, at most ``capacity``."""
    m = len(sizes)
    if not m:
        return []
    basis = greedy_basis(sizes, demand, capacity)
    inverse, d, bound = invert(basis), demand.astype(float), 0.0
    for step in range(max_steps):
        x, dual = inverse @ d, inverse.sum(0)
        worth, column = knapsack(np.maximum(dual, 0), sizes, capacity)
        bound = max(bound, x.sum() / max(worth, 1.0))
        if worth <= 1 + 1e-9 or x.sum() <= bound * (1 + gap):
            break
        u = inverse @ column
        ratio = np.where(u > 1e-9, np.maximum(x, 0) / np.where(u > 1e-9, u, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        if step % 100 == 99:
            inverse = invert(basis)
        else:
            pivot = inverse[out] / u[out]
            inverse -= np.outer(u, pivot)
            inverse[out] = pivot
    copies = np.floor(np.maximum(invert(basis) @ d, 0) + 1e-7).astype(np.int64)
    whole = basis.astype(np.int64)
    while (over := whole @ copies - demand).max() > 0:
        i = int(over.argmax())
        copies[np.flatnonzero((whole[i] > 0) & (copies > 0))[0]] -= 1
    plan = [(whole[:, j].copy(), int(copies[j])) for j in np.flatnonzero(copies)]
    # What rounding leaves is less than one pattern of each column.
    rest, bins, room = demand - whole @ copies, [], []
    for j in range(m - 1, -1, -1):
        left, i = int(rest[j]), 0
        while left:
            if i == len(bins):
                bins.append(np.zeros(m, np.int64))
                room.append(capacity)
            n = min(left, int(room[i] // sizes[j]))
            bins[i][j] += n
            room[i] -= n * int(sizes[j])
            left -= n
            i += 1
    return plan + [(b, 1) for b in bins]


def _slots(plan: list[tuple[np.ndarray, int]], used: np.ndarray, n_bins: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each bin: the first rank, the number in the pattern and the first sequence of the patterns that hold it."""
    base = np.cumsum([0, *(n for _, n in plan)])
    out = {}
    for i, b in enumerate(used):
        have = [(p[i], n, base[j]) for j, (p, n) in enumerate(plan) if p[i]]
        per, n, first = (np.array(x, np.int64) for x in zip(*have))
        out[int(b)] = (np.cumsum(per * n) - per * n, per, first)
    return out


def pack_documents(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for."""
    scratch = Scratch(df.sparkSession)
    out = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType())]
    out += [("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    own = [("fq_part", T.IntegerType()), ("fq_bin", T.IntegerType()), ("fq_rank", T.LongType())]
    src = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([src.schema[0], *(T.StructField(n, t) for n, t in out + own)])
    pieces = scratch.write(src.mapInArrow(_pieces(tokenizer, capacity, end_id, with_ids, schema.names), schema))
    counts = pieces.groupBy("fq_part", "fq_bin").agg(F.count("*").alias("fq_n"))
    histogram = {r["fq_bin"]: r["n"] for r in counts.groupBy("fq_bin").agg(F.sum("fq_n").alias("n")).collect()}
    edges, used = bin_edges(capacity), np.array(sorted(histogram), np.int64)
    plan = cutting_stock(edges[used], np.array([histogram[b] for b in used], np.int64), capacity) if len(used) else []
    slots = df.sparkSession.sparkContext.broadcast(_slots(plan, used, len(edges)))

    def place(batches):
        for b in batches:
            bins, rank = np.asarray(b.column("fq_bin")), np.asarray(b.column("fq_rank")) + np.asarray(b.column("fq_base"))
            seq, slot = np.zeros(len(bins), np.int64), np.zeros(len(bins), np.int64)
            for i in np.unique(bins):
                at = np.flatnonzero(bins == i)
                first, per, base = slots.value[int(i)]
                j = np.searchsorted(first, rank[at], side="right") - 1
                q = rank[at] - first[j]
                seq[at], slot[at] = base[j] + q // per[j], int(i) * (capacity + 1) + q % per[j]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(seq), pa.array(slot)], names=[*kept, "sequence_id", "fq_slot"])

    kept = ["doc_id", *(n for n, _ in out)]
    bases = counts.selectExpr("fq_part", "fq_bin", "sum(fq_n) over (partition by fq_bin order by fq_part) - fq_n as fq_base")
    placed = pieces.join(bases, ["fq_part", "fq_bin"]).mapInArrow(place, T.StructType([*(f for f in schema if f.name in kept), T.StructField("sequence_id", T.LongType()), T.StructField("fq_slot", T.LongType())]))
    return placed.selectExpr(*kept, "sequence_id", "sum(length) over (partition by sequence_id order by fq_slot) - length as offset")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
