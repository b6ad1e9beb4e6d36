"""Toxicity (9): logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are 46-bit hashes of the distinct words, word stems (the first ``STEM`` bytes of longer words), word pairs and pairs
that skip one or two words of the whole text (A-Z lower-cased; words are runs of letters, digits and non-ASCII bytes). Every coordinate has its own learning rate
and L1 keeps most weights at exactly zero; what is left is a sorted hash array with one weight each, which is
broadcast. Its size is bounded by the bounded sample of labelled rows: ``PER_CLASS`` of each label, up to ``FIT_CHARS``
characters of each, texts of more than ``USUAL`` last. Hashes are not folded into buckets, so long texts don't gather weight from collisions. A feature of fewer than
``MIN_ROWS`` rows of the sample gets no weight: it says little about others, and most features are of this kind.

Defined results: a null or empty text scores by the bias alone; texts of any length are scored whole; repeated and equal
rows score alike; an empty table gives an empty result; without labelled rows of both kinds every score is (nearly) 0; of
a repeated id the largest label counts; existing columns ``score`` and ``predicted`` are replaced, others are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import held_out, labelled_sample, table
from framequarry.llm.textnum import LOWER, mix, slices, span_hashes, words

PER_CLASS, USUAL, FIT_CHARS = 3000, 60_000, 40_000_000
#: FTRL's alpha, beta, L1, L2 and passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 3.0, 1.0, 20.0, 0.0, 10
SKIPS = (1, 2, 3)
#: Bytes of a word's stem.
STEM = 5
#: A feature of fewer labelled rows than this gets no weight.
MIN_ROWS = 3
_BITS = 46
_LOW = np.uint64((1 << _BITS) - 1)

#: Bytes that are not part of a word: ASCII other than letters and digits.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes (46 bits) and their rows, sorted by row."""
    data = LOWER[data]
    st, en, row = words(data, off, NOT_WORD)
    h = span_hashes(data, st, en)
    r = row.astype(np.uint64) << np.uint64(_BITS)
    out = [r | (h & _LOW)]
    long = en - st > STEM
    if long.any():
        stem = span_hashes(data, st[long], st[long] + STEM)
        out.append(r[long] | (mix(stem ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & _LOW))
    for k in SKIPS:
        if len(h) > k:
            ok = row[k:] == row[:-k]
            out.append((r[:-k] | (mix(h[:-k] * np.uint64(2 * k + 1) + (h[k:] >> np.uint64(1))) & _LOW))[ok])
    both = np.unique(np.concatenate(out))
    return both & _LOW, (both >> np.uint64(_BITS)).astype(np.int64)


class FtrlModel:
    """keys (sorted hashes), weights and bias."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def scores(self, col: pa.Array) -> np.ndarray:
        out = np.full(len(col), self.bias)
        for i, j, data, off in slices(col):
            v, row = features(data, off)
            if len(self.keys) and len(v):
                at = np.minimum(np.searchsorted(self.keys, v), len(self.keys) - 1)
                hit = self.keys[at] == v
                out[i:j] += np.bincount(row[hit], weights=self.weights[at[hit]], minlength=j - i)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def ftrl(examples: list[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    """Weights of n coordinates; an example is the array of its coordinates, each with value 1, and gives one update."""
    z, g2, w = np.zeros(n), np.zeros(n), np.zeros(n)
    up = len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, len(y) - y.sum()))
    order = np.random.default_rng(0)
    for _ in range(PASSES):
        for e in order.permutation(len(examples)):
            x = examples[e]
            zx, gx = z[x], g2[x]
            wx = np.where(np.abs(zx) <= L1, 0.0, -(zx - np.sign(zx) * L1) / ((BETA + np.sqrt(gx)) / ALPHA + L2))
            w[x] = wx
            g = (1 / (1 + np.exp(-np.clip(wx.sum(), -30, 30))) - y[e]) * (up[0] if y[e] else up[1])
            rise = (np.sqrt(gx + g * g) - np.sqrt(gx)) / ALPHA
            z[x] = zx + g - rise * wx
            g2[x] = gx + g * g
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(g2)) / ALPHA + L2))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> FtrlModel:
    """Fits on at most PER_CLASS rows and FIT_CHARS characters of each label 0 and 1."""
    picked = labelled_sample(docs, labels, label, PER_CLASS, USUAL, FIT_CHARS, key, text)
    y = np.array([float(r["fq_label"]) for r in picked])
    if not len(y) or y.min() == y.max():
        return FtrlModel(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    col = pa.array([r[text] for r in picked], pa.large_string())
    del picked
    # A table of small counters, which never counts too few, drops most features of too few rows before the exact count,
    # so that the driver doesn't hold them all at once.
    seen = np.zeros(1 << 24, np.uint16)
    for _, _, data, off in slices(col):
        at, n = np.unique(features(data, off)[0] & np.uint64((1 << 24) - 1), return_counts=True)
        seen[at] = np.minimum(seen[at].astype(np.int64) + n, 60000)
    parts = []
    for i, _, data, off in slices(col):
        v, r = features(data, off)
        ok = seen[v & np.uint64((1 << 24) - 1)] >= MIN_ROWS
        parts.append((v[ok], (r[ok] + i).astype(np.int32)))
    value, row = np.concatenate([v for v, _ in parts]), np.concatenate([r for _, r in parts])
    del parts, seen, col
    keys, n = np.unique(value, return_counts=True)
    keys = keys[n >= MIN_ROWS]
    if not len(keys):
        return FtrlModel(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    at = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
    keep = keys[at] == value
    at, row = at[keep] + 1, row[keep]
    ends = np.searchsorted(row, np.arange(len(y)), side="right")
    w = ftrl([np.append(x, 0) for x in np.split(at, ends[:-1])], y, len(keys) + 1)
    on = w[1:] != 0
    return FtrlModel(keys[on], w[1:][on], float(w[0]))


def score_toxicity(df: DataFrame, model: FtrlModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``df`` without ``text``, with ``score`` and ``predicted``; existing columns of these names are replaced."""
    keep = [c for c in df.columns if c not in (text, "score", "predicted")]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            score = shared.value.scores(b.column(b.schema.names.index(text)))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.names.index(c)) for c in keep), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    schema = df.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    for f in schema.fields:
        f.nullable = True
    return df.select(*keep, text).mapInArrow(run, schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    out = score_toxicity(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
