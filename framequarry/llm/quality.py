"""Quality classifier (4): co-training of two views of a document.

The text view is a logistic regression on relative frequencies of hashed byte trigrams and of words that repeat the
word before them. The metadata view is one on what describes the page rather than its words: length, lines, shares of
upper case, digits, marks and rare symbols, word and line lengths, share of distinct words, language and source.
Each round both views are fitted; each then hands the pool rows of which it is most certain, in the labels' proportion,
to the other one as pseudo-labels. At the end each view is calibrated (Platt scaling on labelled rows that it was not
fitted on), and the two calibrated log-odds are averaged and calibrated once more.

Fitting uses bounded samples: ``PER_CLASS`` rows of each label and ``POOL`` unlabelled rows, up to
``FIT_CHARS`` characters of each of the three, texts of more than ``USUAL`` last. Scoring covers every row and whole texts; the model that is broadcast has a fixed size.

Defined results: a null text counts as empty; null language or source is a value of its own; without labelled rows of
both kinds every document scores 1 and is kept. Texts of any length are scored whole; repeated and equal rows (ties) score
alike, and of a repeated id the largest label counts; an empty table gives an empty result. Existing columns named like
results are replaced, others are kept.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.llm.common import labelled_sample, spread_sample, table, up_to
from framequarry.llm.dense import inverse
from framequarry.llm.textnum import LOWER, slices, span_hashes, words

PER_CLASS, POOL = 1200, 3000
USUAL, FIT_CHARS = 20_000, 24_000_000
ROUNDS, PER_ROUND, SURE = 4, 120, 0.97
DIM, TAGS = 2048, 32
RESULTS = ("p_text", "p_meta", "quality_score", "kept")

_UPPER, _DIGIT, _STOP, _SYMBOL, _LETTER = (np.zeros(256) for _ in range(5))
_UPPER[65:91] = _DIGIT[48:58] = 1
_STOP[[33, 44, 46, 58, 59, 63]] = 1
_SYMBOL[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 123, 124, 125, 126]] = 1
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the three bytes from each position; the last two positions have none."""
    d = data.astype(np.uint32)
    return ((d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA77) + d[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(21)) & np.uint32(DIM - 1)


class Measures:
    """What both views need of the rows of a slice."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.n = n = len(off) - 1
        self.size = np.diff(off)
        self.data, self.off = data, off
        self.grams = trigrams(data) if len(data) > 2 else np.zeros(0, np.uint32)
        self.rows = np.repeat(np.arange(n), self.size)[: max(0, len(data) - 2)]
        self.inside = np.arange(len(self.grams)) < (off[1:] - 2)[self.rows] if len(self.grams) else np.zeros(0, bool)
        st, en, row = words(data, off)
        h = span_hashes(LOWER[data], st, en) if len(st) else np.zeros(0, np.uint64)
        self.n_words = np.bincount(row, minlength=n)
        again = np.zeros(len(h))
        again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        w = np.maximum(self.n_words, 1)
        self.repeats = np.bincount(row, weights=again, minlength=n) / w
        both = np.unique((row.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
        distinct = (np.bincount((both >> np.uint64(40)).astype(np.int64), minlength=n) + 20) / (w + 20)
        share = lambda t: self._sum(t[data]) / np.maximum(self.size, 1)
        lines = self._sum((data == 10).astype(float)) + 1
        self.meta = np.column_stack([
            np.log1p(self.size), np.log1p(lines), np.log1p(self.size / lines), self._sum(_LETTER[data]) / w, share(_UPPER), share(_DIGIT),
            share(_STOP), share(_SYMBOL), share(_LETTER), np.sqrt(share(_SYMBOL)), np.sqrt(share(_UPPER)), distinct, self.n_words == 0,
        ])

    def _sum(self, v: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0.0], np.cumsum(v)])
        return c[self.off[1:]] - c[self.off[:-1]]

    def text_sum(self, weights: np.ndarray) -> np.ndarray:
        """Mean weight of each row's trigrams."""
        v = np.bincount(self.rows, weights=weights[self.grams] * self.inside, minlength=self.n) if len(self.grams) else np.zeros(self.n)
        return v / np.maximum(self.size - 2, 1)

    def text_matrix(self) -> np.ndarray:
        if not len(self.grams):
            return np.zeros((self.n, DIM), np.float32)
        at = self.rows[self.inside] * DIM + self.grams[self.inside]
        return (np.bincount(at, minlength=self.n * DIM).reshape(self.n, DIM) / np.maximum(self.size - 2, 1)[:, None]).astype(np.float32)


def tags(*columns: list) -> np.ndarray:
    """One-hot buckets of the values of each column."""
    out = []
    for k, col in enumerate(columns):
        hot = np.zeros((len(col), TAGS))
        at = {v: zlib.crc32(f"{k}:{v}".encode()) % TAGS for v in set(col)}
        hot[np.arange(len(col)), [at[v] for v in col]] = 1
        out.append(hot)
    return np.hstack(out)


def newton(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression; the last column of x is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= inverse((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)) @ (x.T @ (p - y) + ridge * w)
    return w


def descend(x: np.ndarray, y: np.ndarray, start: np.ndarray | None, steps: int) -> np.ndarray:
    """Logistic regression of many coordinates by Adagrad on the whole sample; the last column of x is the constant."""
    w = np.zeros(x.shape[1], np.float32) if start is None else start.copy()
    g2 = np.zeros_like(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = ((p - y).astype(np.float32) @ x) / np.float32(len(y)) + np.float32(1e-5) * w
        g2 += g * g
        w -= np.float32(0.5) * g / np.sqrt(g2 + np.float32(1e-10))
    return w


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class QualityModel:
    """Weights of both views, their Platt lines and the line of the mean of both."""

    def __init__(self, rows: list[dict], y: np.ndarray):
        """rows: text, lang and source of the labelled rows and then of the pool (emptied here); y: labels of the first."""
        col = pa.array([r["text"] for r in rows], pa.large_string())
        # One matrix, filled and scaled in place: it is the largest thing that the driver holds.
        a, meta = np.ones((len(rows), DIM + 2), np.float32), []
        for i, j, data, off in slices(col):
            m = Measures(data, off)
            a[i:j, :DIM], a[i:j, DIM] = m.text_matrix(), m.repeats * 10
            meta.append(m.meta)
        lang, source = [r["lang"] for r in rows], [r["source"] for r in rows]
        rows.clear()
        del col
        mean = a[:, :DIM].mean(0)
        self.spread = np.sqrt(np.maximum(np.einsum("ij,ij->j", a[:, :DIM], a[:, :DIM]) / len(a) - mean * mean, 0)) + np.float32(1e-4)
        a[:, :DIM] /= self.spread
        b = np.vstack(meta)
        self.mean, self.scale = b.mean(0), b.std(0) + 1e-6
        b = np.hstack([(b - self.mean) / self.scale, tags(lang, source), np.ones((len(a), 1))])
        n = len(y)
        fit, check = np.arange(n)[np.arange(n) % 4 != 0], np.arange(n)[np.arange(n) % 4 == 0]
        given = [dict(zip(fit.tolist(), y[fit])) for _ in range(2)]
        free, rate, wa = np.ones(len(a), bool), y.mean(), None
        free[:n] = False
        for r in range(ROUNDS + 1):
            at = [np.array(list(g)) for g in given]
            label = [np.array(list(g.values())) for g in given]
            wa = descend(a[at[0]], label[0], wa, 60 if r == 0 else 20)
            wb = newton(b[at[1]], label[1], 1.0)
            if r == ROUNDS:
                break
            # Log-odds rank the surest rows, whose probabilities all round to 1.
            for view, z in enumerate((a @ wa, b @ wb)):
                for want, sure, share in ((1.0, z, rate), (0.0, -z, 1 - rate)):
                    best = np.flatnonzero(free & (sure >= _logit(SURE)))
                    best = best[np.argsort(-sure[best], kind="stable")][: max(1, round(PER_ROUND * share))]
                    given[1 - view].update((int(i), want) for i in best)
            free[[i for g in given for i in g]] = False
        self.wa, self.wb = wa, wb
        za, zb = a[check] @ wa, b[check] @ wb
        line = lambda z: newton(np.column_stack([z, np.ones(len(z))]), y[check], 1e-3)
        self.la, self.lb = line(za), line(zb)
        self.lc = line((self._on(self.la, za) + self._on(self.lb, zb)) / 2)

    @staticmethod
    def _on(line: np.ndarray, z: np.ndarray) -> np.ndarray:
        return np.clip(line[0] * z + line[1], -30, 30)

    def score(self, col: pa.Array, lang: list, source: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        za, zb = np.zeros(len(col)), np.zeros(len(col))
        w = self.wa[:DIM] / self.spread
        for i, j, data, off in slices(col):
            m = Measures(data, off)
            za[i:j] = m.text_sum(w) + m.repeats * 10 * self.wa[DIM] + self.wa[DIM + 1]
            zb[i:j] = np.hstack([(m.meta - self.mean) / self.scale, tags(lang[i:j], source[i:j]), np.ones((j - i, 1))]) @ self.wb
        xa, xb = self._on(self.la, za), self._on(self.lb, zb)
        return _sigmoid(xa), _sigmoid(xb), _sigmoid(self._on(self.lc, (xa + xb) / 2))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel | None:
    picked = [r.asDict() for r in labelled_sample(docs, labels, label, PER_CLASS, USUAL, FIT_CHARS, extra=("lang", "source"))]
    y = np.array([float(r["fq_label"]) for r in picked])
    if len(y) < 8 or y.min() == y.max():
        return None
    known = docs.where(F.col("text").isNotNull() & (F.length("text") <= FIT_CHARS)).select("doc_id", "text", "lang", "source")
    order = F.xxhash64("doc_id", F.lit(1))
    rows = up_to(spread_sample(known, F.lit(1), POOL, order), F.lit(1), "text", order, USUAL, FIT_CHARS).collect()
    pool = sorted((r.asDict() for r in rows), key=lambda r: (zlib.crc32(r["text"].encode()), str(r["doc_id"])))
    ids = {r["doc_id"] for r in picked}
    return QualityModel(picked + [r for r in pool if r["doc_id"] not in ids], y)


def score_quality(df: DataFrame, model: QualityModel | None, threshold: float = 0.5) -> DataFrame:
    """``df`` with p_text, p_meta, quality_score and kept (score at least ``threshold``)."""
    keep = [c for c in df.columns if c not in RESULTS]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            pos, m = {c: i for i, c in enumerate(b.schema.names)}, shared.value
            ones = np.ones(b.num_rows)
            a, s, q = m.score(b.column(pos["text"]), b.column(pos["lang"]).to_pylist(), b.column(pos["source"]).to_pylist()) if m else (ones, ones, ones)
            yield pa.RecordBatch.from_arrays([*(b.column(pos[c]) for c in keep), pa.array(a), pa.array(s), pa.array(q), pa.array(q >= threshold)], names=[*keep, *RESULTS])

    df = df.select(*keep)
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in zip(RESULTS, (T.DoubleType(), T.DoubleType(), T.DoubleType(), T.BooleanType())))])
    return df.mapInArrow(run, schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", *RESULTS)
