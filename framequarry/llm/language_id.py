"""Language ID (10): string-kernel classification with Nystroem landmarks and one-versus-rest kernel ridge regression.

Kernel: blended spectrum of character n-grams by presence, k(x, y) = |grams(x) & grams(y)| / sqrt(|grams(x)| |grams(y)|)
with grams(x) the distinct n-grams of the lower-cased text for every n in ``ORDERS``. Landmarks Z come from the training
sample; the feature map is phi(x) = k(x, Z) K_ZZ^(-1/2) (any root, here of the Cholesky factor) and ridge regression on it has one output per language. A
batch is scored as presence matrix times landmark matrix times coefficients; the last two are multiplied once, which
leaves one row of coefficients per landmark n-gram. Scores are a softmax of the outputs with a fitted slope.

The fit uses a sample that is bounded in all, however many languages there are: the ``MAX_LANGS`` most frequent ones are learned, with ``PER_LANG`` rows
and ``FIT_CHARS`` characters of each, or the same share of ``ALL_ROWS`` and ``ALL_CHARS`` where that is less, texts of more than ``USUAL`` last; ``LANDMARKS`` of
these rows are landmarks. Every row is scored on its whole text. A null text, or one without letters, is ``und`` with score 0; without any labelled row all are ``und``.
Repeated and equal rows get equal predictions; of languages that tie the first by name is taken; an empty table gives an
empty result; existing columns ``lang_pred`` and ``score`` are replaced, others are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import held_out, spread_sample, table, up_to
from framequarry.llm.dense import cholesky, inverse
from framequarry.llm.textnum import mix

ORDERS = (1, 2, 3)
PER_LANG, LANDMARKS, RIDGE = 400, 160, 1e-3
USUAL, FIT_CHARS = 20_000, 8_000_000
MAX_LANGS, ALL_ROWS, ALL_CHARS = 256, 20_000, 32_000_000
_BITS = 40
_LOW = np.uint64((1 << _BITS) - 1)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (40-bit hashes) of each text, and the text each belongs to, sorted by text."""
    low = [t.lower() for t in texts]
    n = np.array([len(t) for t in low], np.int64)
    cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(low), dtype=np.uint64), n)
    out, v = [], np.zeros(len(cp), np.uint64)
    for k in range(max(ORDERS)):
        m = len(cp) - k
        if m <= 0:
            break
        v = v[:m] * np.uint64(0x110000) + cp[k:]
        if k + 1 in ORDERS:
            ok = row[:m] == row[k:]
            out.append(np.unique((row[:m][ok] << np.uint64(_BITS)) | (mix(v[ok] + np.uint64((k + 1) << 60)) & _LOW)))
    both = np.sort(np.concatenate(out)) if out else np.zeros(0, np.uint64)
    return both & _LOW, (both >> np.uint64(_BITS)).astype(np.int64)


class KernelModel:
    """langs, sorted landmark n-grams, their coefficients (n-grams x languages), bias and softmax slope."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        order = np.argsort([self.langs.index(x) for x in langs], kind="stable")
        per = max(1, LANDMARKS // len(self.langs))
        at = np.concatenate([order[np.array(langs)[order] == x][:per] for x in self.langs])[:LANDMARKS]
        value, row = grams([texts[i] for i in at])
        self.vocab = np.unique(value)
        marks = np.zeros((len(at), len(self.vocab)), np.float32)
        marks[row, np.searchsorted(self.vocab, value)] = 1
        norm = np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))
        marks /= norm
        k_zz = (marks @ marks.T).astype(np.float64)
        # Any root of the inverse gives the same kernel; the Cholesky factor is the cheapest.
        # Near copies among the landmarks make the matrix singular to rounding; the addition keeps its pivots positive.
        root = inverse(cholesky(k_zz + 1e-3 * np.eye(len(k_zz)))).T
        z = self._kernel(texts, marks) @ root
        z1 = np.hstack([z, np.ones((len(z), 1))])
        penal = np.eye(z1.shape[1]) * RIDGE * len(z)
        penal[-1, -1] = 1e-9
        coef = inverse(z1.T @ z1 + penal) @ (z1.T @ y)
        self.weights = (marks.T @ (root @ coef[:-1])).astype(np.float32)
        self.bias = coef[-1].astype(np.float32)
        f, true = z1 @ coef, y.argmax(1)
        self.slope = min((0.5 * 1.5**i for i in range(10)), key=lambda a: -np.log(self._soft(a * f)[np.arange(len(f)), true] + 1e-12).mean())

    @staticmethod
    def _soft(f: np.ndarray) -> np.ndarray:
        e = np.exp(f - f.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def _kernel(self, texts: list[str], marks: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), len(marks)))
        for i in range(0, len(texts), 64):
            value, row = grams(texts[i : i + 64])
            n = np.bincount(row, minlength=len(texts[i : i + 64]))
            j = np.minimum(np.searchsorted(self.vocab, value), len(self.vocab) - 1)
            hit = self.vocab[j] == value
            here = np.zeros((len(n), len(self.vocab)), np.float32)
            here[row[hit], j[hit]] = 1
            out[i : i + 64] = here @ marks.T / np.sqrt(np.maximum(n, 1))[:, None]
        return out

    def outputs(self, texts: list[str]) -> np.ndarray:
        value, row = grams(texts)
        n = np.bincount(row, minlength=len(texts))
        j = np.minimum(np.searchsorted(self.vocab, value), len(self.vocab) - 1)
        hit = self.vocab[j] == value
        j, row = j[hit], row[hit]
        # The sparse presence matrix times the coefficients: sums over each text's run of rows.
        here = np.bincount(row, minlength=len(texts))
        first, f = np.cumsum(here) - here, np.zeros((len(texts), len(self.langs)))
        full = here > 0
        if full.any():
            f[full] = np.add.reduceat(self.weights[j], first[full], axis=0)
        return f / np.sqrt(np.maximum(n, 1))[:, None] + self.bias

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        p = self._soft(self.slope * self.outputs(texts))
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def fit_language_model(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> KernelModel | None:
    """Fits on rows of ``labelled`` with letters, within the bounds above; of languages that are equally frequent the first by name are taken."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & (F.length(text) <= FIT_CHARS))
    found = labelled.where(F.col(lang).isNotNull()).groupBy(lang).agg(F.count("*").alias("n")).orderBy(F.desc("n"), lang).limit(MAX_LANGS + 1).collect()
    if len(found) > MAX_LANGS:
        rows = rows.where(F.col(lang).isin([r[lang] for r in found[:MAX_LANGS]]))
    many = max(1, min(len(found), MAX_LANGS))
    order = F.xxhash64(key, text)
    sample = spread_sample(rows.select(key, text, lang), F.col(lang), min(PER_LANG, ALL_ROWS // many), order)
    picked = up_to(sample, F.col(lang), text, order, USUAL, min(FIT_CHARS, ALL_CHARS // many)).orderBy(lang, order).collect()
    return KernelModel([r[text] for r in picked], [r[lang] for r in picked]) if picked else None


def identify_language(df: DataFrame, model: KernelModel | None, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``lang_pred`` and ``score``; existing columns of these names are replaced."""
    keep = [c for c in df.columns if c not in (text, "lang_pred", "score")]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            col = b.column(b.schema.names.index(text))
            n = b.num_rows
            letters = pc.fill_null(pc.match_substring_regex(col, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            pred, score = np.full(n, -1), np.zeros(n)
            at = np.flatnonzero(letters) if m else np.zeros(0, int)
            size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)[at]
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // (1 << 20), prepend=0)) if len(at) else []
            for part in np.split(at, cuts):
                if len(part):
                    pred[part], score[part] = m.predict(col.take(pa.array(part)).to_pylist())
            names = [*(m.langs if m else []), "und"]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.names.index(c)) for c in keep), pa.array([names[i] for i in pred], pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    schema = df.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    for f in schema.fields:
        f.nullable = True
    return df.select(*keep, text).mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~held_out(F.col("doc_id"))))
    out = identify_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
