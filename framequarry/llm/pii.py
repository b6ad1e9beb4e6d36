"""PII (6): base patterns, and a skip-chain conditional random field that makes entity labels consistent in a document.

Base spans come from fixed patterns and stay as they are. The field's nodes are the words that carry a digit or an
at sign; chain edges join such words that stand next to each other, skip edges join words of the same normalised form,
or the same seven or more last digits, or the same mail name, to the occurrence before them, however far away. Words
inside base spans are observed. Loopy sum-product message passing then labels the others by their marginals:

* A kind that has a pattern needs, beside a marginal of ``CERTAIN``, a chain of skip edges to an observed word of that kind:
  a second mention without its prefix, say. A number alone is no telephone number.
* A secret (``secret``: tokens, keys, passwords) has no pattern. Its words are labelled by shape (long, letters mixed with
  digits, without punctuation), by the cue word before them and by their other mentions; the marginal alone decides.

Weights (unary by word shape and cue, chain and skip by label pair) are fitted by pseudo-likelihood on a bounded sample:
``FIT_DOCS`` documents that have base spans or a cue, up to ``FIT_CHARS`` characters, texts of more than ``USUAL`` last. Labels there are the
base spans' and, for secrets, words of secret shape after a cue. While fitting, a random ``MASK`` of the neighbours'
labels and of the cues is hidden in each pass, so that neither the patterns nor the cues have to be there; unlabelled
repeats of labelled words are left out. All texts are searched whole, in time linear in their length; edges are as many as words.

Defined results: null or empty text has no spans; offsets count code points, the end is exclusive; repeated rows each get
their spans, ties (equal texts) the same ones; texts of any length are searched whole; an empty table gives an empty result, and a field
fitted on one only returns base spans; an existing column ``spans`` is replaced, other columns are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.llm.common import table, up_to
from framequarry.llm.textnum import slices

KINDS = ("email", "ip", "card", "phone", "secret")
SECRET = 4
FIT_DOCS, USUAL, FIT_CHARS = 1500, 20_000, 30_000_000
PASSES, DAMP, CERTAIN, MASK = 15, 0.5, 0.9, 0.4
#: The skip potential that a pair of equal labels has before fitting, which pulls it there.
TIE = 5.0
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))

#: The base patterns are fixed. A match can't begin inside a run of digits, which the guards in front say; they spare the retries.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NODE = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")
_OTHER = re.compile(r"[^a-z0-9]+")
#: Words that announce a secret, and what may stand between them and it.
_CUE = re.compile(r"(?i)(?:^|[^a-z])(?:api[_-]?key|access[_-]?key|secret|token|passw(?:or)?d|pwd|credential|bearer|key)[\"']?(?: ?[:=])? ?[\"'`]?$")
_CUES = r"(?i)(api[_-]?key|access[_-]?key|secret|token|passw(or)?d|pwd|credential|bearer|key)[\"']?(\s?[:=])?\s?[\"'`]?\S*[0-9]"
_CORE = re.compile(r"[A-Za-z0-9_+/=.-]*[A-Za-z0-9_+/=-]")
#: Marks around a word that aren't part of it.
_FRONT, _BACK = "\"'`[<({,;:=", "\"'`])>},;:.!?*&$%#|"

_HAS = np.zeros(256, bool)
_HAS[[0x40, *range(0x30, 0x3A)]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and then by start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            out.append((0, start, done))
        else:
            done = max(done, start)
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append((3, *m.span()))
    return out


class Graph:
    """Nodes of many texts with their shapes, observed labels and edges."""

    def __init__(self) -> None:
        self.span: list[tuple[int, int, int]] = []  # text, start, end
        self.shape: list[list[float]] = []
        self.seen: list[int] = []  # 0: not observed, else kind + 1
        self.cued: list[bool] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, at: int, text: str, base: list[tuple[int, int, int]]) -> None:
        spans = sorted((s, e, k) for k, s, e in base)
        starts, last, before, i = {}, None, {}, 0
        for order, m in enumerate(_WORD.finditer(text)):
            word = m[0]
            if not _NODE.search(word):
                continue
            while i < len(spans) and spans[i][1] <= m.start():
                i += 1
            kind = next((k + 1 for s, e, k in spans[i : i + 4] if s < m.end() and e > m.start()), 0)
            node = len(self.span)
            self.span.append((at, m.start(), m.end()))
            self.seen.append(kind)
            self.shape.append(shape(word))
            self.cued.append(kind == 0 and cued(text, m.start(), word))
            if last is not None and before[last] == order - 1:
                self.chain.append((last, node))
            before, last = {node: order}, node
            low = word.lower()
            flat = _OTHER.sub("", low)
            digits = "".join(_DIGITS.findall(low))
            keys = [("=", flat)] if len(flat) >= 5 else []
            keys += [("#", digits[-7:])] if len(digits) >= 7 else []
            keys += [("@", low.split("@")[0])] if "@" in low[1:] else []
            for key in keys:
                if key in starts and (not self.skip or self.skip[-1] != (starts[key], node)):
                    self.skip.append((starts[key], node))
                starts[key] = node


def core(word: str) -> tuple[int, int]:
    """Start and end of a word without the marks around it; what an equals sign or colon assigns is the core."""
    s, e = 0, len(word)
    while s < e and word[e - 1] in _BACK:
        e -= 1
    for mark in ("=", ":"):
        at = word.find(mark, s, e - 1)
        if at >= 0 and "@" not in word and word[s:at].strip(_FRONT).replace("_", "").replace("-", "").isalpha():
            s = at + 1
    while s < e and word[s] in _FRONT:
        s += 1
    return s, e


def cued(text: str, start: int, word: str) -> bool:
    """Whether a cue word stands right before the word's core."""
    at = start + core(word)[0]
    return _CUE.search(text[max(0, at - 24) : at]) is not None


def shape(word: str) -> list[float]:
    n = len(_DIGITS.findall(word))
    dots, letters = word.count("."), sum(c.isalpha() for c in word)
    out = [1.0, "@" in word, "+" in word, "(" in word, "-" in word, dots == 0, 1 <= dots <= 2, dots == 3, dots > 3, letters == 0, 0 < letters <= n, letters > n]
    s, e = core(word)
    plain = _CORE.fullmatch(word, s, e) is not None and letters > 0 and n > 0
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(word[s:e], word[s + 1 : e])) if plain else 0
    out += [plain and e - s >= 16, plain and e - s >= 28, plain and 6 <= e - s < 16, turns >= 4, turns >= 8, plain and "@" not in word]
    return [*map(float, out), *(float(a <= n <= b) for a, b in ((0, 0), (1, 3), (4, 6), (7, 9), (10, 12), (13, 19), (20, 1 << 30)))]


#: Features after those of the shape: a cue before the word, and one before a word of secret shape.
_LONG, N_SHAPE = 12, len(shape(""))


def features(graph: Graph) -> np.ndarray:
    x = np.array(graph.shape, float).reshape(len(graph.seen), N_SHAPE)
    cue = np.array(graph.cued, float).reshape(-1, 1)
    return np.hstack([x, cue, cue * x[:, _LONG : _LONG + 1]])


N_LABELS = len(KINDS) + 1


def _soft(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class SkipChainField:
    """Log potentials: unary (shapes x labels), chain (labels x labels, directed) and skip (labels x labels, symmetric)."""

    def __init__(self, graph: Graph, rounds: int = 600):
        x = features(graph)
        y = np.array(graph.seen, int)
        y[(y == 0) & (x[:, -1] > 0)] = SECRET + 1
        hot = np.eye(N_LABELS)[y]
        self.unary, self.chain, self.skip = np.zeros((x.shape[1], N_LABELS)), np.zeros((N_LABELS, N_LABELS)), TIE * np.eye(N_LABELS)
        self.empty = not len(y)
        a, s = np.array(graph.chain, int).reshape(-1, 2), np.array(graph.skip, int).reshape(-1, 2)
        # A word that no pattern labels but that repeats a labelled one may be either: it doesn't count as an example.
        sure = (y > 0) | ~tied(graph, y).any(1)
        a, s = a[sure[a].all(1)], s[sure[s].all(1)]
        around = lambda e, to, of, on: _gather(len(y), e[:, to], hot[e[:, of]] * on[e[:, of]])
        rng = np.random.default_rng(0)
        for _ in range(rounds if len(y) else 0):
            known = (rng.random((len(y), 1)) >= MASK).astype(float)
            seen = x.copy()
            seen[:, N_SHAPE:] *= rng.random((len(y), 1)) >= MASK
            left, right, far = around(a, 1, 0, known), around(a, 0, 1, known), around(s, 1, 0, known) + around(s, 0, 1, known)
            err = (hot - _soft(seen @ self.unary + left @ self.chain + right @ self.chain.T + far @ self.skip)) * sure[:, None]
            step = 2.0 / len(y)
            self.unary += step * (seen.T @ err) - 1e-3 * self.unary
            self.chain += step * (left.T @ err + err.T @ right) - 1e-3 * self.chain
            g = far.T @ err
            self.skip += step * (g + g.T) / 2 - 1e-3 * (self.skip - TIE * np.eye(N_LABELS))

    def marginals(self, graph: Graph) -> np.ndarray:
        """Label distributions of the nodes by loopy belief propagation; observed nodes are clamped."""
        n, seen = len(graph.seen), np.array(graph.seen, int)
        z = features(graph) @ self.unary
        z[seen > 0] = -50
        z[np.flatnonzero(seen), seen[seen > 0]] = 50
        edges = np.array([*graph.chain, *graph.skip], int).reshape(-1, 2)
        k = len(graph.chain)
        pot = np.concatenate([np.repeat(self.chain[None], k, 0), np.repeat(self.skip[None], len(graph.skip), 0)])
        src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        both = np.concatenate([pot, pot.transpose(0, 2, 1)])
        msg, m = np.zeros((len(src), N_LABELS)), len(edges)
        for _ in range(PASSES if m else 0):
            b = z + _gather(n, dst, msg)
            out = b[src] - np.concatenate([msg[m:], msg[:m]])  # without what came from there
            new = out[:, :, None] + both
            top = new.max(1)
            new = top + np.log(np.exp(new - top[:, None, :]).sum(1))
            msg = DAMP * msg + (1 - DAMP) * (new - new.max(1, keepdims=True))
        return _soft(z + _gather(n, dst, msg))


def _gather(n: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.column_stack([np.bincount(at, weights=rows[:, j], minlength=n) for j in range(rows.shape[1])]) if len(at) else np.zeros((n, N_LABELS))


def tied(graph: Graph, labels: np.ndarray) -> np.ndarray:
    """For each node and kind, whether skip edges lead to a node that ``labels`` names so. Edges run forward in order."""
    out = np.zeros((len(graph.seen), N_LABELS), bool)
    out[np.arange(len(out)), labels] = True
    out[:, 0] = False
    for i, j in graph.skip:
        out[j] |= out[i]
    for i, j in reversed(graph.skip):
        out[i] |= out[j]
    return out


def search(texts: list[str], field: SkipChainField | None) -> list[list[tuple[int, int, int, bool]]]:
    """All spans (kind, start, end, base) of each text, by kind and then by start."""
    found = [base_spans(t) for t in texts]
    out = [[(k, s, e, True) for k, s, e in b] for b in found]
    if field is None or field.empty:
        return out
    graph = Graph()
    for i, (t, b) in enumerate(zip(texts, found)):
        graph.add(i, t, b)
    if graph.seen:
        p, seen = field.marginals(graph), np.array(graph.seen)
        best = p.argmax(1)
        ties = tied(graph, seen)
        of_kind = ties[np.arange(len(best)), best] | (best == SECRET + 1)
        for node in np.flatnonzero((seen == 0) & (best > 0) & (p.max(1) >= CERTAIN) & of_kind):
            i, s, e = graph.span[node]
            a, b = core(texts[i][s:e])
            s, e = s + a, s + b
            if s < e and not any(x < e and y > s for _, x, y in found[i]):
                out[i].append((int(best[node]) - 1, s, e, False))
    return [sorted(x) for x in out]


def fit_field(df: DataFrame, text: str = "text", key: str = "doc_id") -> SkipChainField:
    """Fits on at most FIT_DOCS documents that may have base spans or cues, with FIT_CHARS characters in all.

    Documents are drawn by a hash of the row before a pattern looks at any text: a first draw tells what share of them has
    something, and the second one is as large as FIT_DOCS of these need.
    """
    order = F.xxhash64(key, text)
    rows = df.where(F.length(text) <= FIT_CHARS).select(key, text, ((order / F.lit(float(2**63)) + 1) / 2).alias("fq_draw"))
    has = F.col(text).rlike(r"@|\+[0-9]|[0-9][\x20-]?([0-9][\x20-]?){11}[0-9]|[0-9]\.[0-9]") | F.col(text).rlike(_CUES)
    total = rows.count()
    n, hits = rows.where(F.col("fq_draw") <= 4.0 * FIT_DOCS / max(1, total)).agg(F.count("*"), F.count_if(has)).first()
    share = 1.2 * FIT_DOCS / max(1.0, total * max(1, hits) / max(1, n))
    graph = Graph()
    drawn = rows.where(F.col("fq_draw") <= share).where(has).orderBy("fq_draw", key).limit(FIT_DOCS)
    for i, r in enumerate(up_to(drawn, F.lit(1), text, F.col("fq_draw"), USUAL, FIT_CHARS).orderBy("fq_draw", key).collect()):
        graph.add(i, r[text], base_spans(r[text]))
    return SkipChainField(graph)


def find_private(df: DataFrame, field: SkipChainField | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, by default) with ``spans``: an array of kind, start, end and base."""
    keep = [c for c in (df.columns if keep is None else keep) if c != "spans"]
    shared = df.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for b in batches:
            col = b.column(b.schema.names.index(text))
            spans: list = [[]] * b.num_rows
            for i, j, data, off in slices(col):
                c = np.concatenate([[0], np.cumsum(_HAS[data])])
                at = i + np.flatnonzero(c[off[1:]] > c[off[:-1]])
                got = search(col.take(pa.array(at)).to_pylist(), shared.value)
                for k, x in zip(at, got):
                    spans[k] = [{"kind": KINDS[a], "start": s, "end": e, "base": f} for a, s, e, f in x]
            arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.names.index(c)) for c in keep), pa.array(spans, arrow)], names=[*keep, "spans"])

    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("spans", SPAN)])
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def redact(df: DataFrame, field: SkipChainField | None, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in angle brackets; overlapping spans become one."""
    shared, names = df.sparkSession.sparkContext.broadcast(field), df.columns

    def run(batches):
        for b in batches:
            pos = b.schema.names.index(text)
            col, texts = b.column(pos), b.column(pos).to_pylist()
            for i, j, data, off in slices(col):
                c = np.concatenate([[0], np.cumsum(_HAS[data])])
                at = i + np.flatnonzero(c[off[1:]] > c[off[:-1]])
                for k, x in zip(at, search([texts[k] for k in at], shared.value)):
                    out, done = [], 0
                    for s, e, kind in sorted((s, e, a) for a, s, e, _ in x):
                        if s >= done:
                            out += [texts[k][done:s], f"<{KINDS[kind].upper()}>"]
                        done = max(done, e)
                    texts[k] = "".join(out) + texts[k][done:] if x else texts[k]
            yield pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field(pos).type) if q == pos else b.column(q) for q in range(len(names))], names=names)

    return df.mapInArrow(run, df.schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_private(docs, fit_field(docs), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    line = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS[:SECRET]]
    found = out.select("doc_id", "spans", base.alias("base"))
    return found.select(
        "doc_id", *counts, F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
