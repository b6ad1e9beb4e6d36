"""Each operator against brute force, and on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from framequarry.llm import decontamination, jaccard, language_id, packing, perplexity, pii, quality, sharding, toxicity, url_filter
from framequarry.llm.common import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "x"), (903, "x"), (None, "no id here"), (904, "é" * 30000)]


def test_held_out_is_crc(spark):
    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


# Packing


def test_packing_round_trip(docs, prose):
    rows = [(i, prose(5 + 37 * i % 700, i)) for i in range(60)] + [(500, prose(9000, 5))] + ODD
    out = packing.pack_documents(docs(rows).withColumn("offset", F.lit(1)), packing.tokenizer_path()).collect()
    cache = packing.WordCache(packing.tokenizer_path())
    want = Counter((d, tuple([*np.frombuffer(cache.ids(t or ""), "<u4").tolist(), 2])) for d, t in rows)
    by, seqs = defaultdict(list), defaultdict(list)
    for r in out:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        by[r.doc_id, r.doc_tokens].append(r)
        seqs[r.sequence_id].append(r)
    for (d, n), pieces in by.items():
        copies = sum(k for (i, ids), k in want.items() if i == d and len(ids) == n)
        pieces.sort(key=lambda r: r.start)
        assert sum(r.length for r in pieces) == n * copies
        whole = [x for r in pieces[::copies] for x in r.ids]
        assert (d, tuple(whole)) in want
    for pieces in seqs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert sum(sum(r.length for r in p) for p in seqs.values()) > 0.5 * 4096 * len(seqs)


def test_packing_empty(docs):
    assert packing.pack_documents(docs([]), packing.tokenizer_path()).count() == 0


# URL filter


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3 :]
    m = re.match(r"[^/?#]*", rest)
    host, path = m[0].translate(LOW), re.match(r"[^?#]*", rest[m.end() :])[0]
    fit = [(r, v) for v, r in url_filter.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fit, key=lambda x: len(x[0]), default=None)


def test_url_rules(spark):
    urls = ["http://A.Example.com/en/1", "http://www.example.com/en/1", "x://www.example.com/EN/1", "http://a.net/es/1?x=/fr/", "http://anet/es/", "https://b.net/de", "http://x.com", "http://x.com?y", "nothing", None, "://", "a://b://c/d", "http://b.net/fr/\n2", "http://q.org#/es/"]
    out = url_filter.filter_urls(spark.createDataFrame([(i, u, "keep") for i, u in enumerate(urls)], "page_id long, url string, host string"), url_filter.RULES)
    got = {r.page_id: r for r in out.collect()}
    for i, u in enumerate(urls):
        host, path, rule = plain_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule[0] if rule else None), u
        assert got[i].verdict == (rule[1] if rule else "allow")
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), url_filter.RULES).count() == 0


def test_url_templates_block_bad_branches(spark):
    rows = [(f"http://h.org/good/{i}", 0) for i in range(30)] + [(f"http://h.org/bad/{i}", 1) for i in range(30)] + [(f"http://h.org/bad/x{i}", None) for i in range(5)] + [(f"http://h.org/new/{i}", None) for i in range(30)] + [("http://h.org/a/b/c/d/e/f/g/h", None)]
    got = {r.url: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "url string, bad int"), []).collect()}
    assert got["http://h.org/bad/x1"].verdict == "block" and got["http://h.org/bad/x1"].template == "/bad/*"
    assert {got[u].verdict for u in ("http://h.org/good/3", "http://h.org/new/3", "http://h.org/a/b/c/d/e/f/g/h")} == {"allow"}
    assert got["http://h.org/a/b/c/d/e/f/g/h"].template == "/a/b/c/d/e/f/g/h"


# N-gram Jaccard join


def plain_components(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return sorted(((d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)), key=str)


def near_rows(prose, n=60, seed=0):
    r, rows = random.Random(seed), []
    for i in range(n):
        w = prose(r.choice([3, 5, 6, 30, 200]), r.randint(0, 12)).split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice(["New", "other", "w%d" % i])
        rows.append((i + 1, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_jaccard_equals_brute_force(docs, prose, seed):
    rows = near_rows(prose, 120, seed) + ODD
    got = jaccard.near_duplicates(docs(rows).withColumn("n", F.lit(1))).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_components(rows)


def test_jaccard_blocks(docs, prose, monkeypatch):
    """No leaders and tiny blocks: the block stage alone has to find what is left."""
    monkeypatch.setattr(jaccard, "LEADERS", 0)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    base = prose(80, 3).split()
    rows = []
    for i in range(40):
        w = list(base)
        for k in range(3):
            w[(i * 7 + k * 25) % 80] = f"n{i}_{k}"
        rows.append((i, " ".join(w)))
    got = jaccard.near_duplicates(docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_components(rows)


def test_jaccard_empty(docs):
    assert jaccard.near_duplicates(docs([])).count() == 0


def test_components(spark):
    from framequarry.llm.common import Scratch

    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7), (200, 201)]
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}


# Decontamination


def plain_hits(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    win = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOW))
        for s in range(max(1, len(w) - 9) if w else 0):
            win[tuple(w[s : s + 10])].add(str(i))
    out = []
    for d, t in rows:
        w, hit, names = word.findall((t or "").translate(LOW)), set(), set()
        for k in {len(x) for x in win}:
            for s in range(len(w) - k + 1):
                if found := win.get(tuple(w[s : s + k])):
                    hit |= set(range(s, s + k))
                    names |= found
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_decontamination_equals_brute_force(spark, docs, prose, limit):
    items = [(i, prose(n, 50 + i)) for i, n in enumerate([40, 10, 11, 9, 3, 1, 25])] + [(7, prose(40, 50)), (8, None), (9, "?!"), (10, "é ß"), (11, "B2b")]
    rows = [(i, prose(60, i) + (" " + items[i % 7][1].upper() if i % 3 else "") + " " + prose(20, 99)) for i in range(25)] + [(30, "é,ß! b2B"), (31, items[0][1])] + ODD
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_windows(docs(rows).withColumn("w", F.lit(1)), bench, broadcast_bytes=limit).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, len(r.hit_items), hashlib.sha256(",".join(r.hit_items).encode()).hexdigest()) for r in found]
    assert sorted(got, key=str) == plain_hits(rows, items)


def test_decontamination_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontamination.find_windows(docs([(1, "a b")]), none).collect()] == [0]
    assert decontamination.find_windows(docs([]), none).count() == 0


# Quality


def junk(prose, i):
    return [prose(80, i).replace(" ", "*** "), prose(80, i).upper().replace(" ", "!! "), prose(80, i).replace(" ", " | ")][i % 3]


def test_quality_separates(spark, docs, prose):
    rows = [(i, junk(prose, i) if i % 4 == 0 else prose(60 + i % 50, i) + ".", None if i % 9 == 0 else "en", f"s{i % 5}") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 400, 2)] + [(9999, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    frame = docs(rows + [(900, None, None, None), (901, "", "en", "s")])
    out = quality.score_quality(frame.withColumn("kept", F.lit("clash")), quality.fit_quality(frame, labels)).collect()
    wrong = [r.doc_id for r in out if r.doc_id < 400 and r.kept != (r.doc_id % 4 != 0)]
    assert len(out) == 402 and len(wrong) <= 8


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.kept for r in quality.score_quality(docs([(1, "a")]), quality.fit_quality(docs([(1, "a")]), none)).collect()] == [True]
    assert quality.score_quality(docs([]), None).count() == 0


# Perplexity


def plain_base(t):
    words = WORD.findall(t or "")
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if tri[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(again)


def test_base_rules_equal_brute_force(docs):
    r = random.Random(4)
    rows = [(i, "".join(r.choice(["ab", "é", " ", "\n", "#", "\t", "c|d", "\x1c"]) for _ in range(r.randint(0, 120)))) for i in range(150)] + ODD
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in perplexity.judge(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(((d, *plain_base(t)) for d, t in rows), key=str)


def test_perplexity_bands(docs, prose):
    noise = random.Random(0)
    rows = [(i, prose(120, i), ["en", None][i % 2]) for i in range(120)] + [(500, " ".join("".join(noise.choices("zqxjkvw%$", k=8)) for _ in range(120)), "en")]
    got = {r.doc_id: r for r in perplexity.judge(docs(rows)).collect()}
    assert not got[500].kept and not got[500].base_failed and sum(got[i].kept for i in range(120)) >= 118
    assert perplexity.judge(docs([])).count() == 0


def test_model_groups_change_nothing(docs, prose, monkeypatch):
    rows = [(i, prose(70, i), ["en", "de", None][i % 3]) for i in range(30)]
    whole = sorted(perplexity.judge(docs(rows)).select("doc_id", F.round("log_ppl", 9)).collect())
    monkeypatch.setattr(perplexity, "BROADCAST_BYTES", 1)
    assert sorted(perplexity.judge(docs(rows)).select("doc_id", F.round("log_ppl", 9)).collect()) == whole


def test_kneser_ney_sums_to_one(spark, docs):
    from framequarry.llm.common import Scratch

    text = "the cat sat on the mat. the end"
    models = perplexity.fit_models(docs([(1, text)]), Scratch(spark))
    model = perplexity._load(*models, ["=en"])["=en"]
    data = np.frombuffer(text.encode(), np.uint8)
    gram = perplexity.grams(data, np.array([0, len(data)]))
    for history in (0, int(gram[5]) >> 6, 63 << 12):
        p = 2.0 ** model.logp((history << 6 | np.arange(64)) & ((1 << 24) - 1)).astype(float)
        assert abs(p.sum() - 1) < 1e-3


class PlainKneserNey:
    """Modified Kneser-Ney over tuples of symbols, straight from the definition."""

    def __init__(self, texts):
        self.count = {k: Counter() for k in range(1, 5)}
        for t in texts:
            s = (0, 0, 0, *perplexity.CLASS[np.frombuffer(t.encode(), np.uint8)].tolist())
            self.count[4].update(s[i - 3 : i + 1] for i in range(3, len(s)))
        for k in (3, 2, 1):
            self.count[k] = Counter(g[1:] for g in self.count[k + 1])
        self.d, self.total, self.freed = {}, {}, {}
        for k, c in self.count.items():
            n = [sum(v == j for v in c.values()) for j in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if all(n[1:]) else None
            self.d[k] = [0, *(min(j, max(0, j - (j + 1) * y * n[j + 1] / n[j])) for j in (1, 2, 3))] if y else [0, 0.5, 0.7, 0.9]
            self.total[k], self.freed[k] = Counter(), Counter()
            for g, v in c.items():
                self.total[k][g[:-1]] += v
                self.freed[k][g[:-1]] += self.d[k][min(v, 3)]

    def p(self, g):
        if not g:
            return 1 / 64
        k, h, c = len(g), g[:-1], self.count[len(g)].get(g, 0)
        if h not in self.total[k]:
            return self.p(g[1:])
        return (c - self.d[k][min(c, 3)]) / self.total[k][h] + self.freed[k][h] / self.total[k][h] * self.p(g[1:])


def test_perplexity_equals_brute_force(docs, prose):
    rows = [(i, prose(12, i, 30) + (" é!" if i % 4 else "\n"), ["en", "de", None][i % 3]) for i in range(24)] + [(50, "zq 9 rare", "de"), (51, "", "en"), (52, None, "fr")]
    models = {k: PlainKneserNey([t or "" for _, t, x in rows if x == k]) for k in ("en", "de", None)}
    pool = PlainKneserNey([t or "" for _, t, _ in rows])
    for r in perplexity.judge(docs(rows), keep=("doc_id",)).collect():
        t, lang = next((t or "", x) for d, t, x in rows if d == r.doc_id)
        words = list(WORD.finditer(t))
        if not words:
            assert r.log_ppl is None
            continue
        data = t.encode()
        s = (0, 0, 0, *perplexity.CLASS[np.frombuffer(data, np.uint8)].tolist())
        starts = [len(t[: m.start()].encode()) for m in words] + [len(data)]
        bits = 0.0
        for a, b in zip(starts, starts[1:]):
            own, all_ = (np.prod([m.p(s[i : i + 4]) for i in range(a, b)]) for m in (models[lang], pool))
            bits -= np.log2(0.8 * own + 0.2 * all_)
        assert abs(bits / len(words) - r.log_ppl) < 1e-3, r.doc_id


def test_perplexity_names_clash(docs):
    with pytest.raises(ValueError):
        perplexity.judge(docs([(1, "a")]).withColumn("low", F.lit(1)), keep=("doc_id", "low"))


# PII


def plain_pii(t):
    e, i, c, p = (re.compile(x) for x in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out = [(0, *m.span()) for m in e.finditer(t)] + [(1, *m.span()) for m in i.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in c.finditer(t) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [(3, *m.span()) for m in p.finditer(t) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_patterns():
    r = random.Random(2)
    for n in range(20000):
        t = "".join(r.choice("a@.1234 -+()_é" if n % 2 else "ab@.-_@. 9") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(t) == plain_pii(t), t


LETTER = "Call +1 (988) 555-2485 now, card 4041894974608795. Mail bob.42@mail8.example.com. "


def test_field_labels_second_mentions(docs):
    text = LETTER + "Later bob.42@mail8 wrote, and (988) 555-2485 rang. Room 12 of 300."
    clean = "Room 12 of 300, see 555-2485 or 10.5 in 2024."
    frame = docs([(i, LETTER) for i in range(20)] + [(50, text), (51, clean)] + ODD)
    got = {r.doc_id: [(s.kind, text[s.start : s.end], s.base) for s in r.spans] for r in pii.find_private(frame.withColumn("spans", F.lit(0)), pii.fit_field(frame)).collect() if r.doc_id in (50, 51)}
    assert ("email", "bob.42@mail8", False) in got[50] and ("phone", "555-2485", False) in got[50] and len(got[50]) == 5
    assert got[51] == []


def test_redaction(docs):
    out = {r.doc_id: r.text for r in pii.redact(docs([(1, LETTER), (2, None), (3, "é 10.0.0.1 ü")]), None).collect()}
    assert out == {1: "Call <PHONE> now, card <CARD>. Mail <EMAIL>. ".replace("<EMAIL>.", "<EMAIL>."), 2: None, 3: "é <IP> ü"}


# Sharding


def test_shards_are_contiguous_and_balanced(docs, prose):
    rows = [(i * 7 % 501, prose(i * 13 % 90, i)) for i in range(400)] + [(77, "hot")] * 300 + ODD
    frame = docs(rows).select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.lit("x").alias("shard"))
    got = sorted(sharding.byte_balanced_shards(frame, "size", ["doc_id"], 8).collect(), key=lambda r: (r.shard, r.slot))
    assert len(got) == len(rows)
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    most, total = max(r.size for r in got), sum(r.size for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    for rows_of in by.values():
        assert [r.slot for r in rows_of] == list(range(len(rows_of)))
        assert abs(sum(r.size for r in rows_of) - total / 8) <= most
    assert sharding.byte_balanced_shards(frame.limit(0), "size", ["doc_id"], 8).count() == 0


# Toxicity and language


def test_toxicity_held_out(spark, docs, prose):
    bad = ["vex", "grub", "dolt"]
    r, rows, labels = random.Random(0), [], []
    for i in range(600):
        w = prose(60, i).split()
        if i % 3 == 0:
            for k in range(4):
                w[r.randrange(60)] = bad[(i // 3 + k) % 3].upper() + ","
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 3 == 0)))
    known = spark.createDataFrame([x for x in labels if x[0] < 400], "doc_id long, quality int, toxic int")
    frame = docs(rows + ODD)
    got = toxicity.score_toxicity(frame, toxicity.fit_toxicity(frame, known)).collect()
    assert len(got) == 607 and all(0 <= r.score <= 1 for r in got)
    fresh = [r for r in got if r.doc_id is not None and 400 <= r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in fresh) >= 0.97 * len(fresh)
    assert {r.predicted for r in got if r.doc_id in (900, 901, 902)} == {0}


def test_language_held_out(docs):
    r = random.Random(3)
    syllables = {"aa": ["th", "er", "ing"], "bb": ["sch", "ung", "ei"], "cc": ["ción", "ue", "ñ"]}
    rows = [(i, " ".join("".join(r.choices(syllables[k], k=3)) for _ in range(12)), k) for i in range(300) for k in [list(syllables)[i % 3]]]
    frame = docs(rows + [(i, t, None) for i, t in ODD] + [(950, "123 !?", "aa")])
    model = language_id.fit_language_model(frame.where(~held_out(F.col("doc_id"))))
    got = language_id.identify_language(frame.withColumn("score", F.lit(1)), model).collect()
    truth = {d: k for d, _, k in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth)
    assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902, 950)} == {"und"}
    assert language_id.identify_language(frame, None).select("lang_pred").distinct().collect()[0][0] == "und"


def test_jaccard_keeps_large_ids_beside_nulls(docs):
    big = 2**60 + 1
    got = {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs([(big, "a b c"), (None, "d e f"), (big + 1, "A b C")], 1)).collect()}
    assert got == {(big, big), (big + 1, big), (None, None)}


def test_jaccard_hot_leaders_change_nothing(docs, prose, monkeypatch):
    """One large group of near copies, dealt out in parts of two nodes."""
    monkeypatch.setattr(jaccard, "HOT", 2)
    base, rows = prose(150, 3).split(), []
    for i in range(60):
        w = list(base)
        w[(i * 7) % 150] = f"n{i}"
        rows.append((i, " ".join(w)))
    rows += near_rows(prose, 40, 5)[:40] + ODD
    rows = [(d if d is None or k < 60 else d + 2000, t) for k, (d, t) in enumerate(rows)]
    got = jaccard.near_duplicates(docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_components(rows)


def test_jaccard_reads_five_megabytes(docs):
    long = " ".join(f"w{i}" for i in range(700_000))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs([(1, long), (2, long + " end"), (3, "w1 w2")])).collect()}
    assert got == {1: (699_996, 1), 2: (699_997, 1), 3: (1, 3)}
