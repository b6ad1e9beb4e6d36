"""Texts of five million characters, empty tables, repeated labels and clashing names where the operators' own tests lack them."""

import pytest
from pyspark.sql import functions as F

from framequarry.llm import decontamination, language_id, perplexity, sharding, toxicity, url_filter

LONG = 5_000_000


def test_perplexity_of_a_long_text(spark, docs, prose):
    body = " ".join(f"{w}{i % 97}" for i, w in enumerate(prose(900_000, 1).split()))[:LONG]
    rows = [(1, body + " tail\ntail"), (2, prose(200, 2)), (3, None)]
    got = {r.doc_id: r for r in perplexity.judge(docs(rows)).collect()}
    assert got[1].n_words == len(rows[0][1].split()) and got[1].n_dup_lines == 0 and got[1].log_ppl is not None
    assert got[3].n_words == 0 and not got[3].kept


def test_shards_of_a_long_text(spark, docs):
    df = docs([(i, "x" * (LONG if i == 3 else 9)) for i in range(20)]).select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"))
    got = sharding.byte_balanced_shards(df, "size", ["doc_id"], 4).collect()
    assert sorted(r.doc_id for r in got) == list(range(20)) and {r.shard for r in got} <= set(range(4))
    for k in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))


@pytest.fixture(scope="module")
def toxic(spark, docs, prose):
    rows = [(i, prose(40, i) + (" vile slur" if i < 20 else "")) for i in range(40)]
    return rows, spark.createDataFrame([(i, int(i < 20)) for i in range(40)], "doc_id long, toxic int")


def test_toxicity_of_a_long_text_is_of_all_of_it(spark, docs, prose, toxic):
    rows, labels = toxic
    model = toxicity.fit_toxicity(docs(rows), labels)
    base = prose(700_000, 99)[:LONG]
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs([(1, base), (2, base + " vile slur"), (3, "vile slur"), (4, None)]), model).collect()}
    assert got[2] > got[1] and got[3] > got[4]


def test_toxicity_without_rows_or_with_repeated_labels_and_clashing_names(spark, docs, toxic):
    rows, labels = toxic
    assert toxicity.score_toxicity(docs([]), toxicity.fit_toxicity(docs([]), labels.limit(0))).collect() == []
    none = toxicity.score_toxicity(docs(rows[:2]), toxicity.fit_toxicity(docs(rows), labels.limit(0))).collect()
    assert [r.predicted for r in none] == [0, 0]
    once, thrice = (toxicity.fit_toxicity(docs(rows), x) for x in (labels, labels.unionByName(labels).unionByName(labels)))
    assert once.keys.tolist() == thrice.keys.tolist() and once.bias == thrice.bias
    clash = docs(rows[:3]).withColumns({"score": F.lit("x"), "predicted": F.lit("y"), "other": F.lit(1)})
    out = toxicity.score_toxicity(clash, once)
    assert dict(out.dtypes)["score"] == "double" and [r.other for r in out.collect()] == [1, 1, 1]


def test_languages_of_a_long_text_and_of_no_rows(spark, docs):
    one, two = "the of and with from this that house water ", "der und mit aus dieser haus wasser nicht ein "
    df = spark.createDataFrame([(i, (one if i % 2 else two) * 3, "en" if i % 2 else "de") for i in range(20)], "doc_id long, text string, lang string")
    model = language_id.fit_language_model(df)
    long = (two * (LONG // len(two)))[:LONG]
    got = {r.doc_id: r.lang_pred for r in language_id.identify_language(docs([(1, long), (2, one), (3, "123"), (4, None)]), model).collect()}
    assert got == {1: "de", 2: "en", 3: "und", 4: "und"}
    assert language_id.identify_language(docs([]), model).collect() == []
    assert [r.lang_pred for r in language_id.identify_language(docs([(1, one)]), None).collect()] == ["und"]


def test_windows_in_a_long_text_and_in_no_documents(spark, docs, prose):
    item = " ".join(f"item{i}" for i in range(12))
    items = spark.createDataFrame([("a", item), ("b", None)], "item_id string, text string")
    body = prose(800_000, 5)[: LONG - 200]
    (row,) = decontamination.find_windows(docs([(1, body + " " + item)]), items).collect()
    assert row.n_hit == 12 and row.hit_items == ["a"] and row.n_words == len(body.split()) + 12
    assert decontamination.find_windows(docs([]), items).collect() == []


def test_a_long_url(spark):
    rows = [("http://h.net/es/" + "a" * LONG,), ("http://h.net/" + "b" * LONG,)]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "url string"), url_filter.RULES).select(F.length("path").alias("n"), "rule", "verdict").collect()
    assert sorted((r.n, r.rule, r.verdict) for r in got if r.rule) == [(LONG + 4, "net/es/", "block")] and sorted(r.n for r in got) == [LONG + 1, LONG + 4]
