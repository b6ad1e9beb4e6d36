"""What the bounded samples of the fits hold."""

from pyspark.sql import functions as F

from framequarry.llm import language_id, quality, toxicity
from framequarry.llm.common import up_to


def test_sample_sizes_of_quality():
    assert (quality.PER_CLASS, quality.POOL) == (1200, 3000)


def test_toxicity_learns_from_texts_of_40000_characters(spark, docs, prose):
    long = {i: (prose(9000, i) + " vile slur")[-40_000:] for i in range(6)}
    assert all(len(t) > 30_000 for t in long.values())
    rows = [(i, t) for i, t in long.items()] + [(10 + i, prose(50, 50 + i)) for i in range(6)]
    labels = spark.createDataFrame([(i, int(i < 10)) for i, _ in rows], "doc_id long, toxic int")
    assert len(toxicity.fit_toxicity(docs(rows), labels).keys)


def test_long_texts_fill_what_is_left_of_a_budget(spark):
    sizes = {0: 10, 1: 10, 2: 900, 3: 300, 4: 10, 5: 5000}
    rows = spark.createDataFrame([(i, "k", "x" * n) for i, n in sizes.items()] + [(9, "other", "y" * 700)], "id long, k string, t string")
    pick = lambda budget: sorted(r.id for r in up_to(rows, F.col("k"), "t", F.xxhash64("id"), 50, budget).collect())
    assert pick(10_000) == [0, 1, 2, 3, 4, 5, 9]
    assert pick(1300) == [0, 1, 2, 3, 4, 9]
    assert pick(500) == [0, 1, 3, 4]
    assert pick(0) == []


def test_a_language_of_long_texts_only_is_learned(spark, docs):
    def long(words, i):
        return " ".join(words[(j * (i + 3)) % len(words)] for j in range(6000))

    one, two = "the of and with from this that house water".split(), "der und mit aus dieser haus wasser nicht ein".split()
    rows = [(i, long(one, i) if i < 6 else " ".join(two * 3), "en" if i < 6 else "de") for i in range(12)]
    assert len(rows[0][1]) > language_id.USUAL
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_language_model(df)
    assert sorted(model.langs) == ["de", "en"]
    got = {r.doc_id: r.lang_pred for r in language_id.identify_language(df.select("doc_id", "text"), model).collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_a_repeated_id_is_one_row_of_the_sample(spark, docs, prose):
    """Ten thousand rows of one labelled id, alike and not, leave the other labelled rows in the sample."""
    from framequarry.llm.common import labelled_sample

    rows = [(i, prose(30, i)) for i in range(60)] + [(60, prose(30, 60))] * 6000 + [(61, prose(30, 1000 + i % 40)) for i in range(4000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(62)], "doc_id long, toxic int")
    got = labelled_sample(docs(rows), labels, "toxic", 40, 1000, 100_000, extra=("lang",))
    assert sorted(r.doc_id for r in got) == list(range(62)) and {r.lang for r in got} == {"en"}
    assert [r.doc_id for r in got] == [r.doc_id for r in labelled_sample(docs(rows[::-1]), labels, "toxic", 40, 1000, 100_000, extra=("lang",))]
    model = toxicity.fit_toxicity(docs(rows), labels)
    alone = toxicity.fit_toxicity(docs([*rows[:61], min((r for r in rows if r[0] == 61), key=lambda r: [x.text for x in got if x.doc_id == 61] != [r[1]])]), labels)
    assert model.keys.tolist() == alone.keys.tolist() and model.bias == alone.bias
