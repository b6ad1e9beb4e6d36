"""Each stage on nulls, empty and very long texts, repeats, clashing columns and no rows at all."""

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve"), (2, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_and_none(spark, docs, prose, folder, name, stage):
    good = [(i, prose(60, i) + "." if i % 2 else prose(60, i).replace(" ", "$$ ")) for i in range(40)]
    odd = [(50, None), (51, ""), (52, "\n"), (53, "twice"), (53, "twice"), (None, "no id"), (54, "long word " * 550_000)]
    frame = docs(good + odd).withColumn("spans", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("start", F.lit(2))
    out = stage(spark, frame, folder)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert set(ids) <= {r[0] for r in good + odd}
    if name != corpus_pipeline.STAGES[-1][0]:
        assert tuple(out.columns) == corpus_pipeline.COLUMNS
    if name == "n-gram Jaccard join":
        assert sorted(ids, key=str) == sorted({r[0] for r in good + odd}, key=str)
    elif name in ("benchmark decontamination", "PII"):
        assert sorted(ids, key=str) == sorted((r[0] for r in good + odd), key=str)
    elif name == "packing":
        assert set(ids) == {r[0] for r in good + odd} and out.agg(F.sum("length")).first()[0] > 1_000_000
    assert stage(spark, docs([]), folder).count() == 0


def test_smallest_id_stays_whatever_its_sign(spark, docs, prose):
    text = prose(60, 1)
    rows = [(5, text), (-3, text + " more"), (-20, text + " other"), (2**62, text), (7, "else")]
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs(rows), "").collect()) == [-20, 7]
    named = spark.createDataFrame([("b", text, "en", "s", 1), ("a!", text, "en", "s", 1), ("a", text, "en", "s", 1)], "doc_id string, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.one_of_each_group(spark, named, "").collect()] == ["a"]
