import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents frame of (doc_id, text) or (doc_id, text, lang, source) rows, in some partitions."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC).repartition(parts) if full else spark.createDataFrame([], DOC)

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic prose of n words; differs by seed."""
    import random

    def make(n, seed=0, vocabulary=400):
        r = random.Random(seed)
        words = ["".join(random.Random(i).choices("abcdefgh", k=2 + i % 6)) for i in range(vocabulary)]
        return " ".join(r.choice(words) for _ in range(n))

    return make
