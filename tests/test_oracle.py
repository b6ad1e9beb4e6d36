"""Every query with SQL against DuckDB on the driver's smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from framequarry.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def rows(df):
    def norm(v):
        return "NULL" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(map(norm, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, DIR).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_hash_shard_equals_zlib(spark):
    import zlib

    got = QUERIES["shard_crc32"](spark, DIR).collect()
    assert all(r.shard == zlib.crc32(str(r.doc_id).encode()) % 8 for r in got)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
