"""Queries that have SQL, against DuckDB on the driver's smallest tables; and that every query of the ten returns its rows."""

import os

import duckdb
import pandas as pd
import pytest

from framequarry.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables aren't here")


def rows(df):
    return sorted(tuple("NULL" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, DIR).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"op1_packing"}))
def test_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = QUERIES[name](spark, DIR)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
