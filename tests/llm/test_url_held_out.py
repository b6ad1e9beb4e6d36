"""The tree against the host's share on labels that it hasn't seen, and hosts with both verdicts."""

import os
import zlib

import pytest
from pyspark.sql import functions as F

from framequarry.llm import url_filter
from framequarry.llm.queries import QUERIES

DIR = "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables aren't here")


def test_held_out_templates_are_told_apart_better_than_by_their_host(spark):
    """A third of the (host, first segment) groups lose their labels; block and allow of their pages are then predicted."""
    pages = QUERIES["op2_url_filter"](spark, DIR).select("page_id", "host", "path", "rule", "verdict").collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    truth = {r.page_id: int(r.verdict == "block") for r in pages if r.rule}
    group = {r.page_id: (r.host, r.path.split("/")[1] if "/" in r.path else "") for r in pages}
    hidden = {p for p in truth if zlib.crc32("/".join(group[p]).encode()) % 3 == 1}
    rows = [(p, u, truth[p] if p in truth and p not in hidden else None) for p, u in urls.items()]
    got = {r.page_id: r.verdict == "block" for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, bad int"), []).collect()}
    shares: dict = {}
    for p, y in truth.items():
        if p not in hidden:
            shares.setdefault(group[p][0], []).append(y)
    of_host = {p: sum(s) / len(s) >= url_filter.REJECT if (s := shares.get(group[p][0])) else False for p in hidden}
    tested = [p for p in hidden if group[p][0] in shares]
    right = lambda guess: sum(guess[p] == bool(truth[p]) for p in tested) / len(tested)
    hit = sum(got[p] and truth[p] for p in tested)
    precision, recall = hit / max(1, sum(got[p] for p in tested)), hit / sum(truth[p] for p in tested)
    print("HELD", len(tested), right(got), right(of_host), precision, recall)
    assert len(tested) > 150 and right(got) >= 0.85 and right(got) > right(of_host) + 0.1
    assert precision >= 0.9 and recall >= 0.8


def test_some_hosts_have_both_verdicts(spark):
    free = QUERIES["op2_url_filter"](spark, DIR).where("rule is null")
    hosts = free.groupBy("host").agg(F.count_distinct("verdict").alias("kinds"), F.count_if(F.col("verdict") == "block").alias("blocked"), F.count("*").alias("n")).collect()
    print("BOTH", sum(r.kinds == 2 for r in hosts), sum(r.blocked for r in hosts), sum(r.n for r in hosts))
    assert sum(r.kinds == 2 for r in hosts) >= 5
