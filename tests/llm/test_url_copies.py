"""The URL filter's tree and verdicts don't depend on how often a page was crawled."""

import pytest

from framequarry.llm import url_filter


def results(spark, rows):
    df = spark.createDataFrame(rows, "url string, bad int")
    return {(r.url, r.template, r.branch, round(r.bad_share, 9), r.verdict) for r in url_filter.filter_urls(df, []).collect()}


@pytest.mark.parametrize("k", [5, 40])
def test_copies_change_nothing(spark, k):
    rows = [(f"http://h.org/good/{i}", 0) for i in range(30)] + [(f"http://h.org/bad/{i}", 1) for i in range(30)] + [("http://h.org/one/page", 1), ("http://h.org/new/page", None)]
    once = results(spark, rows)
    assert results(spark, rows * k) == once
    assert {(t, v) for u, t, _, _, v in once if "/bad/" in u} == {("/bad/*", "block")}
    assert {v for u, _, _, _, v in once if "/bad/" not in u} == {"allow"}


def test_hot_page_keeps_its_branch(spark):
    rows = [(f"http://h.org/bad/{i}", 1) for i in range(30)] + [("http://h.org/bad/7", 1)] * 500
    assert {t for _, t, _, _, _ in results(spark, rows)} == {"/bad/*"}


@pytest.mark.parametrize("posts", [2, 10])
def test_ids_with_many_pages_below_are_variable(spark, posts):
    users = [(f"http://h.org/user/{u}/post/{u * posts + p}", None) for u in range(20) for p in range(posts)]
    named = [(f"http://n.org/{c * 3}/{p}", None) for c in "abcdefghij" for p in range(10)]
    assert {t for _, t, _, _, _ in results(spark, users)} == {"/user/*/post/*"}
    assert {t for _, t, _, _, _ in results(spark, named)} == {f"/{c * 3}/*" for c in "abcdefghij"}
