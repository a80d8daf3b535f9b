"""Captures that share a page id, long numeric references, long rule tables on a stream's form."""

from pagework.functions.text import _decode_numeric
from pagework.operators.rules import rule_set, rules_from_list
from pagework.sources.pages import fetch_pages


def test_recaptured_page_id(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", "old", "2024-01-01"), (1, "http://a/", "new", "2024-02-01"), (1, "http://b/", "other", "2024-03-01")],
        "page_id LONG, url STRING, html STRING, captured_at STRING",
    )
    urls = spark.createDataFrame([("http://a/",), ("http://b/",), ("http://none/",)], "url STRING")
    got = sorted((r.url, r.html) for r in fetch_pages(urls, pages).collect())
    assert got == [("http://a/", "new"), ("http://b/", "other"), ("http://none/", None)]


def test_numeric_references_of_any_length(spark):
    text = "&#00000065;&#x0000000042;&#99999999;&#x1234567890abcdef123;&#67;"
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.selectExpr(_decode_numeric("t") + " AS x").first().x == "AB\ufffd\ufffdC"


def test_any_number_of_literal_rules(spark):
    rules = rules_from_list(spark, [{"name": f"r{i}", "match_pattern": f"h{i}.example.com", "engine": "article"} for i in range(200)])
    assert rule_set(rules).literal is None
    assert len(rule_set(rules, case_limit=None).literal) == 200
