"""Dispatch, fallback, batches and reports against a plain Python model of the rules."""

import collections
import os
import re

import pytest
from pyspark.sql import functions as F

from pagework import errors, schemas
from pagework.config import ArticleOptions, Config
from pagework.operators import reports, summary
from pagework.operators.batch import parse_batch, parse_pages
from pagework.operators.engines import Registry, article_engine, pruned_engine, python_engine
from pagework.operators.rules import rule_set, rules_from_list
from pagework.plans.materialize import materialize, shared_dir
from pagework.sources import pages as page_source


def engine(name, fails_on=""):
    """Returns its own name and the selector; fails on URLs that contain ``fails_on``."""

    def fn(url, html, css):
        if fails_on and fails_on in url:
            return {"error": f"no {name}"}
        return {"title": name, "content": f"{name}:{css or ''}"}

    return python_engine(name, fn)


def registry():
    return (
        Registry().register("a", engine("a", "noa")).register("b", engine("b", "nob"))
        .register("off", engine("off"), available=False)
    )


RULES = [
    {"name": "ra", "match_pattern": "a.com", "engine": "a", "css_selector": "p", "priority": 1},
    {"name": "unknown", "match_pattern": "u.com", "engine": "nosuch"},
    {"name": "offline", "match_pattern": "o.com", "engine": "off"},
    {"name": "blank", "match_pattern": "e.com"},
]


def run(spark, urls, rules=RULES, config=Config(engine_order=("b", "httpx", "off", "a")), **options):
    rows = [(i, u, "<p>x</p>") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    got = parse_pages(df, rule_set(rules_from_list(spark, rules)), registry(), config, **options)
    return [r for r in sorted(got.collect(), key=lambda r: r.pos)]


def brief(r):
    return r.success, r.engine_used, r.rule_matched, r.content, r.error_code


def test_routing_fallback_and_demotion(spark):
    got = run(spark, [
        "http://a.com/", "http://a.com/noa", "http://a.com/noa/nob", "http://x.com/", "http://x.com/nob",
        "http://u.com/", "http://o.com/", "http://e.com/", "ftp://x", " ", "http://x.com/noa/nob",
    ])
    assert [brief(r) for r in got] == [
        (True, "a", "ra", "a:p", None),
        (True, "b", "ra", "b:", None),  # demoted: the rule's name stays, its selector does not
        (False, "", None, "", errors.ALL_ENGINES_FAILED),
        (True, "b", None, "b:", None),
        (True, "a", None, "a:", None),
        (True, "b", "unknown", "b:", None),
        (True, "b", "offline", "b:", None),
        (True, "b", "blank", "b:", None),
        (False, "", None, "", errors.INVALID_URL),
        (False, "", None, "", errors.EMPTY_URL),
        (False, "", None, "", errors.ALL_ENGINES_FAILED),
    ]
    assert got[2].error == got[10].error == "all engines failed (b: no b; a: no a)"


def test_the_selector_of_the_call_wins(spark):
    assert [r.content for r in run(spark, ["http://a.com/", "http://x.com/"], css="q")] == ["a:q", "b:q"]


def test_forced_engine_skips_rules_and_fallback(spark):
    urls = ["http://a.com/", "http://a.com/nob"]
    assert [brief(r) for r in run(spark, urls, engine="b")] == [
        (True, "b", None, "b:", None), (False, "b", None, "", errors.EXTRACT_NONE)
    ]
    assert [brief(r) for r in run(spark, urls[:1], engine="nosuch")] == [(False, "", None, "", errors.ENGINE_UNKNOWN)]
    assert [brief(r) for r in run(spark, urls[:1], engine="off")] == [(False, "", None, "", errors.ENGINE_UNAVAILABLE)]


def test_engine_order(spark):
    all_skipped = run(spark, ["http://x.com/"], [], Config(engine_order=("httpx", "off")))
    assert all_skipped[0].error == "all engines failed ()"
    assert run(spark, ["http://x.com/"], [], Config(engine_order=()))[0].engine_used == "a"
    df = spark.createDataFrame([(0, "http://x.com", "x")], "page_id BIGINT, url STRING, html STRING")
    assert parse_pages(df, None, Registry(), Config(engine_order=())).first().error_code == errors.NO_ENGINE_CONFIGURED


def test_truncation_needs_a_configuration(spark):
    long = f"<p>{'x' * 900}</p>"
    df = spark.createDataFrame([(0, "http://x.com", long)], "page_id BIGINT, url STRING, html STRING")
    reg = Registry().register("article", article_engine(ArticleOptions()))
    assert len(parse_pages(df, None, reg).first().content) == 900
    assert len(parse_pages(df, None, reg, Config(engine_order=(), max_content_length=500)).first().content) == 503


def test_python_engines_run_for_pending_rows_only(spark, tmp_path):
    log = str(tmp_path / "calls")

    def counting(name, fails_on):
        def fn(url, html, css):
            with open(log, "a") as f:
                f.write(name + "\n")
            return {"error": "no"} if fails_on in url else {"title": "", "content": name}

        return python_engine(name, fn)

    reg = Registry()
    for name, fails in (("one", "2"), ("two", "22"), ("three", "none")):
        reg.register(name, counting(name, fails))
    rows = [(i, f"http://x.com/{'2' * (i % 3)}-{i}", "p") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").filter("url NOT LIKE '%-2' ")
    n = df.count()
    twos = sum("2" in u.replace("http://x.com", "") for _, u, _ in rows if not u.endswith("-2"))
    deep = sum("22" in u for _, u, _ in rows if not u.endswith("-2"))
    parse_pages(df, None, reg, Config(engine_order=())).collect()
    assert collections.Counter(open(log).read().split()) == {"one": n, "two": twos, "three": deep}


def batch_inputs():
    urls = ["http://a.com/1", " http://a.com/1 ", "http://hot.com/", None, "", "  ", "nope", "http://gone.com/"]
    return [(i, urls[i % len(urls)] if i % 3 else "http://hot.com/") for i in range(400)]


PAGES = [(1, "http://a.com/1", "<p>one</p>"), (2, "http://hot.com/", "<p>hot</p>"), (3, "http://hot.com/", "<p>newer</p>"), (4, "http://unused.com", "u")]


@pytest.mark.parametrize("min_hot_rows,words,stored", [(10, 1, False), (10**6, 1 << 18, False), (10, 1, True)])
def test_batch_keeps_every_input_row(spark, monkeypatch, tmp_path, min_hot_rows, words, stored):
    monkeypatch.setattr(page_source, "FILTER_WORDS", words)
    rows = batch_inputs()
    inputs = spark.createDataFrame(rows, "pos BIGINT, url STRING")
    pages = spark.createDataFrame(PAGES, "page_id BIGINT, url STRING, html STRING")
    if stored:
        page_source.write_captures(pages, str(tmp_path / "store"), buckets=3)
        pages = page_source.open_captures(spark, str(tmp_path / "store"), buckets=3)
    reg = Registry().register("article", article_engine(ArticleOptions()))
    got = parse_batch(inputs, pages, None, reg, Config(engine_order=()), min_hot_rows=min_hot_rows)
    assert got.columns == list(schemas.RESPONSE_COLUMNS)
    found = {r.pos: r for r in got.collect()}
    assert got.count() == len(found) == len(rows)
    content = {"http://a.com/1": "one", "http://hot.com/": "newer"}
    for pos, url in rows:
        r, clean = found[pos], (url or "").strip()
        assert r.url == (clean or url or "")
        assert r.content == content.get(clean, "")
        expected = None if clean in content else errors.EMPTY_URL if not clean else errors.INVALID_URL if clean == "nope" else errors.ALL_ENGINES_FAILED
        assert r.error_code == expected


def test_empty_batch(spark, tmp_path):
    inputs = spark.createDataFrame([], "pos BIGINT, url STRING")
    pages = spark.createDataFrame(PAGES, "page_id BIGINT, url STRING, html STRING")
    assert parse_batch(inputs, pages).count() == 0
    assert parse_batch(inputs, page_source.write_captures(pages.limit(0), str(tmp_path / "s"), 2)).count() == 0


def moving_html(plan):
    """The exchanges that rows with HTML go through: those with a node below them that gives an html column."""
    out, lines = [], plan.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line or "Exchange RoundRobin" in line:
            below = lines[k + 1] if k + 1 < len(lines) and depth[k + 1] > depth[k] else ""
            out += [line] if re.search(r"\bhtml#", below) else []
    return out


def test_no_html_of_other_pages_moves(spark, tmp_path):
    """From a store no HTML meets an exchange, whatever the number of URLs, and nothing is counted before the
    plan is made; from a plain table only what passes the filter of wanted URLs."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    store = page_source.write_captures(pages, str(tmp_path / "store"), buckets=8)
    jobs, threshold = spark.sparkContext.statusTracker(), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as for tables of real size
    for n in (10, 2500):
        urls = pages.select("url").limit(n)
        spark.sparkContext.setJobGroup(f"plan-{n}", "")
        fetched = page_source.fetch_pages(urls, store)
        plain = page_source.fetch_pages(urls, pages)
        text = fetched._jdf.queryExecution().executedPlan().toString()
        assert not jobs.getJobIdsForGroup(f"plan-{n}") and not moving_html(text)
        assert "ShuffledHashJoin" in text and "BuildLeft" in text and "Bucketed: true" in text and "SortMergeJoin" not in text
        scans = plain._jdf.queryExecution().executedPlan().toString()
        assert moving_html(scans)
        assert scans.count("ReadSchema: struct<url:string,html") + scans.count("ReadSchema: struct<page_id:bigint,url:string,html") == 1
        assert [r.html for r in plain.orderBy("url").collect()] == [r.html for r in fetched.orderBy("url").collect()]
    spark.conf.set(threshold, before)
    spark.sparkContext.setJobGroup("rest", "")
    wanted = spark.range(1000).selectExpr("concat('http://not.there/', id) AS url")
    assert page_source.only_wanted(pages, wanted).count() < 25  # what a filter of this size lets through wrongly
    assert page_source.only_wanted(pages, pages.select("url")).count() == pages.count()


def response_rows(spark, rows):
    df = spark.createDataFrame(rows, "request_id BIGINT, pos BIGINT, success BOOLEAN, rule_matched STRING")
    return df.selectExpr("*", "concat('http://', pos) AS url", "concat('t', pos) AS title", "concat('c', pos) AS content",
                         "CASE WHEN success THEN 'e' ELSE '' END AS engine_used", "CASE WHEN NOT success THEN concat('err', pos) END AS error")


def one_text(pos, success, rule):
    if not success:
        return f"Failed: err{pos}\nURL: http://{pos}"
    lines = [f"Title: t{pos}", f"URL: http://{pos}", "Engine: e"] + ([f"Rule: {rule}"] if rule else []) + ["", "Content:", f"c{pos}"]
    return "\n".join(lines)


def report(texts):
    if len(texts) == 1:
        return texts[0]
    return "\n\n".join(f"=== Result {i}/{len(texts)} ===\n{t}" for i, t in enumerate(texts, 1))


@pytest.mark.parametrize("bucket", [1, 3, 256])
def test_reports_in_parts(spark, bucket):
    rows = [(1, p, p % 4 != 0, "r" if p % 2 else None) for p in range(11)] + [(2, 5, True, None), (3, 7, False, None)]
    asked = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "request_id BIGINT")
    got = reports.format_responses(response_rows(spark, rows), requests=asked, bucket=bucket).collect()
    joined = {i: "".join(r.text for r in sorted(got, key=lambda r: r.part) if r.request_id == i) for i in (1, 2, 3, 4)}
    for i in (1, 2, 3):
        assert joined[i] == report([one_text(p, s, r) for q, p, s, r in rows if q == i])
    assert joined[4] == errors.NO_RESULTS
    assert sorted((r.request_id, r.part, r.total) for r in got) == [(1, k, 11) for k in range(1, 12)] + [(i, 1, 1) for i in (2, 3, 4)]


@pytest.mark.parametrize("bucket", [1, 2, 256])
def test_requests(spark, bucket):
    requests = spark.createDataFrame([
        (1, "http://a.com/1, http://gone.com/ (http://hot.com/) http://gone2.com/ http://a.com/1 http://"),
        (2, "http://a.com/1"), (3, "http://gone.com/ http://gone2.com/"), (4, " \t"), (5, None), (6, "text"), (7, "http:// http://?"),
    ], "request_id BIGINT, text STRING")
    pages = spark.createDataFrame(PAGES, "page_id BIGINT, url STRING, html STRING")
    reg = Registry().register("article", article_engine(ArticleOptions()))
    got = reports.execute_requests(requests, pages, bucket=bucket, registry=reg, config=Config(engine_order=())).collect()
    text = {i: "".join(r.text for r in sorted(got, key=lambda r: r.part) if r.request_id == i) for i in range(1, 8)}
    assert {r.request_id: (r.ok, r.code) for r in got} == {
        1: (True, None), 2: (True, None), 3: (False, errors.ALL_FAILED), 4: (False, errors.NO_INPUT),
        5: (False, errors.NO_INPUT), 6: (False, errors.NO_URL_FOUND), 7: (False, errors.NO_VALID_URL),
    }

    def good(url, content):
        return f"Title: {errors.UNTITLED}\nURL: {url}\nEngine: article\n\nContent:\n{content}"

    failed = "all engines failed (article: no page content was captured for this URL)"
    a = good("http://a.com/1", "one")
    assert text[2] == a
    assert text[1] == report([a, good("http://hot.com/", "newer"), a]) + errors.FAILED_SECTION + (
        f"http://gone.com/: {failed}\nhttp://gone2.com/: {failed}"
    )
    assert text[3] == f"All URLs failed: {failed}; {failed}"
    assert text[7] == errors.MESSAGES[errors.NO_VALID_URL]


def test_summary_totals(spark):
    rows = [("a", None, True, None, "xx"), ("a", "r", True, None, "xxxx"), ("", None, False, "E", "")]
    df = spark.createDataFrame(rows, "engine_used STRING, rule_matched STRING, success BOOLEAN, error_code STRING, content STRING")
    totals = {(r.engine_used, r.rule_matched, r.success, r.error_code, r.level): (r.n, r.avg_chars) for r in summary.outcome_totals(df).collect()}
    assert totals[(None, None, None, None, 15)] == (3, 2.0)
    assert totals[("a", None, None, None, 7)] == (2, 3.0)
    assert {(r.engine_used, r.n) for r in summary.outcome_summary(df).collect()} == {("a", 1), ("", 1)}


def test_registry_status():
    reg = registry()
    assert reg.available() == ["a", "b"]
    assert reg.status("off") == {"engine": "off", "exists": True, "available": False}
    assert reg.status("httpx")["exists"] is False


def test_default_pipeline_is_one_pass_without_python_where_native_suffices(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    native = Registry().register("article", article_engine(ArticleOptions()))
    text = parse_pages(pages, rule_set(rules_from_list(spark, [{"name": "x", "match_pattern": "example.com", "engine": "article"}])), native)
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan
    both = Registry().register("article", article_engine(ArticleOptions())).register("pruned", pruned_engine(Config().pruned))
    plan = parse_pages(pages, None, both, Config(engine_order=()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_shared_dir(spark, tmp_path):
    path = shared_dir(spark)
    assert path == shared_dir(spark)
    df = materialize(spark.range(5).withColumn("x", F.lit("a")), "t")
    assert df.select("id").count() == 5
