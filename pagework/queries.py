"""Registered queries: one or more per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagework import errors, schemas
from pagework.config import ArticleOptions, Config
from pagework.functions import blocks as bl
from pagework.functions import native_html as nh
from pagework.functions import text as tx
from pagework.functions import urls as u
from pagework.functions.html_tree import html_blocks, select_region
from pagework.operators import corpus, dispatch, reports, rules, summary
from pagework.operators.batch import parse_batch, parse_pages
from pagework.operators.engines import (
    Registry, article_engine, column_engine, default_registry, merge_metadata, metadata_struct,
    pruned_engine, python_engine,
)
from pagework.plans.materialize import materialize, new_path
from pagework.plans.partitions import spread
from pagework.sources.pages import fetch_pages, open_captures, read_pages, write_captures
from pagework.sources.rule_files import load_rules
from pagework.sources.rule_versions import RuleVersions
from pagework.sources.sinks import response_json, write_text
from pagework.streaming.parse_stream import (
    hot_rules_stream, parse_request_stream, parse_stream, read_page_stream, write_stream,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- inputs derived from the tables ---------------------------------------------------------

RULES = [
    {"name": "de_pages", "match_type": "regex", "match_pattern": "/de/[0-9]+", "engine": "headline", "priority": 9},
    {"name": "com", "match_pattern": "example.com", "engine": "article", "css_selector": "article", "priority": 5},
    {"name": "org_wild", "match_pattern": "*.example.org", "engine": "article", "css_selector": ".missing", "priority": 5},
    {"name": "html_suffix", "match_type": "regex", "match_pattern": r"\.html$", "engine": "nosuch", "priority": 1},
    {"name": "broken", "match_type": "regex", "match_pattern": "(", "engine": "article", "priority": 8},
    {"name": "odd_type", "match_type": "glob", "match_pattern": "*", "engine": "article", "priority": 7},
]
ORDER = Config(engine_order=("httpx", "headline", "article"))
PRODUCTION = Config(engine_order=("article", "pruned"))


def pages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_pages(spark, f"{sf_dir}/pages.parquet"), "page_id")


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "doc_id")


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight inputs per page, good and bad; one of them is the same URL for every page."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    forms = F.array(
        F.col("url"),
        F.concat(F.lit("\t "), "url", F.lit(" ")),
        F.concat(F.lit("ftp"), F.expr("substring(url, 5)")),
        F.col("url"),
        F.concat("url", F.lit("/gone")),
        F.lit("   "),
        F.lit("https://hot.example.com/landing"),
        F.lit(None).cast("string"),
    )
    return pages.select("page_id", F.posexplode(forms).alias("k", "url")).select(
        (F.col("page_id") * 8 + F.col("k")).alias("pos"), "url"
    )


def requests_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with several URLs, only dead URLs, all texts of the conversations, blank ones and bare schemes."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "url"))), lambda x: x["url"]), ", (")
    several = pages.groupBy(F.expr("concat('several ', page_id div 3)").alias("request_id")).agg(
        F.concat(F.lit("see "), listed, F.lit(") and [http://gone.invalid/a] or ftp://x")).alias("text")
    )
    dead = pages.select(
        F.concat(F.lit("dead "), "page_id").alias("request_id"),
        F.concat(F.lit("http://gone.invalid/"), "page_id", F.lit(" http://gone.invalid/b")).alias("text"),
    )
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    named = [F.concat(F.lit(kind), "conv_id", F.lit(" "), "turn").alias("request_id") for kind in ("talk ", "blank ", "bare ")]
    talk = turns.select(named[0], "text")
    blank = turns.filter("role = 'assistant'").select(named[1], F.lit(" \t").alias("text"))
    bare = turns.filter("role = 'system'").select(named[2], F.lit("http://").alias("text"))
    return several.unionByName(dead).unionByName(talk).unionByName(blank).unionByName(bare)


def captures_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a status, a redirect, and a second, newer capture of every https page."""
    first = read_pages(spark, f"{sf_dir}/pages.parquet").select(
        "page_id",
        "url",
        F.when(F.col("url").endswith("/"), "").otherwise(F.col("html")).alias("html"),
        F.when(F.col("url").endswith(".html"), 404).when(F.col("url").contains("ref=x"), 500)
        .otherwise(200).alias("status_code"),
        F.when(F.col("url").contains("utm_source"), F.substring_index("url", "?", 1))
        .otherwise(F.col("url")).alias("redirected_url"),
        F.lit("2024-01-01").alias("captured_at"),
    )
    second = first.filter(F.col("url").startswith("https://")).withColumns(
        {"page_id": -1 - F.col("page_id"), "html": F.concat("html", F.lit(" ")), "captured_at": F.lit("2024-02-01")}
    )
    return first.unionByName(second)


def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rules per host of the pages: plain and wildcard domain, a broken pattern, an odd type."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", F.expr(u.url_domain("url")).alias("host"))
    hosts = pages.groupBy("host").agg(F.min("page_id").cast("int").alias("id"))
    kinds = F.array(*[
        F.struct(F.lit(t).alias("t"), p.alias("p"), F.lit(k).alias("k"))
        for k, (t, p) in enumerate([
            ("domain", F.col("host")),
            ("domain", F.concat(F.lit("*."), F.regexp_replace("host", r"^[^.]+\.", ""))),
            ("regex", F.lit("(")),
            ("glob", F.col("host")),
        ])
    ])
    return hosts.select("id", "host", F.explode(kinds).alias("x")).select(
        (F.col("id") * 4 + F.col("x.k")).alias("rule_idx"),
        F.concat("host", F.lit("#"), F.col("x.k")).alias("name"),
        F.col("x.t").alias("match_type"),
        F.col("x.p").alias("match_pattern"),
        F.lit("article").alias("engine"),
        F.lit(None).cast("string").alias("css_selector"),
        F.lit(None).cast(schemas.OPTIONS).alias("extra_options"),
        F.when(F.col("x.k") == 0, F.length("host")).otherwise(1).alias("priority"),
    )


def rule_set_of(spark: SparkSession, entries: list[dict] | None = None) -> rules.RuleSet:
    return rules.rule_set(rules.rules_from_list(spark, RULES if entries is None else entries))


def headline(html: Column, css: Column, options: Column) -> Column:
    """A small native engine: the first headline, if it is long enough."""
    text = F.regexp_extract(html, r"(?s)<h1>(.*?)</h1>", 1)
    ok = F.coalesce(F.length(text) >= 55, F.lit(False))
    return F.struct(
        F.lit("headline").alias("engine"),
        ok.alias("success"),
        F.when(ok, text).otherwise("").alias("title"),
        F.when(ok, F.concat(F.lit("# "), text)).otherwise("").alias("content"),
        F.lit("markdown").alias("content_format"),
        F.expr(metadata_struct({})).alias("metadata"),
        F.when(~ok, errors.EXTRACT_NONE).alias("error_code"),
        F.when(~ok, "headline too short").alias("error"),
    )


def native_registry() -> Registry:
    return (
        Registry()
        .register("headline", column_engine(headline))
        .register("article", article_engine(ArticleOptions()))
        .register("offline", pruned_engine(Config().pruned), available=False)
    )


OUTCOME = ("pos", "url", "title", "content", "content_format", "engine_used", "rule_matched", "success", "error_code", "error")


def blocks_of(spark: SparkSession, sf_dir: str, html: str = "html") -> DataFrame:
    return pages_of(spark, sf_dir).select("page_id", html_blocks(F.expr(html)).alias("blocks"))


def block_rows(df: DataFrame, blocks: str) -> DataFrame:
    """Position among the remaining blocks, tag and text."""
    rows = df.select("page_id", F.posexplode(F.expr(blocks)).alias("i", "b"))
    return rows.select("page_id", F.col("i").cast("bigint").alias("i"), F.col("b.tag").alias("tag"), F.col("b.text").alias("text"))


# ---- sources and sinks ----------------------------------------------------------------------


@query
def s1_fetch_pages(spark, sf_dir):
    urls = url_variants(spark, sf_dir).select(F.expr(u.strip_url("url")).alias("url")).distinct()
    got = fetch_pages(u.validate_urls(urls), captures_of(spark, sf_dir))
    return got.select("url", "page_id", "status_code", "redirected_url", F.md5("html").alias("html_md5"))


@query
def s1_capture_store(spark, sf_dir):
    """The same from a store of the captures, and from one that is opened again."""
    urls = u.validate_urls(url_variants(spark, sf_dir).select(F.expr(u.strip_url("url")).alias("url")).distinct())
    path = new_path(spark, "captures")
    first = fetch_pages(urls, write_captures(captures_of(spark, sf_dir), path, buckets=16))
    again = fetch_pages(urls, open_captures(spark, path, buckets=16))
    both = first.withColumn("opened", F.lit(False)).unionByName(again.withColumn("opened", F.lit(True)))
    return both.select("url", "opened", "page_id", "status_code", "redirected_url", F.md5("html").alias("html_md5"))


@query
def s2_load_rules(spark, sf_dir):
    """Lines with a path alone, with options and a list of paths, without options, and broken ones."""
    stored = host_rules(spark, sf_dir)
    kind = F.col("rule_idx") % 4
    one = F.struct(F.lit("//nav").alias("prune_xpath"))
    many = F.struct(
        F.lit(0.25).alias("content_filter_threshold"), F.lit("text").alias("output_format"), F.lit(True).alias("include_links"),
        F.array(F.lit("//nav"), F.lit("//aside")).alias("prune_xpath"),
    )
    forms = [
        stored.filter(kind == 0).withColumn("extra_options", one),
        stored.filter(kind == 1).withColumns({"extra_options": many, "css_selector": F.lit("main")}),
        stored.filter(kind > 1),
    ]
    # Every fourth line has no index, every other of the rest one that three lines share.
    given = F.when(kind != 2, F.when(F.col("rule_idx") % 8 < 4, F.col("rule_idx").bitwiseAND(F.lit(~3))).otherwise(F.col("rule_idx")))
    lines = stored.select(F.col("rule_idx").alias("at"), F.lit(0).alias("k"), F.concat(F.lit('{"rule_idx": "x", "name": '), "name").alias("value"))
    for rows in forms:
        lines = lines.unionByName(rows.select(
            F.col("rule_idx").alias("at"), F.lit(1).alias("k"),
            F.to_json(F.struct(given.alias("rule_idx"), *(c for c in rows.columns if c != "rule_idx"))).alias("value")))
    path = new_path(spark, "rules")
    lines.orderBy("at", "k").select("value").write.text(path)
    return load_rules(spark, path).select(
        "rule_idx", "line", "name", "match_type", "match_pattern", "engine", "css_selector", "priority",
        "extra_options.content_filter_threshold", "extra_options.output_format", "extra_options.include_links",
        F.array_join("extra_options.prune_xpath", "|").alias("prune_xpath"),
    )


@query
def s3_responses_json(spark, sf_dir):
    got = parse_pages(pages_of(spark, sf_dir), engine="article", config=PRODUCTION)
    return got.select("pos", response_json(OUTCOME).alias("json"))


@query
def s4_write_text(spark, sf_dir):
    got = parse_pages(pages_of(spark, sf_dir), engine="article", config=PRODUCTION)
    path = new_path(spark, "texts")
    write_text(got.select(F.expr(reports.format_response()).alias("text")), path)
    read = spark.read.option("lineSep", "\n\f\n").text(path)
    return read.select(F.col("value").alias("text"))


# ---- URLs -----------------------------------------------------------------------------------


@query
def u1_extract_urls(spark, sf_dir):
    found = requests_of(spark, sf_dir).select("request_id", F.posexplode(F.expr(u.extract_urls("text"))).alias("i", "url"))
    return found.select("request_id", F.col("i").cast("bigint").alias("i"), "url")


@query
def u2_normalize_url_list(spark, sf_dir):
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    given = "array(url, ' \t', NULL, concat('　', url, '\x1f'), '', concat(' ', url))"
    return pages.select("page_id", F.array_join(F.expr(u.normalize_url_list(given)), "|").alias("urls"))


@query
def u3_strip_url(spark, sf_dir):
    return url_variants(spark, sf_dir).select("pos", F.expr(u.strip_url("url")).alias("url"))


def _odd_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    host = r"^(https?://)([^/]+)"
    forms = F.array(
        F.col("url"),
        F.regexp_replace("url", host, "$1User:pw@$2:8080"),
        F.regexp_replace("url", host, "$1[2001:db8::1]:80"),
        F.regexp_replace("url", host, "$1[bad"),
        F.regexp_replace("url", host, "$1"),
        F.regexp_replace("url", host, "$1$2?x"),
        F.regexp_replace("url", host, "$1Ünï.$2"),
        F.regexp_replace("url", host, "$1$2：80"),
        F.upper("url"),
        F.concat(F.lit(" "), "url"),
        F.regexp_replace("url", "/", "/\t"),
    )
    return pages.select("page_id", F.posexplode(forms).alias("k", "url")).select(
        (F.col("page_id") * 16 + F.col("k")).alias("pos"), "url"
    )


@query
def u4_is_valid_url(spark, sf_dir):
    return _odd_urls(spark, sf_dir).select("pos", F.expr(u.is_valid_url("url")).alias("valid"))


@query
def u5_validate_urls(spark, sf_dir):
    return u.validate_urls(_odd_urls(spark, sf_dir)).select("pos", "url")


@query
def u6_url_domain(spark, sf_dir):
    return _odd_urls(spark, sf_dir).select("pos", F.expr(u.url_domain("url")).alias("domain"))


@query
def u7_truncate_content(spark, sf_dir):
    return documents_of(spark, sf_dir).select("doc_id", F.expr(u.truncate_content("text", 500)).alias("content"))


# ---- rules ----------------------------------------------------------------------------------


@query
def r1_compile_rules(spark, sf_dir):
    return rules.compile_rules(host_rules(spark, sf_dir)).select("rule_idx", "usable", F.col("rank.first").alias("rank"))


@query
def r2_match_domain(spark, sf_dir):
    wide = rules.rule_set(host_rules(spark, sf_dir))
    got = rules.route(_odd_urls(spark, sf_dir), wide, strategy="join")
    return got.select("pos", "domain", "rule_matched")


@query
def r3_match_regex(spark, sf_dir):
    rule = [{"name": p, "match_type": "regex", "match_pattern": p} for p in (r"/de/[0-9]+", r"\.html$", "[?]page=", "^http:", "(")]
    got = rules.route(url_variants(spark, sf_dir), rule_set_of(spark, rule))
    return got.select("pos", "rule_matched")


@query
def r3_pattern_index(spark, sf_dir):
    """A pattern for every page, found by its pieces; plus some that many URLs match and some without literals."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    forms = [("page", r"^https?://[^/]+/.*\b", F.regexp_extract("url", "([0-9]+)", 1), r"\b"), ("host", "(?i)//", F.upper(F.regexp_extract("url", "//([^/.]+)", 1)), "[.]"),
             ("any", "(de|fr|es)/0*", F.regexp_extract("url", "([0-9]+)", 1), "$"), ("odd", "", F.lit("^[^?]*$"), "")]
    entries = [
        pages.select(
            (F.col("page_id") * len(forms) + k).cast("int").alias("rule_idx"), F.concat(F.lit(name + " "), what).alias("name"), F.lit("regex").alias("match_type"),
            F.concat(F.lit(before), what, F.lit(after)).alias("match_pattern"), F.lit("article").alias("engine"), F.lit(None).cast("string").alias("css_selector"),
            F.lit(None).cast(schemas.OPTIONS).alias("extra_options"), F.lit(priority).alias("priority"))
        for k, ((name, before, what, after), priority) in enumerate(zip(forms, (2, 0, 3, -1)))
    ]
    every = entries[0].unionByName(entries[1]).unionByName(entries[2]).unionByName(entries[3])
    got = rules.route(url_variants(spark, sf_dir), rules.rule_set(every))
    return got.select("pos", "rule_matched")


@query
def r4_first_rule(spark, sf_dir):
    got = rules.route(url_variants(spark, sf_dir), rule_set_of(spark), strategy="join")
    return got.select("pos", "rule_matched")


@query
def r4_tied_rules(spark, sf_dir):
    """Stored rules of which several share an index and others have none: the line decides between them."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", F.expr(u.url_domain("url")).alias("host"))
    hosts = pages.groupBy("host").agg(F.min("page_id").alias("id"))
    kinds = hosts.select("host", "id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    lines = kinds.orderBy("id", "k").select(F.to_json(F.struct(
        F.when(F.col("k") != 1, F.col("id") * 2 + F.col("k") % 2).alias("rule_idx"), F.concat("host", F.lit("#"), "k").alias("name"),
        F.col("host").alias("match_pattern"), F.lit("article").alias("engine"))).alias("value"))
    path = new_path(spark, "rules")
    lines.write.text(path)
    stored = load_rules(spark, path)
    urls = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    got = [rules.route(urls, rules.rule_set(stored, case_limit=limit), strategy=form).selectExpr("page_id", f"'{form}' AS form", "rule_matched")
           for form, limit in (("case", None), ("join", 0))]
    return got[0].unionByName(got[1])


@query
def r5_route(spark, sf_dir):
    got = rules.route(url_variants(spark, sf_dir), rule_set_of(spark))
    return got.select("pos", "url", "domain", "rule_matched", "rule_engine", "css_selector")


@query
def r6_resolve_options(spark, sf_dir):
    entries = [
        {**RULES[0], "extra_options": {"content_filter_threshold": 0.25, "include_links": True, "prune_xpath": ["//nav", "//aside"]}},
        {**RULES[1], "extra_options": {"output_format": "txt", "unknown": 1}},
        RULES[2],
    ]
    routed = rules.route(pages_of(spark, sf_dir).select("page_id", "url"), rule_set_of(spark, entries))
    got = rules.resolve_options(routed, Config())
    return got.select("page_id", "css", *[k for k in schemas.OPTION_KEYS if k != "prune_xpath"], F.array_join("prune_xpath", "|").alias("prune_xpath"))


@query
def r7_force_engine(spark, sf_dir):
    got = parse_pages(pages_of(spark, sf_dir), rule_set_of(spark), native_registry(), ORDER, engine="article")
    return got.select(*OUTCOME)


# ---- dispatch -------------------------------------------------------------------------------


@query
def d1_attempt(spark, sf_dir):
    pages = pages_of(spark, sf_dir).selectExpr("*", "200 AS status_code", "CAST(NULL AS STRING) AS redirected_url")
    name = "CASE WHEN url LIKE '%/de/%' THEN 'nosuch' WHEN url LIKE '%/fr/%' THEN 'offline' WHEN url LIKE '%/es/%' THEN 'headline' ELSE 'article' END"
    reg = native_registry()
    got = dispatch.attempt(pages, "a", reg, name, reg.names(), "true", None, None, frozenset())
    return got.select("page_id", "a.engine", "a.success", "a.title", "a.error_code", "a.error")


@query
def d2_fallback(spark, sf_dir):
    return parse_pages(pages_of(spark, sf_dir), None, native_registry(), ORDER).select(*OUTCOME)


@query
def d3_all_failed_error(spark, sf_dir):
    return parse_pages(pages_of(spark, sf_dir), None, native_registry(), ORDER, css=".missing").select(*OUTCOME)


@query
def d4_rule_demotion(spark, sf_dir):
    return parse_pages(pages_of(spark, sf_dir), rule_set_of(spark), native_registry(), ORDER).select(*OUTCOME)


@query
def d5_parse_batch(spark, sf_dir):
    got = parse_batch(url_variants(spark, sf_dir), captures_of(spark, sf_dir), rule_set_of(spark), native_registry(), ORDER)
    return got.select(*OUTCOME)


@query
def d6_to_response(spark, sf_dir):
    got = parse_pages(captures_of(spark, sf_dir), engine="article", config=PRODUCTION)
    return got.select(*OUTCOME, "metadata.status_code", "metadata.redirected_url", "metadata.language", "metadata.hostname")


@query
def d7_outcome_summary(spark, sf_dir):
    got = parse_pages(pages_of(spark, sf_dir), rule_set_of(spark), native_registry(), ORDER)
    return summary.outcome_totals(got).select(*summary.KEYS, F.col("level").cast("bigint").alias("level"), "n", "avg_chars")


@query
def d7_outcome_sketches(spark, sf_dir):
    """Sketches of the batches of a stream, merged per engine and rule, and per engine alone."""
    folder, stored, store = new_path(spark, "arriving"), new_path(spark, "sketches"), new_path(spark, "rule-versions")
    for part in range(3):
        pages_of(spark, sf_dir).filter(F.col("page_id") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    versions = RuleVersions.create(rules.rules_from_list(spark, RULES), store)
    stream = spark.readStream.schema(schemas.PAGES).option("maxFilesPerTrigger", 1).parquet(folder)
    hot_rules_stream(stream, versions, summary.sketch_batches(stored), registry=native_registry(), config=ORDER).awaitTermination()
    sketches = spark.read.parquet(stored)
    fine = summary.read_sketches(sketches, "engine_used", "rule_matched")
    coarse = summary.read_sketches(sketches, "engine_used").withColumn("rule_matched", F.lit("*"))
    return fine.unionByName(coarse)


def _length_engine(url: str, html: str, css: str | None) -> dict:
    if url.endswith("/"):
        raise ValueError("folder")
    return {"title": url, "content": str(len(html))}


@query
def d8_register_engine(spark, sf_dir):
    reg = native_registry().register("size", python_engine("size", _length_engine))
    got = parse_pages(pages_of(spark, sf_dir), None, reg, Config(engine_order=("size", "headline")))
    return got.select(*OUTCOME)


def _described_engine(url: str, html: str, css: str | None, options: dict) -> dict:
    """Uses the options of the rule, tells metadata, and raises or gives unusable metadata for some pages."""
    if url.endswith("/"):
        raise ValueError("folder")
    bad = {"status_code": "none"} if url.endswith(".html") else {}
    return {
        "title": url, "content": f"{css or ''}|{options.get('output_format', '')}|{len(html)}", "content_format": options.get("output_format"),
        "metadata": {"author": "engine", "tags": sorted(options), "categories": "one", "unknown": 1, **bad},
    }


@query
def d8_engine_options(spark, sf_dir):
    """A Python engine with the options of two rules, metadata of its own, and rows that raise."""
    reg = native_registry().register("described", python_engine("described", _described_engine))
    entries = [
        {"name": "com", "match_pattern": "example.com", "engine": "described", "css_selector": "article", "extra_options": {"output_format": "text", "include_links": True}},
        {"name": "org", "match_pattern": "example.org", "engine": "described", "extra_options": {"target_language": "de"}},
    ]
    got = parse_pages(pages_of(spark, sf_dir), rule_set_of(spark, entries), reg, Config(engine_order=("described",)))
    return got.select(*OUTCOME, "metadata.author", F.array_join("metadata.tags", ",").alias("tags"), F.array_join("metadata.categories", ",").alias("categories"), "metadata.status_code")


# ---- extraction -----------------------------------------------------------------------------


@query
def x1_select_region(spark, sf_dir):
    got = pages_of(spark, sf_dir).select("page_id", select_region(F.col("html"), F.lit("article h1, div.ad, .missing")).alias("r"))
    return got.select("page_id", "r.region")


@query
def x2_article_text(spark, sf_dir):
    rows = pages_of(spark, sf_dir).select("page_id", F.posexplode(F.expr(nh.article_blocks("html"))).alias("i", "b"))
    return rows.select("page_id", F.col("i").cast("bigint").alias("i"), F.expr(nh.block_kind("b")).alias("kind"), F.expr(nh.block_text("b")).alias("text"))


_NESTED = (
    "replace(html, '</article>', concat('<article class=x><p>inner ', page_id, '</p><div class=\\'wide ad\\'><div>buy <div>now</div></div> cheap</div></article>"
    "<p>tail ', page_id, '</p></section><section class=comments><div class=\"comment\"><div>first</div>second</div>third</section>"
    "<table><tr><td>cell</td><td><table><tr><td>in</td></tr></table></td></tr></table>"
    "<aside>x<aside>y</aside>z</aside><ul ID = \"sponsor\"><li>s<ul><li>t</li></ul></ul><p>end</p><div class=\"ad\">never closed<div></article>'))"
)


@query
def x2_nested_containers(spark, sf_dir):
    """Articles, adverts, comments and tables nested in their like, in all quotes, with stray and missing tags, for all toggles."""
    pages = pages_of(spark, sf_dir).select("page_id", F.expr(_NESTED).alias("html"))
    forms = F.expr("array(named_struct('comments', false, 'tables', true), named_struct('comments', true, 'tables', true), named_struct('comments', true, 'tables', false))")
    rows = pages.select("page_id", "html", F.explode(forms).alias("t")).select("page_id", "t.comments", "t.tables", F.expr(nh.article_blocks("html", "t.comments", "t.tables")).alias("b"))
    return rows.select("page_id", "comments", "tables", F.posexplode("b").alias("i", "x")).select(
        "page_id", "comments", "tables", F.col("i").cast("bigint").alias("i"), F.expr(nh.block_text("x")).alias("text"))


@query
def x3_html_blocks(spark, sf_dir):
    return block_rows(blocks_of(spark, sf_dir), "blocks")


@query
def x4_prune_blocks(spark, sf_dir):
    return block_rows(blocks_of(spark, sf_dir), bl.prune_blocks("blocks", "0.6D"))


@query
def x5_fit_or_raw(spark, sf_dir):
    fit = tx.extract("html", r"(?s)<h1>([^<]{55,})</h1>")
    raw = f"CASE WHEN url NOT LIKE '%/' THEN {nh.title_element('html')} ELSE '' END"
    return pages_of(spark, sf_dir).select("page_id", F.expr(bl.fit_or_raw(fit, raw)).alias("content"))


@query
def x6_remove_overlays(spark, sf_dir):
    return block_rows(blocks_of(spark, sf_dir), bl.remove_overlays("blocks"))


@query
def x7_prune_subtrees(spark, sf_dir):
    paths = """array('//nav', '//footer', "//div[@class='ad']")"""
    return block_rows(blocks_of(spark, sf_dir), bl.prune_subtrees("blocks", paths))


_EXTRA = (
    "replace(html, '</article>', concat('<table><tr><td>cell</td><td>', page_id, '</td></tr></table>"
    "<div class=\"comments\"><p>a remark</p></div></article>'))"
)


@query
def x8_content_toggles(spark, sf_dir):
    df = blocks_of(spark, sf_dir, _EXTRA)
    forms = [(False, True), (True, True), (False, False)]
    rows = [
        block_rows(df, bl.content_toggles(bl.main_blocks("blocks"), comments, tables)).selectExpr(
            "page_id", f"{str(comments).lower()} AS comments", f"{str(tables).lower()} AS tables", "i", "text")
        for comments, tables in forms
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def x9_render(spark, sf_dir):
    df = pages_of(spark, sf_dir).select(
        "page_id", F.expr(nh.article_blocks("html")).alias("b"), F.explode(F.expr("array('markdown', 'txt', 'html', 'xml')")).alias("fmt")
    )
    return df.select("page_id", "fmt", F.expr(nh.content_label("fmt")).alias("label"), F.expr(nh.render_marked("b", "fmt")).alias("content"))


@query
def x9_render_blocks(spark, sf_dir):
    df = blocks_of(spark, sf_dir)
    return df.select("page_id", F.expr(bl.render_blocks("blocks", True)).alias("content"))


@query
def x10_dedup_paragraphs(spark, sf_dir):
    df = pages_of(spark, sf_dir).select("page_id", F.expr(nh.article_blocks("html")).alias("b"))
    return df.select("page_id", F.expr(nh.render_marked("array_distinct(b)", "'txt'")).alias("content"))


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda s: F.trim(s))
    rows = documents_of(spark, sf_dir).select(F.col("doc_id").alias("page_id"), F.posexplode(lines).alias("pos", "text"))
    return rows.filter("text <> ''")


@query
def x11_dedup_corpus(spark, sf_dir):
    kept = corpus.dedup_paragraphs(_paragraphs(spark, sf_dir), min_chars=20)
    return kept.select("page_id", F.col("pos").cast("bigint").alias("pos"), "text")


@query
def x11_dedup_documents(spark, sf_dir):
    kept = corpus.dedup_paragraphs(_paragraphs(spark, sf_dir), min_chars=20)
    return corpus.dedup_documents(corpus.join_paragraphs(kept, "\n"))


@query
def x12_filter_language(spark, sf_dir):
    got = parse_pages(pages_of(spark, sf_dir), engine="article",
                      registry=Registry().register("article", article_engine(ArticleOptions(target_language="de"))), config=PRODUCTION)
    return got.select("pos", "success", "error_code", "metadata.language")


@query
def x12_vote_language(spark, sf_dir):
    return documents_of(spark, sf_dir).select("doc_id", F.expr(nh.voted_language("text")).alias("language"))


@query
def x13_extract_title(spark, sf_dir):
    return pages_of(spark, sf_dir).select("page_id", F.expr(f"coalesce({nh.page_title('html')}, {tx.q(errors.UNTITLED)})").alias("title"))


_META_PAGE = (
    "replace(html, '<meta charset=\"utf-8\">', concat('<meta name=\"author\" content=\"A &amp; ', page_id, '\">"
    "<META content=''2024-03-05T10:00:00Z'' property=''article:published_time''>"
    "<meta property=\"og:site_name\" content=\"Site\"><meta name=\"description\" content=\" about \">"
    "<meta property=\"og:title\" content=\"Social ', page_id, '\"><meta name=\"keywords\" content=\"a, b,a\">"
    "<meta property=\"article:section\" content=\"News\"><meta property=\"og:image\" content=\"', url, '\">'))"
).replace("''", "\\'")


@query
def x14_extract_metadata(spark, sf_dir):
    df = pages_of(spark, sf_dir).select("page_id", "url", F.expr(_META_PAGE).alias("html"))
    got = parse_pages(df, engine="article", config=PRODUCTION)
    m = [F.col(f"metadata.{n}") for n in ("author", "date", "sitename", "description", "language", "hostname", "image")]
    lists = [F.array_join(f"metadata.{n}", "|").alias(n) for n in ("categories", "tags")]
    return got.select("pos", "title", *m, *lists)


@query
def x15_merge_metadata(spark, sf_dir):
    first = {"language": "'xx'", "sitename": "'fetched'", "status_code": "200"}
    second = {"language": nh.declared_language("html"), "sitename": "CASE WHEN url LIKE '%/' THEN 'page' END"}
    got = pages_of(spark, sf_dir).select("page_id", F.expr(metadata_struct(merge_metadata(first, second))).alias("m"))
    return got.select("page_id", "m.language", "m.sitename", "m.status_code", "m.author")


@query
def x16_fingerprint(spark, sf_dir):
    return corpus.fingerprints(documents_of(spark, sf_dir), "doc_id", "text")


@query
def x16_response_fingerprint(spark, sf_dir):
    """Fingerprints that the article engine sets itself, and those that are set on the stored responses."""
    config = Config(engine_order=("article",), max_content_length=50_000, article=ArticleOptions(fingerprint=True))
    got = parse_pages(captures_of(spark, sf_dir), registry=Registry().register("article", article_engine(config.article)), config=config)
    both = corpus.with_fingerprints(got).select("pos", F.col("metadata.fingerprint").alias("set_later"))
    return got.select("pos", "metadata.fingerprint").join(both, "pos")


@query
def x17_empty_guards(spark, sf_dir):
    pages = captures_of(spark, sf_dir).selectExpr("page_id", "url", "status_code", "redirected_url",
        "CASE WHEN url LIKE '%/fr/%' THEN '<html><body><nav>x</nav></body></html>' ELSE html END AS html")
    got = parse_pages(pages, engine="article", config=PRODUCTION, css="html, p.never")
    return got.select("pos", "success", "error_code", "error")


# ---- requests, reports, streams -------------------------------------------------------------


@query
def f1_format_response(spark, sf_dir):
    got = parse_pages(pages_of(spark, sf_dir), rule_set_of(spark), native_registry(), ORDER, css=None)
    return got.select("pos", F.expr(reports.format_response()).alias("text"))


@query
def f2_format_responses(spark, sf_dir):
    got = parse_pages(pages_of(spark, sf_dir), None, native_registry(), ORDER)
    got = materialize(got.withColumn("request_id", F.expr("pos div 3")), "responses")
    # Requests without responses have negative ids, which no table size brings near the others.
    asked = got.selectExpr("explode(array(request_id, -1 - request_id)) AS request_id").distinct()
    return reports.format_responses(got, requests=asked)


@query
def f3_execute_requests(spark, sf_dir):
    return reports.execute_requests(
        requests_of(spark, sf_dir), captures_of(spark, sf_dir),
        rules=rule_set_of(spark), registry=native_registry(), config=ORDER,
    )


@query
def f4_parse_stream(spark, sf_dir):
    stream = read_page_stream(spark, sf_dir, "pages.parquet")
    out = new_path(spark, "stream-out")
    got = parse_stream(stream, rule_set_of(spark), registry=native_registry(), config=ORDER)
    write_stream(got, out).awaitTermination()
    return spark.read.schema(got.schema).parquet(out).select(*OUTCOME)


@query
def f5_hot_rules(spark, sf_dir):
    stored = new_path(spark, "hot-rules")
    rules.rules_from_list(spark, RULES).write.json(stored)
    out = new_path(spark, "hot-out")

    def write(responses: DataFrame, number: int) -> None:
        responses.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = read_page_stream(spark, sf_dir, "pages.parquet")
    hot_rules_stream(stream, stored, write, registry=native_registry(), config=ORDER).awaitTermination()
    return spark.read.schema(schemas.RESPONSES).parquet(f"{out}/*").select(*OUTCOME)


@query
def f4_request_stream(spark, sf_dir):
    """A request for every page, each answered as its capture arrives; captures of every seventh page never do.

    Rows come in three parts by page id, those of every fifth capture a part later than their request; a last
    part far in the future ends all waiting."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").withColumn("part", F.col("page_id") % 3)
    at = F.timestamp_seconds(1_700_000_000 + F.col("page_id") % 600)
    asked = pages.select("part", F.col("page_id").alias("pos"), "url", at.alias("asked_at"))
    late = F.when(F.col("page_id") % 5 == 0, F.col("part") + 1).otherwise(F.col("part"))
    found = pages.filter("page_id % 7 <> 0").select(late.alias("part"), "page_id", "url", "html", (at + F.expr("make_dt_interval(0, 0, CAST(page_id % 4 AS INT), 0)")).alias("captured_at"))
    end = F.timestamp_seconds(F.lit(1_800_000_000))
    ends = [asked.limit(1).select(F.lit(-1).cast("bigint").alias("pos"), F.lit("").alias("url"), end.alias("asked_at")),
            found.limit(1).select(F.lit(-1).cast("bigint").alias("page_id"), F.lit("").alias("url"), F.lit("").alias("html"), end.alias("captured_at"))]
    # A batch takes as many files as a part has at most; where parts meet in one, only the far rows have to be the last.
    files = pages.rdd.getNumPartitions()
    streams = []
    for rows, last in zip((asked, found), ends):
        folder = new_path(spark, "arriving")
        for part in range(4):
            rows.filter(F.col("part") == part).drop("part").write.mode("append").parquet(folder)
        last.write.mode("append").parquet(folder)
        streams.append(spark.readStream.schema(last.schema).option("maxFilesPerTrigger", max(files, 1)).parquet(folder))
    out = new_path(spark, "answers")
    got = parse_request_stream(*streams, rule_set_of(spark), native_registry(), ORDER, late="1 hour")
    write_stream(got, out).awaitTermination()
    return spark.read.schema(got.schema).parquet(out).select(*OUTCOME)


RUNNING = {"processingTime": "1 second"}


def _while_running(query: StreamingQuery, *steps: Callable[[], None]) -> None:
    """Take each step when the running query has worked off all that is there, and stop it at the end."""
    try:
        query.processAllAvailable()
        for step in steps:
            step()
            query.processAllAvailable()
    finally:
        query.stop()


@query
def f5_versioned_rules(spark, sf_dir):
    """One running query; new rules are published after its first batch, before the second half of the pages arrives."""
    folder, out = new_path(spark, "arriving"), new_path(spark, "versions-out")
    store = RuleVersions.create(rules.rules_from_list(spark, RULES), new_path(spark, "rule-versions"))

    def write(responses: DataFrame, number: int) -> None:
        responses.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if number == 0:
            store.publish(rules.rules_from_list(spark, RULES[4:]))

    def arrive(half: int) -> None:
        pages_of(spark, sf_dir).filter(F.col("page_id") % 2 == half).write.mode("append").parquet(folder)

    arrive(0)
    stream = spark.readStream.schema(schemas.PAGES).parquet(folder)
    _while_running(hot_rules_stream(stream, store, write, trigger=RUNNING, registry=native_registry(), config=ORDER), lambda: arrive(1))
    return spark.read.schema(f"{schemas.RESPONSES}, rules_version LONG").parquet(f"{out}/*").select(*OUTCOME, "rules_version")


# ---- the whole pipeline with the default engines --------------------------------------------


@query
def page_articles(spark, sf_dir):
    """The flagship: route every page by the small rule set, extract, truncate; one JVM-only pass."""
    entries = [{**r, "engine": "article", "css_selector": None} for r in RULES]
    reg = Registry().register("article", article_engine(ArticleOptions()))
    got = parse_pages(pages_of(spark, sf_dir), rule_set_of(spark, entries), reg, Config(engine_order=("article",)))
    return got.select(*OUTCOME, "metadata.language", "metadata.hostname")


@query
def pruned_pages(spark, sf_dir):
    """Both default engines with their real rules: half the pages go through the block pass."""
    entries = [{**r, "engine": "pruned" if r["engine"] == "headline" else r["engine"]} for r in RULES]
    config = Config(engine_order=("pruned", "article"))
    got = parse_pages(pages_of(spark, sf_dir), rule_set_of(spark, entries), default_registry(config), config)
    return got.select(*OUTCOME)
