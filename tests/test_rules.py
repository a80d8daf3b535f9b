"""Rule compilation and routing."""

import random
import re
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from pagework import schemas
from pagework.config import Config
from pagework.functions.patterns import covers_of, pieces_of
from pagework.operators import rules as ru
from pagework.queries import RULES
from pagework.sources.pages import read_pages
from pagework.sources.rule_files import load_rules, save_rules

URLS = [
    "http://example.com/", "http://www.example.com/de/5", "http://badexample.com/", "http://example.com:8080/",
    "http://u:p@example.com/", "http://EXAMPLE.com/x.html", "http://a.b.example.org/", "http://example.org",
    "http://example.net/a.html\n", "http://example.com./", "http://other.invalid/DE/1",
]


def brute_force(entries, url):
    domain = urlparse(url).netloc.lower()
    for r in sorted(entries, key=lambda r: r.get("priority", 0), reverse=True):
        pattern = r.get("match_pattern", "")
        kind = r.get("match_type", "domain")
        if kind == "regex":
            try:
                hit = re.search(pattern, url)
            except re.error:
                hit = None
        elif kind == "domain" and pattern and domain:
            key = pattern.lower().removeprefix("*.")
            hit = domain == key or domain.endswith("." + key)
        else:
            hit = False
        if hit:
            return r.get("name", "")
    return None


def routed(spark, entries, urls=URLS, **options):
    df = spark.createDataFrame([(x,) for x in urls], "url STRING")
    got = ru.route(df, ru.rule_set(ru.rules_from_list(spark, entries)), **options)
    return {r.url: r.rule_matched for r in got.collect()}


@pytest.mark.parametrize("strategy", ["case", "join"])
def test_small_rule_set(spark, strategy):
    assert routed(spark, RULES, strategy=strategy) == {x: brute_force(RULES, x) for x in URLS}


@pytest.mark.parametrize("strategy", ["case", "join"])
def test_dialect_and_ties(spark, strategy):
    entries = [
        {"name": "named", "match_type": "regex", "match_pattern": r"(?P<l>[a-z])/(?P=l)\Z", "priority": 3},
        {"name": "first", "match_pattern": "example.com", "priority": 1},
        {"name": "second", "match_pattern": "EXAMPLE.com", "priority": 1},
        {"name": "letters", "match_type": "regex", "match_pattern": r"^http://\w+\.invalid"},
        {"name": "empty", "match_pattern": "", "priority": 100},
        {"name": "dot", "match_pattern": "*.", "priority": 2},
        {"match_pattern": "example.net", "engine": ""},
    ]
    urls = URLS + ["http://x.com/b/b", "http://ünï.invalid/", "http://b.invalid/"]
    assert routed(spark, entries, urls, strategy=strategy) == {x: brute_force(entries, x) for x in urls}


def test_many_rules_use_the_join_form(spark):
    names = [f"h{i}.example.com" for i in range(300)]
    entries = [{"name": n, "match_pattern": n, "priority": i % 7} for i, n in enumerate(names)]
    entries += [{"name": "all", "match_pattern": "example.com", "priority": 3}]
    entries += [{"name": f"re{i}", "match_type": "regex", "match_pattern": f"/p{i}$", "priority": i % 5} for i in range(70)]
    assert ru.rule_set(ru.rules_from_list(spark, entries)).literal is None
    urls = [f"http://{random.Random(i).choice(names)}/p{i}" for i in range(150)] + ["http://hot.example.com/"] * 1
    expected = {x: brute_force(entries, x) for x in urls}
    assert routed(spark, entries, urls) == expected
    # Every domain counts as hot: the salted path gives the same.
    assert routed(spark, entries, urls, min_hot_rows=0) == expected


def test_tables_may_go_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert routed(spark, RULES, strategy="join", min_hot_rows=0) == {x: brute_force(RULES, x) for x in URLS}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("pattern,text", [
    (r"/(?P<lang_code>de)/(?P=lang_code)", "/de/de"), ("/[[a]de", "/[de"), (r"[a&&b]x", "&x"), (r"[]a]$", "]"),
    (r"\\\\Z", "\\Z"), (r"a\Z", "a"), (r"/x{,2}y", "/xxy"), (r"/{id}", "/{id}"), (r"[^]]b", "ab"),
])
def test_patterns_in_the_other_dialect(spark, pattern, text):
    row = spark.createDataFrame([(text,), ("zzz",)], "x STRING").select("x", F.expr(ru.match_regex("x", pattern)).alias("hit"))
    assert {r.x: r.hit for r in row.collect()} == {x: bool(re.search(pattern, x)) for x in (text, "zzz")}


def test_order_of_stored_rows_does_not_matter(spark, tmp_path):
    table = ru.rules_from_list(spark, RULES)
    save_rules(table.orderBy(F.rand(7)), str(tmp_path / "rules"))
    got = ru.route(spark.createDataFrame([(x,) for x in URLS], "url STRING"), ru.rule_set(load_rules(spark, str(tmp_path / "rules"))))
    assert {r.url: r.rule_matched for r in got.collect()} == {x: brute_force(RULES, x) for x in URLS}


def test_bad_entries_are_skipped(spark, tmp_path):
    assert [r.name for r in ru.rules_from_list(spark, [None, {"name": "ok"}, {"name": "bad", "priority": "x"}]).collect()] == ["ok"]
    (tmp_path / "r.json").write_text('{"rule_idx": 0, "name": "a"}\n{oops\n{"name": "no index"}\n{"rule_idx": "x"}\n')
    assert [r.name for r in load_rules(spark, str(tmp_path / "r.json")).collect()] == ["a", "no index"]


def test_rules_as_users_write_them(spark, tmp_path):
    lines = [
        '{"name": "one", "match_pattern": "a.com", "extra_options": {"prune_xpath": "//nav"}}', "{oops",
        '{"name": "two", "match_pattern": "a.com", "extra_options": {"prune_xpath": ["//nav", "//aside"], "output_format": "text"}}',
        '{"name": "three", "priority": 3, "css_selector": "main"}',
    ]
    (tmp_path / "r.json").write_text("\n".join(lines))
    rows = {r.name: r for r in load_rules(spark, str(tmp_path / "r.json")).collect()}
    assert {n: r.rule_idx for n, r in rows.items()} == {"one": 0, "two": 2, "three": 3}
    assert rows["one"].extra_options.prune_xpath == ["//nav"] and rows["two"].extra_options.prune_xpath == ["//nav", "//aside"]
    assert rows["two"].extra_options.output_format == "text" and rows["three"].css_selector == "main"
    assert rows["three"].extra_options is None


def test_no_rules(spark):
    assert set(routed(spark, []).values()) == {None}


def test_options_resolution(spark):
    entries = [{"name": "a", "match_pattern": "example.com", "css_selector": "main",
                "extra_options": {"content_filter_threshold": 0.1, "prune_xpath": "//nav", "nonsense": 3}}]
    df = spark.createDataFrame([("http://example.com",), ("http://other.com",)], "url STRING")
    df = ru.route(df, ru.rule_set(ru.rules_from_list(spark, entries)))
    rows = {r.url: r for r in ru.resolve_options(df, Config()).collect()}
    assert rows["http://example.com"].content_filter_threshold == 0.1
    assert rows["http://example.com"].prune_xpath == ["//nav"]
    assert rows["http://example.com"].css == "main"
    assert rows["http://other.com"].content_filter_threshold == 0.6
    assert {r.css for r in ru.resolve_options(df, Config(), css="p").collect()} == {"p"}


@pytest.mark.parametrize("pattern", [
    "abc", r"/docs/\d+", "a|bcde", "(foo|barbaz)qux?", "(?i)HeLLo", "x{0,3}yz+", "[ab]c", "(?:abcd)+e", r"\.html$", "(?=abc)d", "(abc)?d", "é+abcdé", "(?x) a b # c\n d",
    "^(https?)://(www[.])?site[0-9]{3}[.]com/(news|blog)/", ".*", "", "(?i)k\u212ai\u0130s", "a(?:b|c(?:d|ef))g", "(?P<x>ab)(?P=x)cd", "((ab|cd)|(ef|gh))ij",
])
def test_every_match_holds_a_piece(spark, pattern):
    """Brute force over random texts: no text that a pattern matches lacks all pieces of any of its covers."""
    rnd = random.Random(pattern)
    parts = ["abc", "abcd", "bcde", "foo", "barbaz", "qu", "qux", "hello", "HELLO", "y", "yzz", "xyz", "c", "e", "d", ".html", "/docs/", "7", "é", "https://", "www.", "site123", ".com/", "news/",
             "k\u212a", "K\u212aI\u0130S", "kki\u0130\u017f", "abab", "ij", "gh", "abd", "g", "ef"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(1, 6))) for _ in range(3000)]
    covers = covers_of(pattern)
    assert covers and len({len(p) for c in covers for p in c}) == 1
    hits = [t for t in texts if re.search(pattern, t)]
    rows = spark.createDataFrame([(t,) for t in hits], "u STRING").selectExpr(f"{pieces_of('u', f'array({len(covers[0][0])})')} AS p").collect()
    assert all(set(c) & set(r.p) for r in rows for c in covers)


def test_pattern_index_against_brute_force(spark):
    rnd = random.Random(5)
    names = [rnd.choice("abcdefgh") + str(i) for i in range(200)]
    entries = [{"name": n, "match_type": "regex", "match_pattern": p, "priority": rnd.randrange(4)} for n in names for p in [rnd.choice([
        f"/{n}/", f"(?i)/{n.upper()}$", f"{n[1:]}|x{n}", n[0], f"^http://[^/]+/{n}", rf"{n[1:]}\d", "(", "[a&&b]", f"({n})?/{n[:2]}", "(?P<a>[a-h])/(?P=a)"])]]
    entries += [{"name": "dom", "match_pattern": "b.com", "priority": 2}]
    urls = [f"http://{rnd.choice('abc')}.com/{rnd.choice(names)}/{rnd.choice(names)}" for _ in range(300)] + ["", "x", "http://b.com"]
    rules = ru.rule_set(ru.rules_from_list(spark, entries))
    assert rules.literal is None
    got = ru.route(spark.createDataFrame([(x,) for x in [*urls, None]], "url STRING"), rules, min_hot_rows=0)
    assert {r.url: r.rule_matched for r in got.collect()} == {**{x: brute_force(entries, x) for x in urls}, None: None}


def test_a_piece_is_shared_by_few_patterns_however_many_there_are(spark):
    """Numbers of all lengths behind a beginning that all patterns have: no number's pattern is tried on the URLs of another."""
    rows = spark.range(80, 20_080).selectExpr("CAST(id AS INT) AS rule_idx", "concat('r', id) AS name", "'regex' AS match_type", "concat('^https?://[^/]+/(de|en)/.*', id, '$') AS match_pattern",
                                              "'article' AS engine", "CAST(NULL AS STRING) AS css_selector", f"CAST(NULL AS {schemas.OPTIONS}) AS extra_options", "0 AS priority")
    rules = ru.rule_set(rows)
    assert ru.pattern_index(rules).groupBy("piece").count().agg(F.max("count")).first()[0] == 1
    urls = [f"http://x.example.com/de/{n}" for n in (80, 512, 1_234, 20_079, 2_222_222)]
    df = spark.createDataFrame([(u,) for u in urls], "url STRING")
    expected = {u: min((f"r{n}" for n in range(80, 20_080) if u.endswith(str(n))), key=lambda r: int(r[1:])) for u in urls}
    assert {r.url: r.rule_matched for r in ru.route(df, rules).collect()} == expected


def test_plan_does_not_grow_with_the_rules(spark, tmp_path):
    """10,000 patterns give the plan of 10, and take less than five times as long over the same URLs."""
    urls = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    plans, seconds = [], []
    for n in (10, 10_000):
        rows = spark.range(n).selectExpr("CAST(id AS INT) AS rule_idx", "concat('r', id) AS name", "'regex' AS match_type", "concat('/(de|en|fr)/0*', id, '[^0-9]') AS match_pattern",
                                         "'article' AS engine", "CAST(NULL AS STRING) AS css_selector", f"CAST(NULL AS {schemas.OPTIONS}) AS extra_options", "0 AS priority")
        save_rules(rows, str(tmp_path / f"n{n}"))
        rules = ru.rule_set(load_rules(spark, str(tmp_path / f"n{n}")), case_limit=0)
        ru.route(urls, rules).count()
        start = time.monotonic()
        got = ru.route(urls, rules)
        hits = got.filter("rule_matched IS NOT NULL").count()
        seconds.append(time.monotonic() - start)
        plans.append(re.sub(r"#\d+L?|v\d+|rules-\w+|plan_id=\d+|id=#\d+|\[id=.*?\]|_\d+", "", plan(got)))
    assert hits > 100 and len(plans[0]) == len(plans[1]) and seconds[1] < 5 * seconds[0]


def test_rules_of_one_rank_stay_apart(spark, tmp_path):
    """A line without an index and a later one with the same: each keeps its own name and engine."""
    (tmp_path / "r.json").write_text('{"name": "first", "match_pattern": "a.com", "engine": "article"}\n{"rule_idx": 0, "name": "second", "match_pattern": "b.com", "engine": "pruned"}\n'
                                     '{"rule_idx": 0, "name": "third", "match_pattern": "b.com", "engine": "x"}\n{"name": "re", "match_type": "regex", "match_pattern": "c[.]com", "engine": "y"}\n')
    df = spark.createDataFrame([("http://a.com/",), ("http://b.com/",), ("http://c.com/",)], "url STRING")
    for limit, form in ((None, "case"), (0, "join")):
        got = ru.route(df, ru.rule_set(load_rules(spark, str(tmp_path / "r.json")), case_limit=limit), strategy=form).collect()
        assert {r.url[7]: (r.rule_matched, r.rule_engine) for r in got} == {"a": ("first", "article"), "b": ("second", "pruned"), "c": ("re", "y")} and len(got) == 3


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_routing_reads_no_html_and_case_form_does_not_shuffle(spark):
    pages = read_pages(spark, "/root/testdata/sf0.001/pages.parquet")
    text = plan(ru.route(pages, ru.rule_set(ru.rules_from_list(spark, RULES))).select("page_id", "rule_matched"))
    assert "html" not in text.split("ReadSchema")[1] and "Exchange" not in text and "Join" not in text


def test_join_form_broadcasts_rules_of_checked_size(spark):
    pages = read_pages(spark, "/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    entries = ru.rule_set(ru.rules_from_list(spark, RULES))
    best = ru.best_domain_rule(pages.withColumn("domain", F.lit("a.b")), entries)
    assert "BroadcastHashJoin" in plan(best) and "NestedLoop" not in plan(best) and "Cartesian" not in plan(best)
