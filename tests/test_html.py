"""Extraction from hand-written pages: native expressions, the block pass, and the engines."""

import html as stdlib_html
import random

import pytest
from pyspark.sql import functions as F

from pagework import errors
from pagework.config import ArticleOptions, Config, PrunedOptions
from pagework.functions import blocks as bl
from pagework.functions import native_html as nh
from pagework.functions import text as tx
from pagework.functions.html_tree import html_blocks, page_blocks, parse_selector, select_html
from pagework.operators.batch import parse_pages
from pagework.operators.engines import Registry, article_engine, pruned_engine, python_engine
from pagework.operators.rules import rule_set, rules_from_list

PAGE = """<!DOCTYPE html><html lang="en-GB"><head><title>A &amp; B</title>
<meta name="author" content="Ann"><meta property='og:site_name' content='The Site'>
<script type="application/ld+json">{"@type":"Article","datePublished":"2024-02-03T01:02:03Z"}</script>
<style>p{}</style></head><body><header><h1>Site name</h1></header>
<nav><ul><li><a href="/a">Alpha link</a></li><li><a href="/b">Beta link</a></li></ul></nav>
<!-- <p>hidden</p> --><div class="modal big"><p>Please accept our cookies before reading on.</p></div>
<article><h1>Main &lt;headline&gt;</h1><p>First   paragraph with a <a href="/l">link</a> in it.
<p>First   paragraph with a <a href="/l">link</a> in it.</p><ul><li>one<li><p>two</p></ul>
<table><tr><th>k</th><th>v</th></tr><tr><td>a</td><td>1</td></tr></table>
<script>var t = "</p>";</script><pre>x = 1
y = 2</pre><div class="comments"><p>Nice remark!</p></div><aside>Related stuff</aside></article>
<footer>&copy; 2024</footer></body></html>"""


def one(spark, html, expression):
    return spark.createDataFrame([(html,)], "html STRING").select(F.expr(expression).alias("x")).first().x


def parse(spark, html, url="http://a.com/p", rules=None, config=None, registry=None, **options):
    df = spark.createDataFrame([(0, url, html)], "page_id BIGINT, url STRING, html STRING")
    compiled = None if rules is None else rule_set(rules_from_list(spark, rules))
    return parse_pages(df, compiled, registry, config, **options).first()


def article(spark, html=PAGE, url="http://a.com/p", **options):
    rule = [{"name": "r", "match_pattern": "a.com", "engine": "article", "extra_options": options}]
    return parse(spark, html, url, rule, Config(engine_order=("pruned",)), Registry().register("article", article_engine(ArticleOptions())))


def test_article_text(spark):
    got = article(spark)
    assert got.success and got.title == "A &amp; B" and got.content_format == "markdown"
    assert got.content.split("\n\n") == [
        "# Main <headline>", "First paragraph with a link in it.", "- one", "- two", "k | v", "a | 1", "x = 1 y = 2",
    ]
    m = got.metadata
    assert (m.author, m.sitename, m.date, m.language, m.hostname) == ("Ann", "The Site", "2024-02-03", "en", "a.com")


@pytest.mark.parametrize("options,present,absent", [
    ({"include_tables": False}, ["- two"], ["a | 1"]),
    ({"include_comments": True}, ["Nice remark!"], []),
    ({"include_links": True}, ["a link (/l) in"], []),
    ({"prune_xpath": ["//table", "//div[@class='comments']"]}, ["- two"], ["a | 1", "remark"]),
    ({"prune_xpath": "//*[@id='none']"}, ["a | 1", "First paragraph with a link in it."], ["remark", "Related", "Alpha"]),
    ({"output_format": "html"}, ["<h1>Main &lt;headline&gt;</h1>", "<li>one</li>"], ["- one"]),
    ({"output_format": "txt"}, ["Main <headline>\nFirst"], ["# Main"]),
])
def test_article_options(spark, options, present, absent):
    got = article(spark, **options)
    assert got.success, got.error
    assert all(x in got.content for x in present) and not any(x in got.content for x in absent), got.content


def test_deduplication_is_an_option(spark):
    assert article(spark, deduplicate=False).content.count("First paragraph") == 2
    assert article(spark).content.count("First paragraph") == 1


def test_unsupported_path_is_a_failed_attempt(spark):
    got = article(spark, prune_xpath="//a/b")
    assert not got.success and got.error_code == errors.ALL_ENGINES_FAILED


@pytest.mark.parametrize("html,expected", [
    ("<p>only paragraph</p>", "only paragraph"),
    ("<body><p>no end", "no end"),
    ("<article></article><main><p>m</p></main>", "m"),
    ("<article><p>a</p></article><article><p>b</p></article>", "a\n\nb"),
    ("<html><head><title>t</title></head>text", "text"),
    ("<p>a&nbsp;&#65;&#x42;&hearts;&amp;lt;</p>", "a AB♥&lt;"),
])
def test_article_edge_cases(spark, html, expected):
    assert article(spark, html).content == expected


@pytest.mark.parametrize("html", ["<html><nav>x</nav></html>", "<article></article>", "  ", "<style>a</style>"])
def test_nothing_to_extract(spark, html):
    got = parse(spark, html, engine="article")
    assert (got.success, got.error_code, got.engine_used) == (False, errors.EXTRACT_NONE, "article")


def test_empty_page_codes(spark):
    assert parse(spark, "", engine="article").error_code == errors.FETCH_EMPTY
    assert parse(spark, None, engine="pruned").error_code == errors.RENDER_FAILED
    assert parse(spark, "<p> </p>", engine="pruned").error_code == errors.RENDER_NO_CONTENT
    assert parse(spark, PAGE, engine="article", css=".none").error_code == errors.CSS_NO_MATCH
    assert parse(spark, PAGE, engine="pruned", css=".none").error_code == errors.RENDER_NO_CONTENT
    got = parse(spark, PAGE, engine="article", css="p:hover")
    assert got.error_code == errors.ENGINE_EXCEPTION and "unsupported selector" in got.error


@pytest.mark.parametrize("html,pruned,plain", [
    ("<title> x\ny </title><p>text text</p>", "x\ny", "x\ny"),
    ("<title></title><p>text text</p>", "", errors.UNTITLED),
    ("<p>text text</p>", errors.UNTITLED, errors.UNTITLED),
    ("<TITLE id=1>q &amp; a</TITLE><p>text text</p>", "q &amp; a", "q &amp; a"),
])
def test_titles(spark, html, pruned, plain):
    assert parse(spark, html, engine="pruned").title == pruned
    assert parse(spark, html, engine="article").title == plain


def test_blocks_and_paths():
    got = [(b[0], b[1].rsplit("/", 2)[-2:], b[2]) for b in page_blocks(PAGE)]
    assert ("li", ["ul", "li"], "one") in got and ("p", ["li", "p"], "two") in got
    assert ("tr", ["table", "tr"], "a | 1") in got and ("pre", ["article", "pre"], "x = 1\ny = 2") in got
    assert not any("hidden" in b[2] or "var t" in b[2] for b in got)
    assert [b[3] for b in page_blocks('<p>see <a href="x">this one</a></p>')] == [8]
    assert page_blocks('<div class="a/b c.d" id="x#y"><p>t') == [("p", "/div#x%23y.a%2Fb.c%2Ed/p", "t", 0, "t")]


@pytest.mark.parametrize("css,expected", [
    ("li", '<li><a href="/a">Alpha link</a></li><li><a href="/b">Beta link</a></li><li>one<li><p>two</p>'),
    ("nav > ul > li a[href='/b']", '<a href="/b">Beta link</a>'),
    ("article .comments, footer", '<div class="comments"><p>Nice remark!</p></div><footer>&copy; 2024</footer>'),
    ("div.modal.big p", "<p>Please accept our cookies before reading on.</p>"),
    ("[href$=a]", '<a href="/a">Alpha link</a>'), ("article > a", ""), ("#x", ""),
])
def test_selectors(css, expected):
    assert select_html(PAGE, parse_selector(css)) == expected


@pytest.mark.parametrize("css", ["p:first-child", "a + b", "", "> p", "p >", "a,,b"])
def test_unsupported_selectors(css):
    with pytest.raises(ValueError):
        parse_selector(css)


def test_deep_and_broken_pages():
    deep = page_blocks("<div>x" * 20_000)
    assert len(deep) == 20_000 and {b[1] for b in deep[3:]} == {"/div/div/div"}
    nested = page_blocks("<div class=modal>" + "<div>" * 300 + "<div class=ad><p>x")
    assert [b[1] for b in nested] == ["/div.modal/div/div.ad/p"]
    within = page_blocks("<div>" * 300 + "<div class=modal>" + "<div>" * 300 + "<p>x")
    assert [b[1] for b in within] == ["/div/div.modal/div/p"]
    page_blocks("<b>" * 20_000 + "<p>x" * 20_000), page_blocks("</i>" * 100_000)
    assert len(select_html("<div>" * 2000, parse_selector("div div > div div"))) > 0
    for broken in ("<", "<p", "<p title=\"x>y</p>", "</p></div>", "<!--", "<script>", "<a href='", "\x00"):
        page_blocks(broken), select_html(broken, parse_selector("p"))


def test_entities_like_the_standard_library(spark):
    samples = ["a &lt;b&gt; &amp;amp; &quot;&apos;", "&copy;&middot;&hellip;", "&#8364;&#x20ac;&#X41;", "&zzzz; &", "&eacute;&Alpha;&NotEqualTilde;", "&#xD800;", "no entity", "&amp;#65;"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i INT, x STRING")
    got = [r.y for r in df.select("i", F.expr(tx.decode_entities("x")).alias("y")).orderBy("i").collect()]
    assert got == [stdlib_html.unescape(s) for s in samples]


def test_pruned_engine(spark):
    got = parse(spark, PAGE, engine="pruned")
    assert got.content_format == "markdown" and got.metadata.author is None
    assert "# Main <headline>" in got.content and "| a | 1 |" in got.content and "```\nx = 1\ny = 2\n```" in got.content
    assert "Alpha link" not in got.content and "cookies" not in got.content and "2024" not in got.content
    shown = Registry().register("pruned", pruned_engine(PrunedOptions(remove_overlay_elements=False)))
    assert "cookies" in parse(spark, PAGE, registry=shown, engine="pruned").content


def test_threshold_never_adds_blocks(spark):
    df = spark.createDataFrame([(PAGE,)], "html STRING").select(html_blocks(F.col("html")).alias("b"))
    kept = [
        {x.pos for x in df.select(F.expr(bl.prune_blocks("b", f"{t / 10}D")).alias("k")).first().k} for t in range(11)
    ]
    assert len(kept[0]) == len(page_blocks(PAGE)) and all(a >= b for a, b in zip(kept, kept[1:]))


def test_all_filtered_falls_back_to_everything(spark):
    strict = Registry().register("pruned", pruned_engine(PrunedOptions(content_filter_threshold=1.0)))
    assert parse(spark, "<nav><a href='x'>hi</a></nav>", registry=strict, engine="pruned").content == "hi"


@pytest.mark.parametrize("text,lang", [
    ("the cat and the dog of it", "en"), ("le chat et la table dans une maison", "fr"),
    ("der Hund und die Katze nicht", "de"), ("zzz qqq", None), ("", None),
])
def test_language_vote(spark, text, lang):
    assert one(spark, text, nh.voted_language("html")) == lang
    assert one(spark, f'<html class="x" lang="PT-br"><p>{text}', nh.page_language("html", "html")) == "pt"


def test_language_filter(spark):
    only = Registry().register("article", article_engine(ArticleOptions(target_language="de")))
    assert parse(spark, PAGE, registry=only, engine="article").error_code == errors.EXTRACT_NONE
    assert parse(spark, PAGE.replace("en-GB", "de"), registry=only, engine="article").success


NESTED = {
    "<article>a<article>inner</article>tail</article>": ["a", "inner", "tail"],
    "<article>a<div class='ad'>x<div>y</div>now</div>b</article>": ["a", "b"],
    "<article>a<div class=ad>x</div>b<div id = sponsor >y</div>c</article>": ["a", "b", "c"],
    "<article><div class=\"big ad\">x<div></article><p>out</p>": ["out"],
    "<article>a<div class='ad'>x<p>y</article><footer>f": ["a"],
    "<article>a</section></div>b<nav>m<nav>n</nav>o</nav>c</article>d": ["a", "b", "c"],
    "<main>a<div><div class='ads'>x</div>b</div></main>": ["a", "b"],
    "<body>a<aside>x<aside>y</aside>z</aside>b</nav>c</body>": ["a", "b", "c"],
    "<article></article><main>m</main>": ["m"], "<article>one</article>x<article>two</article>": ["one", "two"],
    "<article>a<div class=added>b</div><div class='x' id='y'>c</div></article>": ["a", "b", "c"],
    "<DIV CLASS='AD'>x</DIV><Article>A</Article>": ["A"], "<article>a<table><tr><td>1<table><tr><td>2</table>3</table>b": ["a", "1", "2", "3", "b"],
    "<div class='comments'><div>c</div>d</div>e": ["e"], "<article>a<ul class=\"ad\"><li>x<ul><li>y</ul><li>z</ul>b</article>": ["a", "b"],
}


def test_nested_containers(spark):
    df = spark.createDataFrame(list(NESTED.items()), "html STRING, want ARRAY<STRING>")
    got = df.select("html", "want", F.expr(f"transform({nh.article_blocks('html')}, b -> {nh.block_text('b')})").alias("got")).collect()
    assert {r.html: r.got for r in got} == {r.html: r.want for r in got}


def test_random_nesting_against_a_stack(spark):
    """Random container tags, opened, closed, left open and stray, against a plain stack of open elements."""
    rnd = random.Random(11)
    tags = [("div", ""), ("div", " class='ad x'"), ("section", " id=comments"), ("section", ""), ("nav", ""), ("aside", ""), ("article", ""), ("table", ""), ("ul", ""), ("main", "")]
    rows = []
    for i in range(400):
        source, said, stack, skip = "", [], [], 0
        for k in range(rnd.randrange(1, 25)):
            if rnd.random() < 0.45 and stack:
                tag = rnd.choice(stack) if rnd.random() < 0.8 else rnd.choice(tags)[0]
                source += f"</{tag}>"
                if tag in stack:
                    at = len(stack) - stack[::-1].index(tag)
                    stack, skip = stack[: at - 1], 0 if at <= skip else skip
            else:
                tag, more = rnd.choice(tags)
                source += f"<{tag}{more}>"
                stack.append(tag)
                if not skip and (more not in ("",) or tag in ("nav", "aside")):
                    skip = len(stack)
            source += f"t{k}"
            if not skip:
                said.append((f"t{k}", "article" in stack, "main" in stack))
        for kind in (1, 2):
            if any(x[kind] for x in said):
                said = [x for x in said if x[kind]]
                break
        rows.append((source, [x[0] for x in said]))
    df = spark.createDataFrame(rows, "html STRING, want ARRAY<STRING>")
    got = df.select("html", "want", F.expr(f"transform({nh.article_blocks('html')}, b -> {nh.block_text('b')})").alias("got")).collect()
    assert [(r.html, r.got) for r in got if r.got != r.want] == []


def test_native_and_tree_extraction_agree(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    tree = bl.mark_blocks(bl.main_blocks("b"), False)
    got = pages.select("html", html_blocks(F.col("html")).alias("b")).select(
        F.expr(nh.article_blocks("html")).alias("native"), F.expr(tree).alias("tree")
    )
    assert got.filter("native <> tree").count() == 0


def test_python_engine_failures_stay_in_their_row(spark):
    def fn(url, html, css):
        if "bad" in url:
            raise RuntimeError("broken page")
        return {"title": "t", "content": html.upper(), "content_format": "text"}

    registry = Registry().register("own", python_engine("own", fn))
    df = spark.createDataFrame([(0, "http://bad/", "x"), (1, "http://good/", "x"), (2, "http://none/", "")], "page_id BIGINT, url STRING, html STRING")
    rows = {r.pos: r for r in parse_pages(df, None, registry, engine="own").collect()}
    assert (rows[0].error_code, rows[0].error, rows[0].engine_used) == (errors.ENGINE_EXCEPTION, "broken page", "")
    assert (rows[1].content, rows[1].content_format, rows[1].engine_used) == ("X", "text", "own")
    assert rows[2].error_code == errors.FETCH_EMPTY and rows[2].engine_used == "own"


def test_configuration_bounds():
    for bad in (dict(max_content_length=100), dict(max_content_length=60_000)):
        with pytest.raises(ValueError):
            Config(**bad)
    with pytest.raises(ValueError):
        PrunedOptions(content_filter_threshold=1.5)
    with pytest.raises(ValueError):
        ArticleOptions(target_language="deu")
