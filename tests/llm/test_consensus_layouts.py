"""HTML extraction on generated layouts with known text, on pages that are cut off, and on broken markup."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pagework.llm.html_consensus import extract_pages, main_text, read_page

WORDS = "river stone garden window letter market morning bridge silver winter paper island".split()


def sentence(rnd, n=14):
    return " ".join(rnd.choices(WORDS, k=n)).capitalize() + "."


@pytest.mark.parametrize("source", [
    "<div " + 'a="b" ' * 1000, "<a " * 8000, "<p>text</p><div " + "a='b\" " * 2000, "<!" * 8000, "<a \"<b\" '<c' " * 3000, "</a " * 8000, "<a / " * 5000 + "<",
    "<div class=\"x\" title='a > b' " * 1000, "<" * 20000, "<a b=" + "\"" * 9999,
])
def test_cut_pages_take_no_longer_than_others(source):
    start = time.process_time()
    read_page("<article><p>before</p></article>" + source)
    page = read_page("<article><p>before and after</p>" + source)
    assert time.process_time() - start < 1 and page.blocks[0][0] == "before and after"


def test_broken_tags():
    texts = {
        "<p>a<b title='x > y'>b</b></p>": "ab", "<p title=\"it's\">it's \"quoted\" here</p>": "it's \"quoted\" here", "<p>1 < 2 and 3 > 2</p>": "1 < 2 and 3 > 2",
        "<p class=x/y>path</p>": "path", "<p>a<br/>b<img src='a>b'/>c</p>": "a bc", "<p>one<a href=x<b>two</b></p>": "onetwo", "<p>end <a href='never closed": "end",
        "<p>x<!-- <p>no</p> -->y</p>": "xy", "<p/>self<p a='1'/>": "self",
    }
    for source, text in texts.items():
        assert main_text(read_page(source), []) == text, source


def page_of(rnd, kind):
    """HTML and the text that an extractor has to find, for a layout."""
    title, lead, body = sentence(rnd, 5), sentence(rnd), [sentence(rnd, rnd.randrange(8, 40)) for _ in range(rnd.randrange(3, 9))]
    menu = "<ul class='menu'>" + "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in WORDS) + "</ul>"
    share = "<div class='tools'><a href='/s'>send</a> <a href='/m'>mail</a></div>"
    paragraphs = "".join(f"<p>{b}</p>" for b in body)
    if kind == "plain":
        inner, said = f"<article><h1>{title}</h1>{paragraphs}</article>", [title, *body]
    elif kind == "body":
        inner, said = f"<div class='story'>{share}<div class='body'>{paragraphs}</div></div>", body
    elif kind == "lead":
        inner, said = f"<div class='story'><div class='lead'><p>{lead}</p></div>{share}<div class='body'>{paragraphs}</div></div>", [lead, *body]
    else:
        inner, said = f"<main><h1>{title}</h1><div class='wrap'><div class='text'>{paragraphs}</div></div></main>", [title, *body]
    furniture = f"<header>{menu}</header>", f"<div class='sidebar'><p>{sentence(rnd, 30)}</p></div><footer>all rights</footer><form>sign in</form>"
    return f"<html><head><title>{title}</title></head><body>{furniture[0]}{inner}{furniture[1]}</body></html>", said


def test_layouts(spark):
    """A hot host of two layouts, hosts of one, and pages with a lead on a host whose other pages have none."""
    rnd = random.Random(3)
    rows, want = [], {}
    for i in range(240):
        host, kind = ("hot.com", "plain" if i % 4 else "main") if i % 3 == 0 else ("lead.com", "lead" if i % 6 == 1 and i > 60 else "body") if i % 3 == 1 else (f"h{i % 5}.com", ("plain", "main", "lead")[i % 5 % 3])
        source, said = page_of(rnd, kind)
        rows.append((i, f"http://{host}/{i}", source))
        want[i] = said
    got = {r.page_id: r.text.split("\n") for r in extract_pages(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").repartition(4)).collect()}
    lost = {i: set(want[i]) - set(got[i]) for i in want if set(want[i]) - set(got[i])}
    assert not lost
    # The links beside a lead may come with it; nothing else does.
    assert all([t for t in got[i] if t != "send mail"] == want[i] for i in want)


def test_lead_beside_the_host_path(spark):
    rnd = random.Random(1)
    rows = [(k, f"http://a/{k}", page_of(rnd, "body")[0]) for k in range(5)] + [(5, "http://a/5", page_of(random.Random(9), "lead")[0]), (6, "http://b/6", page_of(random.Random(9), "lead")[0])]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    assert got[5] == got[6] and page_of(random.Random(9), "lead")[1][0] in got[5]


def test_long_and_awkward_pages(spark):
    long = "<article>" + "".join(f"<p>paragraph {k} of many</p>" for k in range(60_000)) + "</article>"
    rows = [(1, "http://h/1", long), (2, None, "<p>no address</p>"), (None, "http://h/2", "<p>no id</p>"), (3, "http://h/3", "   "), (4, "not an address", "just text")]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").withColumns({"n_chars": F.lit(-1), "paths": F.lit("p"), "host": F.lit("h")})
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    assert got[1].text.count("\n") == 59_999 and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[None].text, got[3].text, got[4].text) == ("no address", "no id", "", "just text") and got[1].host == "h" and got[1].paths == "p"
