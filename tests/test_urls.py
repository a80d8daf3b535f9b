"""URL operators against tables of cases, and their properties on random texts."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagework.functions import text as tx
from pagework.functions import urls as u


def evaluate(spark, values, expression, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    rows = df.select("i", F.expr(expression).alias("y")).collect()
    return [
        r.y for r in sorted(rows, key=lambda r: r.i)
    ]


EXTRACT = [
    ("see http://a.com, (https://b.org/x) and [http://c.net]", ["http://a.com", "https://b.org/x", "http://c.net"]),
    ("http://a.com　http://b.com\x1fhttp://c.com\x85end", ["http://a.com", "http://b.com", "http://c.com"]),
    ("http://)", ["http://)"]),
    ("  http:// ", ["http://"]),
    ("HTTP://A.com", []),
    ("http://http://x.com", ["http://http://x.com"]),
    ("http://a.com，next", ["http://a.com，next"]),
    ("http://a.com http://a.com", ["http://a.com", "http://a.com"]),
    ("nothing", []),
    ("", []),
    (None, []),
]


def test_extract_urls(spark):
    assert evaluate(spark, [t for t, _ in EXTRACT], u.extract_urls("x")) == [e for _, e in EXTRACT]


def test_normalize_and_filter_lists(spark):
    values = [[" http://a.com ", None, "\t", "ftp://b", "　http://a.com\x1f"], []]
    assert evaluate(spark, values, u.normalize_url_list("x"), "ARRAY<STRING>") == [
        ["http://a.com", "ftp://b", "http://a.com"], []
    ]
    assert evaluate(spark, values, u.filter_valid(u.normalize_url_list("x")), "ARRAY<STRING>") == [
        ["http://a.com", "http://a.com"], []
    ]


# Address, whether it is valid, and its domain.
ODD = [
    ('http://example.com', True, 'example.com'),
    ('https://u:p@Example.COM:8080/x', True, 'u:p@example.com:8080'),
    ('http://', False, ''),
    ('https:///p', False, ''),
    ('http://a b/c', True, 'a b'),
    ('http://a.com?x', True, 'a.com'),
    ('http://a.com#f', True, 'a.com'),
    ('http://[bad/x', False, ''),
    ('http://bad]/x', False, ''),
    ('http://[::1]/', True, '[::1]'),
    ('http://[::1]:80/', True, '[::1]:80'),
    ('http://[1:2:3:4:5:6:7:8]/', True, '[1:2:3:4:5:6:7:8]'),
    ('http://[1:2:3]/', False, ''),
    ('http://[::ffff:1.2.3.4]/', True, '[::ffff:1.2.3.4]'),
    ('http://[::ffff:1.2.3.999]/', False, ''),
    ('http://[v1.abc]/', True, '[v1.abc]'),
    ('http://[1.2.3.4]/', False, ''),
    ('http://x[::1]/', True, 'x[::1]'),
    ('http://ünï.example/', True, 'ünï.example'),
    ('http://a.com：80/x', False, ''),
    ('ftp://host/x', False, 'host'),
    ('//host/x', False, 'host'),
    ('host/x', False, ''),
    ('HTTP://a.com', False, 'a.com'),
    (' http://a.com', False, 'a.com'),
    ('http:\t//a.com', False, 'a.com'),
    ('http://a\t.com/', True, 'a.com'),
    ('http://a.com|b', True, 'a.com|b'),
    ('http://a.com\\b', True, 'a.com\\b'),
    ('http://a%zz/', True, 'a%zz'),
    ('http://@/', True, '@'),
    ('http://:80/', True, ':80'),
    ('mailto:x@y', False, ''),
    ('', False, ''),
]


def test_valid_and_domain(spark):
    urls = [x for x, _, _ in ODD]
    assert evaluate(spark, urls, u.is_valid_url("x")) == [valid for _, valid, _ in ODD]
    assert evaluate(spark, urls, u.url_domain("x")) == [domain for _, _, domain in ODD]
    assert evaluate(spark, [None], u.is_valid_url("x")) == [False]
    assert evaluate(spark, [None], u.url_domain("x")) == [""]


_text = st.lists(st.text(alphabet="htps:/.[]?#@ab1 \t\n,)(é　\x1f\x85​：", max_size=25), min_size=40, max_size=40)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(_text)
def test_random_texts(spark, texts):
    prefixed = ["http://" + t for t in texts] + texts
    valid = evaluate(spark, prefixed, u.is_valid_url("x"))
    domains = evaluate(spark, prefixed, u.url_domain("x"))
    plain = [x.translate({ord(c): None for c in "\t\n\r"}).lower() for x in prefixed]
    for x, shown, ok, domain in zip(prefixed, plain, valid, domains):
        assert not ok or x[:4] == "http" and "://" in x[:8] and domain
        assert domain in shown and not set(domain) & set("/?#")
    assert evaluate(spark, prefixed, tx.strip_ws("x")) == [x.strip() for x in prefixed]
    for x, found in zip(prefixed, evaluate(spark, prefixed, u.extract_urls("x"))):
        assert all(f in x and f[:4] == "http" for f in found)
        assert len(found) < 2 or "".join(found) == "".join(f for f in found if not set(f) & set(" ,)]\n\t"))
        assert found or "http://" not in x.strip()[:7]


def test_white_space_is_pythons(spark):
    points = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000 and i != 0]
    assert evaluate(spark, points, tx.strip_ws("x")) == [c.strip() for c in points]


@pytest.mark.parametrize("text,n,expected", [
    ("abc", 3, "abc"), ("abcd", 3, "abc..."), ("", 3, ""), ("ab😀cd", 3, "ab😀..."), ("ab😀", 3, "ab😀"),
])
def test_truncate(spark, text, n, expected):
    assert evaluate(spark, [text], u.truncate_content("x", n)) == [expected]
