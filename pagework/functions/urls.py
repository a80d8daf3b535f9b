"""URL operators (U1-U7) as SQL expressions over URL strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagework.functions.text import WS, each, extract, keep, let, matches, non_empty, q, replace_all, strip_ws

URL_PATTERN = rf"https?://[^{WS},\]\)]+"
AUTHORITY_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"

# The characters whose compatibility form contains one of / ? # : @ and which
# therefore may not stand in an authority.
UNSAFE_AUTHORITY_CHARS = "⁇⁈⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫＃／：？＠"

_H16 = "[0-9A-Fa-f]{1,4}"
_V4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$"
_BRACKETED = r"\[([^\]]*)\]"


def extract_urls(text: str) -> str:
    """All URLs of a text in order, duplicates kept; a text that merely starts like a URL
    counts as one URL."""
    found = f"regexp_extract_all({text}, {q(URL_PATTERN)}, 0)"
    whole = let(strip_ws(text), lambda w: f"CASE WHEN {w} LIKE 'http://%' OR {w} LIKE 'https://%' THEN array({w}) END")
    return let(found, lambda f: f"coalesce(CASE WHEN size({f}) > 0 THEN {f} ELSE {whole} END, CAST(array() AS ARRAY<STRING>))")


def normalize_url_list(urls: str) -> str:
    """Trim every element and drop null and blank ones; order and duplicates stay."""
    return keep(each(urls, strip_ws), lambda u: f"{u} <> ''")


def strip_url(url: str) -> str:
    """The trimmed URL, or '' when it is null or blank."""
    return f"coalesce({strip_ws(url)}, '')"


def _valid_ipv6(host: str) -> str:
    def with_tail(bare: str, tail: str) -> str:
        # An embedded dotted quad takes the room of two groups.
        groups = f"CASE WHEN {tail} = '' THEN {bare} ELSE {replace_all(bare, r'[0-9]+[.][0-9.]+$', '0:0')} END"

        def check(g: str) -> str:
            filled = f"size({keep(f'split({g}, {q(":")})', lambda x: f'{x} <> {q("")}')})"
            full = matches(g, f"^{_H16}(?::{_H16}){{7}}$")
            short = matches(g, f"^(?:{_H16}(?::{_H16})*)?::(?:{_H16}(?::{_H16})*)?$")
            good = f"({full} OR ({short} AND {filled} <= 7)) AND ({tail} = '' OR {matches(tail, _V4)})"
            # No address is longer; a longer text must not reach the repeated groups.
            return f"CASE WHEN length({g}) <= 45 THEN {good} ELSE false END"

        return let(groups, check)

    tail = r"([0-9]+\.[0-9.]+)$"
    return let(
        replace_all(host, "%[^%]+$", ""),
        lambda bare: let(extract(bare, tail), lambda t: with_tail(bare, t)),
    )


def authority(url: str) -> str:
    """The authority of a URL, '' when there is none or it is malformed."""
    clean = f"translate({replace_all(url, r'^[\x00-\x20]+', '')}, '\t\r\n', '')"

    def check(a: str) -> str:
        inner = extract(a, _BRACKETED)
        good = let(inner, lambda i: f"({i} <> '' AND ({matches(i, r'^v[0-9A-Fa-f]+[.].+$')} OR {_valid_ipv6(i)}))")
        unsafe = matches(a, f"[{UNSAFE_AUTHORITY_CHARS}]")
        return (
            f"CASE WHEN {a} IS NULL OR {unsafe} THEN '' "
            f"WHEN {matches(a, r'[\[\]]')} THEN CASE WHEN {good} THEN {a} ELSE '' END ELSE {a} END"
        )

    return let(extract(clean, AUTHORITY_PATTERN), check)


def is_valid_url(url: str) -> str:
    """U4: lower-case http:// or https:// prefix and a well-formed, non-empty authority."""
    return (
        f"coalesce(CASE WHEN {url} LIKE 'http://%' OR {url} LIKE 'https://%' "
        f"THEN {authority(url)} <> '' END, false)"
    )


def filter_valid(urls: str) -> str:
    """U5 on an array column."""
    return keep(urls, is_valid_url)


def validate_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """U5 on rows: keep the rows whose URL is valid."""
    return df.filter(F.expr(is_valid_url(url)))


def url_domain(url: str) -> str:
    """Lower-cased authority, port and user info included; '' when there is none."""
    return f"lower({authority(url)})"


def url_hostname(url: str) -> str:
    """Host alone, without user info and port; null when there is none."""
    return non_empty(replace_all(replace_all(url_domain(url), "^.*@", ""), ":[0-9]*$", ""))


def truncate_content(content: str, max_length: int) -> str:
    """At most ``max_length`` characters, followed by '...' when something was cut."""
    return (
        f"CASE WHEN length({content}) <= {max_length} THEN {content} "
        f"ELSE concat(substring({content}, 1, {max_length}), '...') END"
    )
