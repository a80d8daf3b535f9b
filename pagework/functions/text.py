"""Text helpers.

The functions of this package take and return Spark SQL expressions as text, to be used with
``F.expr``/``selectExpr`` or embedded in one another. A whole extraction is then one expression
that the JVM parses at once; the same tree built from Column objects takes thousands of round trips
between Python and the JVM for every query.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable
from html.entities import html5

# Unicode white space. Java's \s and Spark's trim() know only parts of this set.
WS = r"\s\x0b\x1c-\x1f\x85\p{Z}"

# Frequent named entities, replaced in one cheap pass each. Anything rarer goes through the
# general branch of decode_entities; &amp; is always last.
COMMON_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&nbsp;": " ",
    "&copy;": "©",
    "&middot;": "·",
    "&hellip;": "…",
    "&ndash;": "–",
    "&mdash;": "—",
}

_names = itertools.count()


def q(value: str | bool | int | float | None) -> str:
    """A SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def q_list(values: list[str] | tuple[str, ...]) -> str:
    return ", ".join(q(v) for v in values)


def let(value: str, body: Callable[[str], str]) -> str:
    """``body(value)`` with ``value`` computed once, however often the body mentions it.

    Without the binding, nested expressions that use their input several times make the plan grow
    exponentially.
    """
    name = f"v{next(_names)}"
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def non_empty(c: str) -> str:
    """``c``, or null when it is ''. Unlike nullif(), this never copies the expression ``c``."""
    return let(c, lambda x: f"CASE WHEN {x} <> '' THEN {x} END")


def each(array: str, body: Callable[[str], str]) -> str:
    name = f"v{next(_names)}"
    return f"transform({array}, {name} -> {body(name)})"


def keep(array: str, condition: Callable[[str], str]) -> str:
    name = f"v{next(_names)}"
    return f"filter({array}, {name} -> {condition(name)})"


def choose(condition: bool | str, then: str, otherwise: str) -> str:
    """A choice that is made while planning when the condition is a plain bool."""
    if isinstance(condition, bool):
        return then if condition else otherwise
    return f"CASE WHEN {condition} THEN {then} ELSE {otherwise} END"


def replace_all(c: str, pattern: str, by: str) -> str:
    return f"regexp_replace({c}, {q(pattern)}, {q(by)})"


def extract(c: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({c}, {q(pattern)}, {group})"


def matches(c: str, pattern: str) -> str:
    return f"({c} RLIKE {q(pattern)})"


def strip_ws(c: str) -> str:
    """Trim Unicode white space on both sides."""
    return replace_all(c, f"^[{WS}]+|[{WS}]+$", "")


def collapse_ws(c: str) -> str:
    """Every run of white space becomes one space. Single spaces do not match, so ordinary text is
    only scanned."""
    return replace_all(c, f"[{WS}&&[^ ]][{WS}]*| [{WS}]+", " ")


def code_point_to_string(n: str) -> str:
    """The character of a code point; the replacement character for control characters and for
    numbers outside Unicode."""
    
    def allowed(x: str) -> str:
        ok = f"({x} >= 32 OR {x} IN (9, 10, 13)) AND {x} <= 1114111 AND ({x} < 55296 OR {x} > 57343)"
        return f"CASE WHEN {ok} THEN {x} ELSE 65533 END"

    return f"decode(unhex(lpad(hex({let(n, allowed)}), 8, '0')), 'UTF-32')"


def _decode_numeric(c: str) -> str:
    def piece(s: str, i: str) -> str:
        dec, hexa = extract(s, "^0*([0-9]{1,7});"), extract(s, "^[xX]0*([0-9a-fA-F]{1,6});")
        beyond = matches(s, "^(0*[1-9][0-9]{7,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{6,});")  # past the last code point
        rest = f"substr({s}, locate(';', {s}) + 1)"
        from_dec = code_point_to_string(f"try_cast({dec} AS BIGINT)")
        from_hex = code_point_to_string(f"try_cast(conv({hexa}, 16, 10) AS BIGINT)")
        return (
            f"CASE WHEN {i} = 0 THEN {s} WHEN {dec} <> '' THEN concat({from_dec}, {rest}) "
            f"WHEN {hexa} <> '' THEN concat({from_hex}, {rest}) WHEN {beyond} THEN concat(decode(unhex('FFFD'), 'UTF-16BE'), {rest}) ELSE concat('&#', {s}) END"
        )

    def decoded(x: str) -> str:
        pieces = f"transform(split({x}, '&#', -1), (s, i) -> {piece('s', 'i')})"
        return f"CASE WHEN contains({x}, '&#') THEN array_join({pieces}, '') ELSE {x} END"

    return let(c, decoded)


# One JSON literal that Catalyst folds to a constant map.
_NAMES = json.dumps({n[:-1]: char for n, char in sorted(html5.items()) if n.endswith(";") and n != "amp;"})


def _decode_rare(c: str) -> str:
    def piece(s: str, i: str) -> str:
        name = extract(s, "^([A-Za-z][A-Za-z0-9]{1,31});")
        hit = f"try_element_at(from_json({q(_NAMES)}, 'MAP<STRING, STRING>'), {name})"
        whole = let(hit, lambda h: f"CASE WHEN {h} IS NOT NULL THEN concat({h}, substr({s}, length({name}) + 2)) ELSE concat('&', {s}) END")
        return f"CASE WHEN {i} = 0 THEN {s} ELSE {whole} END"

    def decoded(x: str) -> str:
        rare = matches(f"replace({x}, '&amp;', '')", "&[A-Za-z][A-Za-z0-9]{1,31};")
        pieces = f"transform(split({x}, '&', -1), (s, i) -> {piece('s', 'i')})"
        return f"CASE WHEN {rare} THEN array_join({pieces}, '') ELSE {x} END"

    return let(c, decoded)


def decode_entities(c: str) -> str:
    """HTML character references to characters, in expressions only."""
    for entity, char in COMMON_ENTITIES.items():
        c = f"replace({c}, {q(entity)}, {q(char)})"
    return f"replace({_decode_rare(_decode_numeric(c))}, '&amp;', '&')"


def escape_html(c: str) -> str:
    """The three characters that must not appear raw in HTML text."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = f"replace({c}, {q(char)}, {q(entity)})"
    return c
