"""Regular expressions of site rules: Java's dialect, and the literal pieces that a match must hold."""

from __future__ import annotations

import re
from re import _parser as syntax

import pyarrow as pa
from pyspark.sql import types as T

from pagework.functions.text import let

PIECE = 16  # most characters of an indexed piece; shorter literals are pieces as they are
# Characters whose lower case, or which without regard to case, equal a plain letter.
FOLDED = {"İ": "i", "ı": "i", "ſ": "s", "\u212a": "k"}

PATTERN_TYPE = T.StructType([
    T.StructField("java", T.StringType()),
    T.StructField("covers", T.ArrayType(T.ArrayType(T.StringType()))),
])

_QUANTIFIER = re.compile(r"\{(\d*)(,?)(\d*)\}")
_NAMED = re.compile(r"\(\?P<(\w+)>|\(\?P=(\w+)\)")


def _is_python(pattern: str) -> bool:
    try:
        re.compile(pattern)
        return True
    except (re.error, OverflowError, RecursionError):
        return False


def java_pattern(pattern: str) -> str | None:
    """A Python pattern in Java's dialect, or None when Python itself rejects it.

    Java allows only letters and digits in group names, reads ``[`` and ``&&`` inside a class as set
    operations, has no ``{,n}`` and no plain ``{``, and spells the end of the text ``\\z``.
    """
    if not _is_python(pattern):
        return None
    names: dict[str, str] = {}
    out, i, in_class = [], 0, False
    while i < len(pattern):
        c, step = pattern[i], 1
        if c == "\\":
            c, step = pattern[i : i + 2], 2
            c = r"\z" if c == r"\Z" and not in_class else c
        elif in_class:
            in_class = c != "]"
            c = "\\" + c if c in "[&" else c
        elif c == "[":
            in_class = True
            start = "[^" if pattern.startswith("[^", i) else "["
            step = len(start)
            c = start
            if pattern.startswith("]", i + step):  # a bracket right at the start is a plain one
                c, step = start + r"\]", step + 1
        elif m := _NAMED.match(pattern, i):
            name = names.setdefault(m[1] or m[2], f"g{len(names) + 1}")
            c, step = (f"(?<{name}>" if m[1] else rf"\k<{name}>"), len(m[0])
        elif c == "{":
            m = _QUANTIFIER.match(pattern, i)
            if m and (m[1] or (m[2] and m[3])):
                c, step = f"{{{m[1] or 0}{m[2]}{m[3]}}}", len(m[0])
            elif m and m[2]:
                c, step = "{0,}", len(m[0])
            else:
                c = r"\{"
        elif c == "}":
            c = r"\}"
        out.append(c)
        i += step
    # Unicode-aware \w, \d and \s, as in Python.
    return "(?U)" + "".join(out)


def _literals(parsed) -> list[list[str]]:
    """Covers of a parsed expression: lists of literals, lower case, one of which is in every match."""
    covers: list[list[str]] = []
    run = ""
    for kind, value in [*parsed, (None, None)]:
        if kind is syntax.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        if run:
            covers.append([run])
            run = ""
        if kind is syntax.SUBPATTERN:
            covers += _literals(value[3])
        elif kind is syntax.ATOMIC_GROUP:
            covers += _literals(value)
        elif kind in (syntax.MAX_REPEAT, syntax.MIN_REPEAT, syntax.POSSESSIVE_REPEAT) and value[0] > 0:
            covers += _literals(value[2])
        elif kind is syntax.BRANCH:
            # Every alternative has to offer a literal; the longest is taken of each.
            found = [max((c for c in _literals(way)), key=lambda c: min(map(len, c)), default=None) for way in value[1]]
            if all(found):
                covers.append([literal for c in found for literal in c])
    return covers


def offers_of(pattern: str) -> list[list[str]]:
    """Sets of pieces for the index: every match of the pattern holds a piece of each. Pieces are as long as
    they can be, as short ones are shared by the more patterns the more there are; those of one set have one
    length. Without any literal the empty piece stands for the pattern."""
    out: list[list[str]] = []
    for literals in _literals(syntax.parse(pattern)):
        size = min(PIECE, *map(len, literals))
        if len(literals) == 1:
            out += [[literals[0][i : i + size]] for i in range(len(literals[0]) - size + 1)]
        else:
            out.append(sorted({w[len(w) - size :] for w in literals}))
    return out or [[""]]


def covers_of(pattern: str) -> list[list[str]]:
    """The sets of the longest pieces among those that the pattern offers."""
    out = offers_of(pattern)
    longest = max(len(c[0]) for c in out)
    return [c for c in out if len(c[0]) == longest]


def compile_patterns(patterns: pa.Array) -> pa.Array:
    """For each Python pattern the translated one and its covers; null where Python rejects it."""
    rows = patterns.to_pylist()
    java = {p: java_pattern(p) for p in set(rows) if p is not None}
    told = {p: {"java": j, "covers": offers_of(p)} for p, j in java.items() if j is not None}
    return pa.array(
        [told.get(p) for p in rows],
        pa.struct([("java", pa.string()), ("covers", pa.list_(pa.list_(pa.string())))]),
    )


def pieces_of(url: str, lengths: str) -> str:
    """The distinct pieces of a URL of each of the given lengths, as the index spells them."""

    def of(folded: str) -> str:
        pieces = f"transform(sequence(1, length({folded}) - n + 1), i -> substr({folded}, i, n))"
        return (
            f"array_distinct(flatten(transform({lengths}, n -> CASE WHEN n = 0 THEN array('') "
            f"WHEN length({folded}) < n THEN CAST(array() AS ARRAY<STRING>) ELSE {pieces} END)))"
        )

    return let(f"lower(translate({url}, '{''.join(FOLDED)}', '{''.join(FOLDED.values())}'))", of)
