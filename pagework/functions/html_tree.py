"""The two page operators that need an element tree (X1, X3), as Arrow-batched functions.

Spark partitions the pages; inside a task one pass over the tags of a page keeps the stack of open
elements. A null page costs nothing, so callers gate the input column instead of the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagework import schemas

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head title noscript template iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre "
    "section summary table tbody tfoot thead title tr ul".split()
)
# An opening tag also ends these elements when they are still open above the given boundary.
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["thead", "tbody", "tr", "td", "th"]), frozenset(["table"])),
}
ENDS_PARAGRAPH = BLOCK - {"br", "body", "html", "head", "title", "tbody", "tfoot", "thead", "tr"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?:(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<bad>[^>]*+)>)"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "attrs", "start", "segment", "outer", "own", "seen")

    def __init__(self, tag: str, attrs: dict[str, str], start: int) -> None:
        self.tag, self.attrs, self.start, self.segment = tag, attrs, start, ""
        self.outer: tuple[str, frozenset[str]] | None = None
        self.own: list[int] = []
        self.seen: list[int] = []


def path_name(value: str) -> str:
    """A class or id as it stands in a block path, where / . # separate the parts."""
    for char in "%/.#":
        value = value.replace(char, f"%{ord(char):02X}")
    return value


def _segment(e: Element) -> str:
    if not e.segment:
        ident = "".join("#" + path_name(x) for x in e.attrs.get("id", "").split())
        classes = "".join("." + path_name(x) for x in e.attrs.get("class", "").split())
        e.segment = "/" + e.tag + ident + classes
    return e.segment


def _outer(stack: list[Element], depth: int) -> str:
    """The different segments of the outer ``depth`` elements. Every element keeps its own result, so
    a page with very many nested elements costs one look at each."""
    at = depth
    while at and stack[at - 1].outer is None:
        at -= 1
    names = stack[at - 1].outer if at else ("", frozenset())
    for e in stack[at:depth]:
        segment = _segment(e)
        if segment not in names[1]:
            names = (names[0] + segment, names[1] | {segment})
        e.outer = names
    return names[0]


def element_path(stack: list[Element], depth: int) -> str:
    """'/html/body/div#id.class' for the outer ``depth`` open elements: the two innermost ones, and
    before them each different segment further out once, at any depth."""
    inner = max(depth - 2, 0)
    return _outer(stack, inner) + "".join([_segment(e) for e in stack[inner:depth]])


def walk(html: str) -> Iterator[tuple[str, int, int, list[Element], Element | None]]:
    """Yield (event, start, end, open elements, element) with event in text/open/close.

    Tags that close nothing cost a look into a counter, so a broken page stays linear.
    """
    stack: list[Element] = []
    is_open: Counter[str] = Counter()
    done = 0

    def pop(depth: int, at: int, end: int, tag: str = "") -> Iterator:
        while len(stack) > depth:
            e = stack.pop()
            is_open[e.tag] -= 1
            yield "close", at, end if len(stack) == depth and e.tag == tag else at, stack, e

    for m in _TOKEN.finditer(html):
        if m.start() > done:
            yield "text", done, m.start(), stack, None
        done = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if is_open[tag] > 0:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag)
                yield from pop(depth, m.start(), m.end(), tag)
            continue
        closes, bound = IMPLIED_END.get(tag, (frozenset(), frozenset()))
        if tag in ENDS_PARAGRAPH:
            closes, bound = closes | {"p"}, bound | (BLOCK - {"p", "li", "dt", "dd", "tr"})
        left = sum(is_open[t] for t in closes)
        if left:
            depth = i = len(stack)
            while left and i:
                i -= 1
                if stack[i].tag in closes:
                    depth, left = i, left - 1
                elif stack[i].tag in bound:
                    break
            yield from pop(depth, m.start(), m.start())
        raw = m["attrs"] if m["attrs"] is not None else m["bad"]
        attrs: dict[str, str] = {}
        for a in _ATTR.finditer(raw):
            attrs.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
        element = Element(tag, attrs, m.start())
        yield "open", m.start(), m.end(), stack, element
        if tag in VOID or raw.endswith("/") and tag not in BLOCK:
            yield "close", m.end(), m.end(), stack, element
        else:
            stack.append(element)
            is_open[tag] += 1
    if done < len(html):
        yield "text", done, len(html), stack, None
    yield from pop(0, len(html), len(html))


_COMPOUND = re.compile(
    r"""(?P<tag>\*|[a-zA-Z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)"""
    r"""|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?:"(?P<v1>[^"]*)"|'(?P<v2>[^']*)'|(?P<v3>[\w-]+))\s*)?\]"""
)


def parse_selector(css: str) -> tuple:
    """A selector list as ((combinator, tests), ...) per alternative."""
    alternatives = []
    for part in re.split(r",(?![^\[]*\])", css):
        steps, tests, combinator, i, part = [], [], "", 0, part.strip()
        while i < len(part):
            gap = re.compile(r"\s*>\s*|\s+").match(part, i)
            if gap:
                if not tests:
                    raise ValueError(f"unsupported selector {css!r}")
                steps.append((combinator, tuple(tests)))
                tests, combinator, i = [], ">" if ">" in gap[0] else " ", gap.end()
                continue
            m = _COMPOUND.match(part, i)
            if not m or (m["tag"] and tests):
                raise ValueError(f"unsupported selector {css!r}")
            tests.append((m["tag"], m["id"], m["cls"], m["attr"], m["op"], m["v1"] or m["v2"] or m["v3"] or ""))
            i = m.end()
        if not tests:
            raise ValueError(f"unsupported selector {css!r}")
        steps.append((combinator, tuple(tests)))
        alternatives.append(tuple(steps))
    return tuple(alternatives)


def _passes(e: Element, tests: tuple) -> bool:
    for tag, ident, cls, attr, op, value in tests:
        if tag:
            ok = tag == "*" or e.tag == tag.lower()
        elif ident:
            ok = e.attrs.get("id") == ident
        elif cls:
            ok = cls in e.attrs.get("class", "").split()
        else:
            have = e.attrs.get(attr.lower())
            ok = have is not None and (
                op is None
                or (op == "=" and have == value)
                or (op == "~=" and value in have.split())
                or (value != "" and (
                    (op == "^=" and have.startswith(value))
                    or (op == "$=" and have.endswith(value))
                    or (op == "*=" and value in have)
                ))
            )
        if not ok:
            return False
    return True


def _step(e: Element, parent: Element | None, alternatives: tuple) -> bool:
    """Work out which selector steps ``e`` completes, from those its parent completed.

    Per alternative, ``own`` has a bit for each step that ends at the element, ``seen`` for each that
    ends at it or at an ancestor. One look at the parent replaces a search through all ancestors.
    """
    hit = False
    for i, steps in enumerate(alternatives):
        above_own, above_seen = (parent.own[i], parent.seen[i]) if parent else (0, 0)
        own = 0
        for j, (combinator, tests) in enumerate(steps):
            before = above_own if combinator == ">" else above_seen
            if (j == 0 or before >> (j - 1) & 1) and _passes(e, tests):
                own |= 1 << j
        e.own.append(own)
        e.seen.append(own | above_seen)
        hit = hit or bool(own >> (len(steps) - 1) & 1)
    return hit


def select_html(html: str, alternatives: tuple) -> str:
    """The source of all elements matching a parsed selector, joined in page order."""
    found: list[tuple[int, int]] = []
    hits: set[int] = set()
    for event, start, end, stack, e in walk(html):
        if event == "open" and _step(e, stack[-1] if stack else None, alternatives):
            hits.add(e.start)
        elif event == "close" and e.start in hits:
            found.append((e.start, end))
    return "".join(html[a:b] for a, b in sorted(found, key=lambda x: (x[0], -x[1])))


def page_blocks(html: str) -> list[tuple[str, str, str, int, str]]:
    """(tag, path, text, link characters, source) of every text block in page order."""
    out: list[tuple[str, str, str, int, str]] = []
    pieces: list[str] = []
    links: list[str] = []
    begin = last = hidden = anchors = 0
    tag, path = "body", ""

    def flush() -> None:
        if not pieces:
            return
        raw = unescape("".join(pieces))
        text = raw.strip() if tag == "pre" else _SPACE.sub(" ", raw).strip()
        text = text.strip("| ") if tag == "tr" else text
        if text:
            linked = len(_SPACE.sub(" ", unescape("".join(links))).strip())
            out.append((tag, path, text, min(linked, len(text)), html[begin:last].strip()))
        pieces.clear()
        links.clear()

    for event, start, end, stack, e in walk(html):
        if event == "text":
            if hidden or (not pieces and not html[start:end].strip()):
                continue
            if not pieces:
                depth = next((i for i in range(len(stack), 0, -1) if stack[i - 1].tag in BLOCK), 0)
                tag = stack[depth - 1].tag if depth else "body"
                path = element_path(stack, depth)
            pieces.append(html[start:end])
            if anchors:
                links.append(html[start:end])
            last = end
            continue
        if e.tag in BLOCK:
            flush()
            begin = last = end
        elif e.tag in ("td", "th") and event == "open" and pieces:
            pieces.append(" | ")
        elif pieces:
            last = end
        if e.tag in HIDDEN:
            hidden += 1 if event == "open" else -1
            begin = begin if pieces else end
        elif e.tag == "a":
            anchors += 1 if event == "open" else -1
    flush()
    return out


def _blocks(html: pa.Array) -> pa.Array:
    offsets, missing = [0], []
    pos: list[int] = []
    columns: tuple[list, ...] = ([], [], [], [], [])
    for page in html.to_pylist():
        blocks = None
        if page is not None:
            try:
                blocks = page_blocks(page)
            except Exception:  # one bad page must not fail the task
                blocks = None
        missing.append(blocks is None)
        for i, block in enumerate(blocks or ()):
            pos.append(i)
            for column, value in zip(columns, block):
                column.append(value)
        offsets.append(len(pos))
    tag, path, text, link_chars, source = columns
    fields = pa.StructArray.from_arrays(
        [
            pa.array(pos, pa.int32()),
            pa.array(tag, pa.string()),
            pa.array(path, pa.string()),
            pa.array(text, pa.string()),
            pa.array(link_chars, pa.int32()),
            pa.array(source, pa.string()),
        ],
        names=["pos", "tag", "path", "text", "link_chars", "html"],
    )
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), fields, mask=pa.array(missing, pa.bool_())
    )


def _regions(html: pa.Array, css: pa.Array) -> pa.Array:
    regions: list[str | None] = []
    errors: list[str | None] = []
    parsed: dict[str, tuple] = {}  # selectors repeat: parse each once per batch
    for page, selector in zip(html.to_pylist(), css.to_pylist()):
        region = error = None
        if page is not None and selector:
            try:
                if selector not in parsed:
                    parsed[selector] = parse_selector(selector)
                region = select_html(page, parsed[selector])
            except Exception as e:  # an unsupported selector is a failed attempt, not a failed job
                error = str(e)
        regions.append(region)
        errors.append(error)
    return pa.StructArray.from_arrays(
        [pa.array(regions, pa.string()), pa.array(errors, pa.string())], names=["region", "error"]
    )


# Both functions are declared non-deterministic although they are not: otherwise the optimizer
# inlines them, and every step of the fallback built on them, into each place that mentions a result.
_blocks_udf = F.arrow_udf(_blocks, schemas.BLOCKS_TYPE).asNondeterministic()
_regions_udf = F.arrow_udf(_regions, schemas.REGION_TYPE).asNondeterministic()


def html_blocks(html: Column) -> Column:
    """A page as an array of blocks. Null in, null out; a page that breaks the pass is null."""
    return _blocks_udf(html)


def select_region(html: Column, css: Column) -> Column:
    """Struct of the matching source ('' when nothing matches) and an error text. Rows without
    a selector are null."""
    wanted = css.isNotNull() & (css != "")
    return _regions_udf(F.when(wanted, html), F.when(wanted, css))
