"""Main text of HTML pages by consensus host paths.

Each page's containers are scored by the text and links they hold, the best one is widened to the
article around it, and the page votes for its path: tags with their first class, digits generalised. Votes are added up per host in
Spark. Pages are then read again with the winning paths of their host; a page on which none of them
holds nearly as much as its own best container goes by that one. Menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts and styles never count, in either pass. They are known by their tags and by the words of their
class, role and id; within an article by whole names only, or by a part of one and the share of links.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pagework.llm.common import others, quoted
from pagework.plans.materialize import materialize

LEAST_SHARE = 0.3  # of the host's votes, for a path beside the first
NEAR = 0.8  # of the worth of a page's own best container, for a path of its host to be used on it
RESULTS = ("text", "n_chars")

# Possessive parts, and none that crosses a "<" outside quotes: what a tag has read it never reads again, so a page that
# is cut off inside a tag takes no longer than another. A tag that does not end is passed over up to the next "<" or ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"'/]++|\"[^\"]*+\"|'[^']*+'|[\"']|/(?!>))*+)(/?)>|</?[a-zA-Z][^<>]*+>?", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("article body div main section td".split())
_FURNITURE = frozenset("aside button dialog footer form head menu nav object search select svg canvas audio video math".split())
_WEIGHT = {"article": 3.0, "main": 2.5, "section": 1.1, "td": 0.8, "body": 0.5}
#: Words of classes, ids and roles that mark furniture.
_MARKS = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup "
    "promo promoted promotion recommended related respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_MARKS_OUTSIDE = frozenset(("header", "complementary", "alert"))  # inside an article these may be its own
#: Words that beside a mark leave a name one of furniture, as in "comment-list" or "share-buttons".
_NEUTRAL = frozenset(
    "area author bar block body bottom box btn button buttons col column container content css footer form group head header heading holder "
    "icon icons id inline inner item items js label left link links list main menu message meta outer panel posts region reply right row "
    "section slot text thread title top unit widget wrap wrapper".split()
)
_TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd caption figcaption legend pre blockquote summary".split())  # ids are of their text
_CELLS = frozenset("td th tr".split())
_WORD = re.compile(r"[a-z]+")


def _names(tag: str, attributes: dict[str, str], article: bool) -> list[str]:
    """Class, role and id names that may mark furniture. Ids of headings, paragraphs and items, and within an
    article those of cells and sections, are made from the text and do not count."""
    told = [attributes.get("class", ""), attributes.get("role", "")]
    if tag not in _TEXTUAL and not (article and (tag in _CELLS or tag == "section")):
        told.append(attributes.get("id", ""))
    return " ".join(told).split()


def _marked(names: list[str], article: bool) -> tuple[bool, bool]:
    """Whether names tell furniture, and whether they only suggest it, so that the share of links has to decide.

    Outside an article any word marks; within one the whole name must be of marks and neutral words,
    and a mark as its first or last word suggests.
    """
    suggested = False
    for words in map(_WORD.findall, names):
        marks = _MARKS.intersection(words)
        if not article and (marks or _MARKS_OUTSIDE.intersection(words)):
            return True, False
        if marks and all(w in marks or w in _NEUTRAL for w in words):
            return True, False
        suggested = suggested or bool(marks) and (words[0] in marks or words[-1] in marks)
    return False, suggested


@dataclass
class Container:
    path: str
    tag: str
    parent: int
    weight: float
    chars: int = 0
    linked: int = 0
    blocks: int = 0


@dataclass
class Page:
    """Containers in page order, and the blocks: text, the number of the innermost container, linked characters."""

    containers: list[Container] = field(default_factory=list)
    blocks: list[tuple[str, int, int]] = field(default_factory=list)


def read_page(source: str | None) -> Page:
    page = Page()
    source = source or ""
    page.containers.append(Container("", "", -1, 0.1))
    # Tag, container, furniture, in an article, and for suspected furniture the number of blocks before it, else -1.
    stack: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, -1)]
    parts: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text and not stack[-1][2]:
                at = stack[-1][1]
                page.blocks.append((text, at, min(linked, len(text))))
                c = page.containers[at]
                c.chars, c.linked, c.blocks = c.chars + len(text), c.linked + min(linked, len(text)), c.blocks + 1
            parts, linked = [], 0

    def leave(first: int) -> None:
        """Closes the elements from ``first`` on; suspected furniture goes if half of its text is links."""
        while len(stack) > first:
            since = stack.pop()[4]
            if since >= 0:
                within = page.blocks[since:]
                if 2 * sum(n for _, _, n in within) >= sum(len(t) for t, _, _ in within):
                    for text, at, n in within:
                        c = page.containers[at]
                        c.chars, c.linked, c.blocks = c.chars - len(text), c.linked - n, c.blocks - 1
                    del page.blocks[since:]

    def say(text: str) -> None:
        nonlocal linked
        if text and not stack[-1][2]:
            decoded = html.unescape(text) if "&" in text else text
            parts.append(decoded)
            if links:
                linked += len(decoded)

    at, end = 0, len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            say(source[at:])
            break
        say(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "br":
            parts.append(" ")
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if closing:
            if tag in _BLOCK or tag in _FURNITURE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        flush()
                        leave(i)
                        links = 0
                        break
                else:
                    if tag in _BLOCK:
                        flush()
            continue
        if tag in _RAW:
            close = re.compile(f"</{re.escape(tag)}\\s*/?>", re.I).search(source, at)
            at = close.end() if close else end
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _BLOCK or tag in _FURNITURE:
            flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th") or tag in _BLOCK and stack[-1][0] == "p":
                # An open paragraph ends at any block; items, cells and rows end at the next one of their kind.
                if stack[-1][0] == "p" or stack[-1][0] == tag:
                    leave(len(stack) - 1)
            _, container, furniture, article, _ = stack[-1]
            attributes = {k.lower(): html.unescape(a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(m[3])} if m[3] else {}
            suspected = False
            if not furniture:
                furniture = tag in _FURNITURE or tag == "header" and not article
                if not furniture and attributes and tag not in ("html", "body", "article", "main"):
                    furniture, suspected = _marked(_names(tag, attributes, article), article)
                    if article and not furniture and tag == "section":
                        suspected = suspected or any(_marked([name], article) != (False, False) for name in attributes.get("id", "").split())
            if tag in _CONTAINER and not furniture:
                name = " ".join(_WORD.findall(attributes.get("class", "").split(" ")[0]))
                path = f"{page.containers[container].path}/{tag}{'.' + name.replace(' ', '-') if name else ''}"
                page.containers.append(Container(path, tag, container, _WEIGHT.get(tag, 1.0)))
                container = len(page.containers) - 1
            if not m[4]:
                inside = article or tag in ("article", "main") or attributes.get("role", "").strip() in ("article", "main")
                stack.append((tag, container, furniture, inside, len(page.blocks) if suspected else -1))
    flush()
    leave(1)
    return page


def _own(c: Container) -> int:
    return c.chars - 2 * c.linked + 25 * c.blocks


def best_container(page: Page) -> tuple[int, float]:
    """The container with the best score, widened to the whole article that it is part of.

    A score is the container's own text, less links, and what its parts pass up, halved at each level.
    """
    total = [float(max(0, _own(c))) for c in page.containers]
    for i in range(len(page.containers) - 1, 0, -1):
        total[page.containers[i].parent] += total[i] / 2
    scores = [t * c.weight for t, c in zip(total, page.containers)]
    at = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return _widened(page, at), scores[at]


def _widened(page: Page, at: int) -> int:
    """The outermost article around a container, else the nearest main, else the outermost ancestor such that
    all that is added on the way is mostly not links; the body only if that is text of its own without links."""
    around = [at]
    while page.containers[around[-1]].parent > 0:
        around.append(page.containers[around[-1]].parent)
    for tag, which in (("article", -1), ("main", 0)):
        found = [i for i in around if page.containers[i].tag == tag]
        if found:
            return found[which]
    chars, linked = [c.chars for c in page.containers], [c.linked for c in page.containers]
    for i in range(len(chars) - 1, 0, -1):
        parent = page.containers[i].parent
        chars[parent] += chars[i]
        linked[parent] += linked[i]
    best = at
    for inner, outer in zip(around, around[1:]):
        more, links = chars[outer] - chars[inner], linked[outer] - linked[inner]
        if 2 * links >= more > 0 or page.containers[outer].tag == "body" and (links or page.containers[outer].chars < more):
            break
        if more:
            best = outer
    return best


def _region(page: Page, path: str) -> tuple[list[str], int]:
    """Blocks within the containers of a path, and their worth: text, less links, plus something for each block."""
    inside = [c.path == path for c in page.containers]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[page.containers[i].parent]
    worth = sum(max(0, _own(c)) for c, within in zip(page.containers, inside) if within)
    return [t for t, c, _ in page.blocks if inside[c]], worth


def _within(page: Page, at: int, around: set[int]) -> bool:
    while at >= 0 and at not in around:
        at = page.containers[at].parent
    return at >= 0


def main_text(page: Page, paths: list[str]) -> str:
    """Blocks within the page's own best container, or within those of the first of ``paths`` that holds it or
    whose worth on this page comes near its.

    The containers of a path are widened on the page like its own, so a lead beside the body that the host's
    pages agree on is not lost; where the page's own container holds them, that stays the wider one.
    """
    if not page.blocks:
        return ""
    at, _ = best_container(page)
    texts, best = _region(page, page.containers[at].path)
    own = {i for i, c in enumerate(page.containers) if c.path == page.containers[at].path}
    for path in paths:
        theirs = {_widened(page, i) for i, c in enumerate(page.containers) if c.path == path}
        if not theirs or all(_within(page, i, own) for i in theirs):
            continue
        wide = [_region(page, p) for p in dict.fromkeys(page.containers[i].path for i in sorted(theirs))]
        found, worth = max(wide, key=lambda r: r[1])
        if found and (_within(page, at, theirs) or worth >= NEAR * best):
            return "\n".join(found)
    return "\n".join(texts or [t for t, _, _ in page.blocks])


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; "" where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", least_share: float = LEAST_SHARE) -> DataFrame:
    """``host, paths``: the winning container paths of every host, best first.

    Votes combine before the shuffle, so a host with most of the pages is no hot spot; only paths
    with ``least_share`` of a host's votes are gathered, a few for each host.
    """
    narrow = pages.select(host_of(F.col(quoted(url_col))).alias("host"), F.col(quoted(html_col)).alias("html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = read_page(source)
                at, score = best_container(page)
                if score > 0 and page.containers[at].path:
                    hosts.append(host)
                    paths.append(page.containers[at].path)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], names=["host", "path"])

    votes = materialize(narrow.mapInArrow(vote, "host string, path string").groupBy("host", "path").agg(F.count("*").alias("votes")), "votes")
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"), F.max(F.struct("votes", "path")).alias("first"))
    winners = votes.join(totals, "host").filter(f"votes >= {least_share} * total OR path = first.path")
    ranked = winners.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("votes", "path")), asc=False).alias("ranked"))
    return materialize(ranked.select("host", F.col("ranked.path").alias("paths")), "host_paths")


def extract_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` without the HTML, with ``text`` and ``n_chars`` (code points); columns of these names go.

    Blocks are joined by line ends in page order; white space inside a block is one space. Null and
    empty pages, and pages without text outside furniture, have an empty text. Null addresses share
    the host "". Repeated pages come out as often as they came in; an empty table gives none. The
    hosts' paths are a written table, so Spark sends it to the pages only if its known size is
    small, and otherwise joins by host, splitting hosts that hold many pages.
    """
    paths = host_paths(pages, url_col, html_col)
    keep = others(pages, (html_col, *RESULTS))
    narrow = pages.select(
        F.struct(*map(quoted, keep)).alias("_keep") if keep else F.lit(None).cast("boolean").alias("_keep"),
        F.col(quoted(html_col)).alias("html"), host_of(F.col(quoted(url_col))).alias("host"),
    )
    known = narrow.join(paths, "host", "left").select("_keep", "html", "paths")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(read_page(s), p or []) for s, p in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_keep"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["_keep", *RESULTS]
            )

    out = known.mapInArrow(extract, StructType([known.schema["_keep"], StructField("text", StringType()), StructField("n_chars", LongType())]))
    return out.select(*(F.col("_keep")[c].alias(c) for c in keep), *RESULTS)
