"""Extraction from HTML with built-in SQL expressions only.

These expressions read a page as text, cut at the tags of its containers. One fold over the pieces keeps
the stack of open containers, so furniture goes with all that is nested in it, and an article with its
inner ones is one region, whatever tags are missing or stray. Selectors and block paths need a
tree and go through :mod:`pagework.functions.html_tree`.
"""

from __future__ import annotations

from pagework.functions.text import (
    choose, collapse_ws, decode_entities, each, escape_html, extract, keep, let, matches, q, q_list,
    non_empty, replace_all, strip_ws,
)

_S = r"[ \t\r\n\f]"
_ATTRS = rf"(?:{_S}[^>]*)?"

# Two characters that HTML forbids in documents mark structure while tags are being removed.
MARK = "\x01"
BREAK = "\x02"

# Elements whose content is never text, page furniture, and block-level elements.
HIDDEN_TAGS = ("script", "style", "noscript", "template", "iframe", "svg")
FURNITURE_TAGS = ("head", "title", "nav", "header", "footer", "aside")
BLOCK_TAGS = (
    "address article aside blockquote body br center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre "
    "section summary table tbody tfoot thead title tr ul"
).split()
AD_NAMES = "ad ads advert advertisement adsense banner sponsor sponsored".split()
COMMENT_NAMES = "comment comments comment-list comments-area disqus_thread".split()

STOP_WORDS = {
    "en": "the of and to in is that it for was on are with as be this from or have not by but",
    "fr": "le la les de des du et un une est que qui dans pour pas sur avec au ce il elle ne",
    "de": "der die das und ist nicht ein eine von mit den dem zu auf sich auch für im des wie",
    "es": "el la los las de que y en un una es por con para no se su al lo como más del",
    "it": "il lo la gli di che e un una per non con sono del della dei da alla anche nel",
    "pt": "o a os as de que e em um uma para com não por do da dos das se mais como",
    "nl": "de het een en van is dat niet in op te zijn met voor aan er om ook bij naar",
}


def _element(tag: str) -> str:
    """A whole element, after its opening '<'."""
    return rf"{tag}{_ATTRS}>.*?</{tag}{_S}*>"


def _any(elements: list[str]) -> str:
    """One of several elements. The common '<' stands in front, so that a scan tests one character
    at most positions and the alternatives only where a tag starts."""
    return f"<(?:{'|'.join(elements)})"


def _named(names: list[str]) -> str:
    """The opening tag of a container one of whose class or id names is in ``names``, in any quotes or none."""
    one_of = "|".join(names)

    def within(quote: str) -> str:
        return rf"{quote}(?:[^{quote}>]*{_S})?(?:{one_of})(?:{_S}[^{quote}>]*)?{quote}"

    value = rf"""(?:class|id){_S}*={_S}*(?:{within('"')}|{within("'")}|(?:{one_of})(?=[ \t\r\n\f>]))"""
    return rf"(?is)^<(?:div|section|aside|ul|ol){_S}[^>]*?{value}"


HIDDEN = "(?is)" + _any([r"!--.*?-->", *[_element(t) for t in HIDDEN_TAGS]])
# Elements that can be furniture, hold it or be the main region: what the fold keeps on its stack.
CONTAINERS = (*FURNITURE_TAGS, "div", "section", "ul", "ol", "table", "article", "main")
CONTAINER_EDGE = rf"(?i)(?=</?(?:{'|'.join(CONTAINERS)})[ \t\r\n\f/>])"
CONTAINER_TAG = rf"(?i)^<(/?(?:{'|'.join(CONTAINERS)}))[ \t\r\n\f/>]"
ADS, COMMENTS = _named(AD_NAMES), _named(COMMENT_NAMES)
BODY = rf"(?is)<body{_ATTRS}>(.*)"
HEADING = rf"(?i)<h([1-6]){_ATTRS}>"
LIST_ITEM = rf"(?i)<li{_ATTRS}>(?:{_S}*<(?:p|div){_ATTRS}>)?"
CELL_GAP = rf"(?i)</t[dh]{_S}*>{_S}*<t[dh]{_ATTRS}>"
LINK = rf"""(?is)<a{_S}[^>]*?href="([^">]*)"[^>]*>(.*?)</a{_S}*>"""
BLOCK_EDGE = rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)})(?:[ \t\r\n\f/][^>]*)?>"
TAG = r"(?s)</?[a-zA-Z!?][^>]*>"


_PIECES = "ARRAY<STRUCT<text: STRING, article: BOOLEAN, main: BOOLEAN>>"


def container_pieces(html: str, include_comments: bool | str, include_tables: bool | str) -> str:
    """What a page holds outside comments, hidden elements and furniture, cut at its container tags: an array of
    text, and whether it lies in an article or a main element.

    A fold over the pieces carries the open containers. A closing tag closes the innermost one of its name and all
    that were left open in it; one without an opening tag counts for nothing. Furniture begins at its
    opening tag and ends when its container closes, by its own tag or by that of one around it.
    """

    def furniture(piece: str, tag: str) -> str:
        found = [f"{tag} IN ({q_list(FURNITURE_TAGS)})", matches(piece, ADS)]
        if include_comments is not True:
            found.append(choose(include_comments, "false", matches(piece, COMMENTS)))
        if include_tables is not True:
            found.append(choose(include_tables, "false", f"{tag} = 'table'"))
        return f"({' OR '.join(found)})"

    def step(s: str, piece: str) -> str:
        def known(tag: str) -> str:
            name = f"substr({tag}, 2)"
            last = f"size({s}.stack) + 1 - array_position(reverse({s}.stack), {name})"  # of that name, 1 behind the end if none
            closed = let(f"CAST({last} AS INT)", lambda at: (
                f"CASE WHEN array_contains({s}.stack, {name}) THEN named_struct('stack', slice({s}.stack, 1, {at} - 1), "
                f"'skip', CASE WHEN {at} <= {s}.skip THEN 0 ELSE {s}.skip END) ELSE named_struct('stack', {s}.stack, 'skip', {s}.skip) END"
            ))
            opened = (
                f"named_struct('stack', concat({s}.stack, array({tag})), 'skip', "
                f"CASE WHEN {s}.skip = 0 AND {furniture(piece, tag)} THEN size({s}.stack) + 1 ELSE {s}.skip END)"
            )
            here = f"CASE WHEN {tag} = '' THEN named_struct('stack', {s}.stack, 'skip', {s}.skip) WHEN startswith({tag}, '/') THEN {closed} ELSE {opened} END"
            return let(here, lambda n: (
                f"named_struct('stack', {n}.stack, 'skip', {n}.skip, 'out', CASE WHEN {n}.skip > 0 THEN {s}.out ELSE concat({s}.out, array(named_struct("
                f"'text', {piece}, 'article', array_contains({n}.stack, 'article'), 'main', array_contains({n}.stack, 'main')))) END)"
            ))

        return let(f"lower({extract(piece, CONTAINER_TAG)})", known)

    c = f"replace(replace({html}, {q(MARK)}, ''), {q(BREAK)}, '')"
    c = replace_all(c, HIDDEN, "")
    start = f"named_struct('stack', CAST(array() AS ARRAY<STRING>), 'skip', 0, 'out', CAST(array() AS {_PIECES}))"
    return f"aggregate(split({c}, {q(CONTAINER_EDGE)}, -1), {start}, (s, p) -> {step('s', 'p')}, s -> s.out)"


def main_region(pieces: str) -> str:
    """The articles of a page, else its main element, else its body, else all of it."""

    def joined(p: str, kind: str) -> str:
        inside = f"array_join(transform(filter({p}, x -> x.{kind}), x -> x.text), '')"
        # The element's own tags are no content.
        return let(replace_all(inside, rf"(?i)</?{kind}{_ATTRS}>", BREAK), lambda x: f"CASE WHEN replace({x}, {q(BREAK)}, '') <> '' THEN {x} END")

    def pick(p: str) -> str:
        whole = let(f"array_join(transform({p}, x -> x.text), '')", lambda c: f"coalesce({non_empty(extract(c, BODY))}, {c})")
        return f"coalesce({joined(p, 'article')}, {joined(p, 'main')}, {whole})"

    return let(pieces, pick)


def region_blocks(region: str, include_links: bool | str) -> str:
    """The text blocks of a region in order. A heading starts with MARK and its level, a list item
    with MARK and '-'."""
    c = region
    if include_links is not False:
        c = let(c, lambda x: choose(include_links, replace_all(x, LINK, "$2 ($1)"), x))
    c = replace_all(c, HEADING, f"{BREAK}{MARK}$1")
    c = replace_all(c, LIST_ITEM, f"{BREAK}{MARK}-")
    c = replace_all(c, CELL_GAP, " | ")
    c = replace_all(c, BLOCK_EDGE, BREAK)
    c = collapse_ws(replace_all(c, TAG, ""))

    def clean(s: str) -> str:
        decoded = f"CASE WHEN contains({s}, '&') THEN {collapse_ws(decode_entities(s))} ELSE {s} END"
        return let(decoded, lambda d: (
            f"CASE WHEN startswith({d}, {q(MARK)}) THEN concat(substr({d}, 1, 2), trim(substr({d}, 3))) ELSE trim({d}) END"
        ))

    lines = each(f"split({c}, {q(BREAK)}, -1)", clean)
    return keep(lines, lambda s: f"{s} <> '' AND NOT (startswith({s}, {q(MARK)}) AND length({s}) <= 2)")


def article_blocks(
    html: str,
    include_comments: bool | str = False,
    include_tables: bool | str = True,
    include_links: bool | str = False,
) -> str:
    """The main text of a page as marked blocks."""
    return region_blocks(main_region(container_pieces(html, include_comments, include_tables)), include_links)


def block_kind(block: str) -> str:
    """'1'..'6' for headings, '-' for list items, '' for paragraphs."""
    return f"CASE WHEN startswith({block}, {q(MARK)}) THEN substring({block}, 2, 1) ELSE '' END"


def block_text(block: str) -> str:
    return f"CASE WHEN startswith({block}, {q(MARK)}) THEN substr({block}, 3) ELSE {block} END"


def content_label(output_format: str) -> str:
    """The label of an output format; anything unknown is plain text."""
    return (
        f"CASE {output_format} WHEN 'markdown' THEN 'markdown' WHEN 'html' THEN 'html' ELSE 'text' END"
    )


def render_marked(blocks: str, output_format: str) -> str:
    """X9 for marked blocks: markdown, html, or plain text for every other format."""

    def markdown(b: str) -> str:
        return let(block_kind(b), lambda k: (
            f"concat(CASE WHEN {k} = '' THEN '' WHEN {k} = '-' THEN '- ' "
            f"ELSE concat(repeat('#', try_cast({k} AS INT)), ' ') END, {block_text(b)})"
        ))

    def html(b: str) -> str:
        tag = f"CASE {block_kind(b)} WHEN '' THEN 'p' WHEN '-' THEN 'li' ELSE concat('h', {block_kind(b)}) END"
        return let(tag, lambda t: f"concat('<', {t}, '>', {escape_html(block_text(b))}, '</', {t}, '>')")

    return (
        f"CASE {output_format} WHEN 'markdown' THEN array_join({each(blocks, markdown)}, '\n\n') "
        f"WHEN 'html' THEN array_join({each(blocks, html)}, '\n') "
        f"ELSE array_join({each(blocks, block_text)}, '\n') END"
    )


def title_element(html: str) -> str:
    """The title element as written, entities and all; null when there is none."""
    pattern = r"(?is)<title[^>]*>(.*?)</title>"
    return f"CASE WHEN {matches(html, pattern)} THEN {strip_ws(extract(html, pattern))} END"


def page_title(html: str) -> str:
    """Social-media title if present, else the title element; null when the page has neither,
    '' when the element is empty."""
    social = let(meta_tags(head_of(html)), lambda m: first_meta(m, "og:title"))
    return f"coalesce({social}, {title_element(html)})"


def head_of(html: str) -> str:
    """Everything before the end of the head; the whole page when no head ends."""
    return f"coalesce({non_empty(extract(html, rf'(?is)^(.*?)</head{_S}*>'))}, {html})"


def _attribute(tag: str, names: str) -> str:
    prefix = rf"(?is){_S}(?:{names}){_S}*={_S}*"
    forms = ('"([^"]*)"', "'([^']*)'", r"""([^"'\s>]+)""")
    return f"coalesce({', '.join(non_empty(extract(tag, prefix + f)) for f in forms)})"


def meta_tags(head: str) -> str:
    """All meta elements with a name and content, as array of (key, value) in page order."""
    tags = f"regexp_extract_all({head}, {q(rf'(?is)<meta{_S}[^>]*>')}, 0)"
    pairs = each(tags, lambda t: (
        f"named_struct('key', lower({_attribute(t, 'name|property|itemprop')}), "
        f"'value', {strip_ws(decode_entities(_attribute(t, 'content')))})"
    ))
    return keep(pairs, lambda p: f"{p}.key IS NOT NULL AND coalesce({p}.value, '') <> ''")


def first_meta(metas: str, *keys: str) -> str:
    """The value of the first key in ``keys`` that the page has; null when it has none."""
    return f"coalesce({', '.join(f'get({keep(metas, lambda m: f"{m}.key = {q(key)}")}, 0).value' for key in keys)})"


def all_meta(metas: str, key: str, split: bool) -> str:
    """All values of a key, optionally split at commas; null when there is none."""
    values = each(keep(metas, lambda m: f"{m}.key = {q(key)}"), lambda m: f"{m}.value")
    if split:
        values = f"flatten({each(values, lambda v: f'split({v}, {q(",")})')})"
    values = f"array_distinct({keep(each(values, strip_ws), lambda v: f'{v} <> {q("")}')})"
    return let(values, lambda v: f"CASE WHEN size({v}) > 0 THEN {v} END")


def declared_language(html: str) -> str:
    """Primary subtag of the lang attribute of the html element; null when absent."""
    pattern = rf"""(?is)<html{_S}(?:[^>]*{_S})?lang{_S}*={_S}*["']?([a-zA-Z]{{2,3}})"""
    return f"lower({non_empty(extract(html, pattern))})"


def voted_language(text: str) -> str:
    """The language whose stop words occur most often; null when none occurs."""

    def votes(tokens: str) -> str:
        entries = [
            f"named_struct('votes', size({keep(tokens, lambda t: f'{t} IN ({q_list(words.split())})')}), "
            f"'preference', {-i}, 'lang', {q(lang)})"
            for i, (lang, words) in enumerate(STOP_WORDS.items())
        ]
        return f"array_max(array({', '.join(entries)}))"

    best = let(f"split(lower({text}), {q(r'[^\p{L}]+')})", votes)
    return let(best, lambda b: f"CASE WHEN {b}.votes > 0 THEN {b}.lang END")


def page_language(html: str, text: str) -> str:
    """The declared language, else the vote of the stop words in the text."""
    return f"coalesce({declared_language(html)}, {voted_language(text)})"


def _json_ld(html: str, key: str) -> str:
    return non_empty(extract(html, rf'"{key}"{_S}*:{_S}*"([^"]+)"'))


def _json_ld_author(html: str) -> str:
    pattern = rf'"author"{_S}*:{_S}*\[?{_S}*(?:"|\{{[^}}]*?"name"{_S}*:{_S}*")([^"]+)"'
    return non_empty(extract(html, pattern))


def _day(value: str) -> str:
    day = "^([0-9]{4}-[0-9]{2}-[0-9]{2})"
    return let(value, lambda v: f"coalesce({non_empty(extract(v, day))}, {v})")


def metadata_fields(html: str, metas: str) -> dict[str, str]:
    """X14 apart from language and host name: only what the page states, null otherwise."""
    ld = f"CASE WHEN contains({html}, 'application/ld+json') THEN {html} END"
    clock = extract(html, rf"""(?is)<time{_S}[^>]*?datetime{_S}*={_S}*["']([^"']+)["']""")
    published = first_meta(metas, "article:published_time", "date", "dc.date", "datepublished", "pubdate")
    author = first_meta(metas, "author", "article:author", "dc.creator")
    tags = (all_meta(metas, "article:tag", split=False), all_meta(metas, "keywords", split=True))
    return {
        "author": f"coalesce({author}, {_json_ld_author(ld)})",
        "date": _day(f"coalesce({published}, {_json_ld(ld, 'datePublished')}, {non_empty(clock)})"),
        "sitename": first_meta(metas, "og:site_name", "application-name"),
        "description": first_meta(metas, "description", "og:description", "twitter:description"),
        "image": first_meta(metas, "og:image", "twitter:image"),
        "categories": all_meta(metas, "article:section", split=False),
        "tags": f"coalesce({', '.join(tags)})",
    }
