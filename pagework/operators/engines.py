"""Extraction engines and their registry.

An engine adds one column, the attempt struct, to the rows it is given. Its ``html`` input is null
for rows that are not its business, and every step is null-in, null-out, so a row costs only the
engines it really reaches. No engine shuffles.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagework import errors, schemas
from pagework.config import ArticleOptions, Config, PrunedOptions
from pagework.functions import blocks as bl
from pagework.functions import native_html as nh
from pagework.functions.fingerprints import fingerprint
from pagework.functions.html_tree import html_blocks, select_region
from pagework.functions.text import choose, non_empty, q
from pagework.functions.urls import url_hostname


@dataclass(frozen=True)
class Inputs:
    """SQL expressions an engine reads. ``option_keys`` names the options that may be set at all."""

    url: str
    html: str
    css: str | None
    options: str | None
    option_keys: frozenset[str]
    status_code: str
    redirected_url: str

    def option(self, key: str, default: Any) -> Any:
        """An option's value: the plain default when no row can override it, else an expression."""
        if self.options is None or key not in self.option_keys:
            return q(default) if isinstance(default, (str, float)) else default
        return f"coalesce({self.options}.{key}, {q(default)})"


class Engine(Protocol):
    def __call__(self, df: DataFrame, out: str, inputs: Inputs) -> DataFrame: ...


def metadata_struct(fields: Mapping[str, str]) -> str:
    """A metadata struct with the given fields; the others are null."""
    parts = [f"'{n}', CAST({fields.get(n, 'NULL')} AS {kind})" for n, kind in schemas.METADATA_FIELDS]
    return f"named_struct({', '.join(parts)})"


def merge_metadata(first: Mapping[str, str], second: Mapping[str, str]) -> dict[str, str]:
    """Fields of ``second`` win over those of ``first`` where they have a value."""
    both = {n: f"coalesce({second[n]}, {first[n]})" for n in first.keys() & second.keys()}
    return {**first, **second, **both}


def attempt_struct(
    engine: str, code: str, error: str, title: str, content: str, content_format: str, metadata: str
) -> str:
    """The outcome of one attempt; ``code`` is null on success. A failure carries no content."""
    ok = f"{code} IS NULL"
    return (
        f"named_struct('engine', {engine}, 'success', {ok}, "
        f"'title', CASE WHEN {ok} THEN {title} ELSE '' END, "
        f"'content', CASE WHEN {ok} THEN {content} ELSE '' END, "
        f"'content_format', CASE WHEN {ok} THEN {content_format} ELSE 'markdown' END, "
        f"'metadata', CASE WHEN {ok} THEN {metadata} ELSE {metadata_struct({})} END, "
        f"'error_code', {code}, "
        f"'error', CASE WHEN NOT ({ok}) THEN coalesce({error}, {q(errors.UNKNOWN_ERROR)}) END)"
    )


def failure_struct(code: str, error: str) -> str:
    """An attempt that failed outside any engine."""
    return (
        f"named_struct('engine', '', 'success', false, 'title', '', 'content', '', "
        f"'content_format', 'markdown', 'metadata', {metadata_struct({})}, "
        f"'error_code', {code}, 'error', {error})"
    )


def message(code: str) -> str:
    """The fixed message of a failure code; null for codes without one."""
    return f"CASE {code} {' '.join(f'WHEN {q(c)} THEN {q(m)}' for c, m in errors.MESSAGES.items())} END"


def first_error(*checks: tuple[str, str]) -> str:
    """The code of the first check that holds, else null."""
    return f"CASE {' '.join(f'WHEN {condition} THEN {q(code)}' for condition, code in checks)} END"


def blank(c: str) -> str:
    return f"(coalesce({c}, '') = '')"


def _with_region(df: DataFrame, out: str, x: Inputs) -> tuple[DataFrame, str, str]:
    """Apply the selector if the plan can have one: region column, selector error, selector missed.
    The region lands in ``{out}_reg``."""
    region = f"{out}_reg"
    if x.css is None:
        return df.selectExpr("*", f"{x.html} AS {region}"), "CAST(NULL AS STRING)", "false"
    df = df.withColumn(f"{out}_sel", select_region(F.expr(x.html), F.expr(x.css)))
    wanted = f"(coalesce({x.css}, '') <> '')"
    df = df.selectExpr("*", f"CASE WHEN {wanted} THEN {out}_sel.region ELSE {x.html} END AS {region}")
    return df, f"{out}_sel.error", f"({wanted} AND {blank(region)})"


def article_engine(config: ArticleOptions) -> Engine:
    """Main text and metadata of plain HTML pages. JVM-only unless selectors or paths are used."""

    def run(df: DataFrame, out: str, x: Inputs) -> DataFrame:
        names = df.columns
        fmt = x.option("output_format", config.output_format)
        comments = x.option("include_comments", config.include_comments)
        tables = x.option("include_tables", config.include_tables)
        links = x.option("include_links", config.include_links)
        language = x.option("target_language", config.target_language)

        df, css_error, css_missed = _with_region(df, out, x)
        region, blocks, text, metas, facts, code = (
            f"{out}_{n}" for n in ("reg", "blk", "txt", "met", "fct", "code")
        )
        extracted = nh.article_blocks(region, comments, tables, links)
        bad_path = "CAST(NULL AS STRING)"
        if x.options is not None and "prune_xpath" in x.option_keys:
            paths = f"{x.options}.prune_xpath"
            bad_path = bl.unsupported_path(paths)
            df = df.withColumn(f"{out}_tree", html_blocks(F.expr(f"CASE WHEN {paths} IS NOT NULL THEN {region} END")))
            tree = bl.content_toggles(bl.main_blocks(bl.prune_subtrees(f"{out}_tree", paths)), comments, tables)
            extracted = f"CASE WHEN {paths} IS NOT NULL THEN {bl.mark_blocks(tree, links)} ELSE {extracted} END"
        df = df.selectExpr("*", f"{extracted} AS {blocks}", f"{nh.meta_tags(nh.head_of(region))} AS {metas}")

        kept = choose(x.option("deduplicate", config.deduplicate), f"array_distinct({blocks})", blocks)
        df = df.selectExpr("*", f"{nh.render_marked(kept, fmt)} AS {text}")

        found = nh.metadata_fields(region, metas)
        found["language"] = nh.page_language(region, text)
        found["hostname"] = url_hostname(x.url)
        if config.fingerprint:
            found["fingerprint"] = non_empty(fingerprint(text))
        fetched = {"status_code": x.status_code, "redirected_url": x.redirected_url}
        df = df.selectExpr("*", f"{metadata_struct(merge_metadata(fetched, found))} AS {facts}")

        bad_status = f"({x.status_code} < 200 OR {x.status_code} > 299)"
        wrong_language = f"({language} <> '' AND NOT coalesce({facts}.language = {language}, false))"
        df = df.selectExpr("*", first_error(
            (bad_status, errors.ENGINE_EXCEPTION),
            (blank(x.html), errors.FETCH_EMPTY),
            (f"({css_error} IS NOT NULL OR {bad_path} IS NOT NULL)", errors.ENGINE_EXCEPTION),
            (css_missed, errors.CSS_NO_MATCH),
            (f"coalesce(size({blocks}), 0) <= 0", errors.EXTRACT_NONE),
            (wrong_language, errors.EXTRACT_NONE),
            (blank(text), errors.CONTENT_EMPTY),
        ) + f" AS {code}")
        error = (
            f"CASE WHEN {code} = {q(errors.CSS_NO_MATCH)} THEN concat('selector \\'', {x.css or q('')}, '\\' matches nothing') "
            f"WHEN {bad_status} THEN concat('engine error: HTTP status ', {x.status_code}) "
            f"WHEN {css_error} IS NOT NULL THEN concat('engine error: ', {css_error}) "
            f"WHEN {bad_path} IS NOT NULL THEN concat('engine error: unsupported path ', {bad_path}) "
            f"ELSE {message(code)} END"
        )
        social = nh.first_meta(metas, "og:title")
        title = f"coalesce({non_empty(f'coalesce({social}, {nh.title_element(region)})')}, {q(errors.UNTITLED)})"
        result = attempt_struct("'article'", code, error, title, text, nh.content_label(fmt), facts)
        return df.selectExpr(*names, f"{result} AS {out}")

    return run


def pruned_engine(config: PrunedOptions) -> Engine:
    """Markdown of the blocks of a rendered page that score well enough."""

    def run(df: DataFrame, out: str, x: Inputs) -> DataFrame:
        names = df.columns
        df, css_error, _ = _with_region(df, out, x)
        region, every, blocks, text, code = (f"{out}_{n}" for n in ("reg", "all", "blk", "txt", "code"))
        df = df.withColumn(every, html_blocks(F.expr(f"CASE WHEN {region} <> '' THEN {region} END")))
        overlays = x.option("remove_overlay_elements", config.remove_overlay_elements)
        df = df.selectExpr("*", f"{choose(overlays, bl.remove_overlays(every), every)} AS {blocks}")
        threshold = x.option("content_filter_threshold", config.content_filter_threshold)
        fit = bl.render_blocks(bl.prune_blocks(blocks, threshold))
        df = df.selectExpr("*", f"{bl.fit_or_raw(fit, bl.render_blocks(blocks))} AS {text}")
        broken = f"({every} IS NULL AND NOT {blank(region)})"
        df = df.selectExpr("*", first_error(
            (f"{css_error} IS NOT NULL", errors.ENGINE_EXCEPTION),
            (f"({blank(x.html)} OR {broken})", errors.RENDER_FAILED),
            (blank(text), errors.RENDER_NO_CONTENT),
        ) + f" AS {code}")
        error = f"CASE WHEN {css_error} IS NOT NULL THEN concat('engine error: ', {css_error}) ELSE {message(code)} END"
        title = f"coalesce({nh.page_title(x.html)}, {q(errors.UNTITLED)})"
        facts = metadata_struct({"status_code": x.status_code, "redirected_url": x.redirected_url})
        result = attempt_struct("'pruned'", code, error, title, text, "'markdown'", facts)
        return df.selectExpr(*names, f"{result} AS {out}")

    return run


def column_engine(fn: Callable[[Column, Column, Column], Column]) -> Engine:
    """An engine from a function of (html, css, options) columns to an attempt struct column."""

    def run(df: DataFrame, out: str, x: Inputs) -> DataFrame:
        css = F.expr(x.css or "CAST(NULL AS STRING)")
        options = F.expr(x.options or f"CAST(NULL AS {schemas.OPTIONS})")
        return df.withColumn(out, fn(F.expr(x.html), css, options).cast(schemas.ATTEMPT))

    return run


_OF_KIND: dict[str, Callable[[Any], Any]] = {"INT": int, "STRING": str, "ARRAY<STRING>": lambda v: [v] if isinstance(v, str) else [str(x) for x in v]}


def _given_metadata(given: Mapping[str, Any] | None) -> dict[str, Any]:
    """The fields that responses have, in their types; others that an engine gives are ignored."""
    return {n: _OF_KIND[kind](given[n]) for n, kind in schemas.METADATA_FIELDS if given and given.get(n) is not None}


def python_engine(name: str, fn: Callable[..., Mapping[str, Any]]) -> Engine:
    """An engine from a Python function, run in Arrow batches. An exception fails that row only.

    ``fn(url, html, css)``, or ``fn(url, html, css, options)`` to get the options of the rule that matched as a
    dict of those that it sets, returns a dict with ``title``, ``content``, ``content_format``, ``error``, and
    ``metadata``, a dict whose fields win over what is known of the capture.
    """
    wants_options = len(inspect.signature(fn).parameters) > 3

    def batch(url: pa.Array, html: pa.Array, css: pa.Array, options: pa.Array) -> pa.Array:
        rows: list[dict[str, Any] | None] = []
        for u, page, selector, chosen in zip(url.to_pylist(), html.to_pylist(), css.to_pylist(), options.to_pylist()):
            if not page:
                rows.append(None)
                continue
            try:
                more = [{k: v for k, v in (chosen or {}).items() if v is not None}] if wants_options else []
                given = fn(u, page, selector, *more)
                rows.append({
                    "title": given.get("title") or "",
                    "content": given.get("content") or "",
                    "content_format": given.get("content_format") or "markdown",
                    "error": given.get("error"),
                    "raised": False,
                    "metadata": _given_metadata(given.get("metadata")),
                })
            except Exception as e:
                rows.append({"title": "", "content": "", "content_format": "markdown", "error": str(e), "raised": True})
        return pa.array(rows, to_arrow_type(schemas.PYTHON_RESULT_TYPE))

    # Not inlined by the optimizer, see html_tree.
    call = F.arrow_udf(batch, schemas.PYTHON_RESULT_TYPE).asNondeterministic()

    def run(df: DataFrame, out: str, x: Inputs) -> DataFrame:
        names = df.columns
        options = x.options if wants_options and x.options else f"CAST(NULL AS {schemas.OPTIONS})"
        gated = [f"CASE WHEN {x.html} IS NOT NULL THEN {c} END" for c in (x.url, x.css or "CAST(NULL AS STRING)", options)]
        df = df.withColumn(f"{out}_py", call(F.expr(gated[0]), F.expr(x.html), F.expr(gated[1]), F.expr(gated[2])))
        r, code = f"{out}_py", f"{out}_code"
        df = df.selectExpr("*", first_error(
            (f"{r} IS NULL", errors.FETCH_EMPTY),
            (f"{r}.raised", errors.ENGINE_EXCEPTION),
            (f"{r}.error IS NOT NULL", errors.EXTRACT_NONE),
            (f"{r}.content = ''", errors.CONTENT_EMPTY),
        ) + f" AS {code}")
        # An exception leaves no engine name on the response.
        engine = f"CASE WHEN coalesce({r}.raised, false) THEN '' ELSE {q(name)} END"
        error = f"coalesce({r}.error, {message(code)})"
        fetched = {"status_code": x.status_code, "redirected_url": x.redirected_url}
        facts = metadata_struct(merge_metadata(fetched, {n: f"{r}.metadata.{n}" for n, _ in schemas.METADATA_FIELDS}))
        result = attempt_struct(engine, code, error, f"{r}.title", f"{r}.content", f"{r}.content_format", facts)
        return df.selectExpr(*names, f"{result} AS {out}")

    return run


class Registry:
    """Engines by name, in registration order."""

    def __init__(self) -> None:
        self._engines: dict[str, tuple[Engine, bool]] = {}

    def register(self, name: str, engine: Engine, available: bool = True) -> "Registry":
        self._engines[name] = (engine, available)
        return self

    def names(self) -> list[str]:
        return list(self._engines)

    def available(self) -> list[str]:
        return [n for n, (_, ok) in self._engines.items() if ok]

    def get(self, name: str) -> Engine | None:
        """The engine, or None when it is unknown or not available."""
        engine, ok = self._engines.get(name, (None, False))
        return engine if ok else None

    def status(self, name: str) -> dict[str, Any]:
        if name not in self._engines:
            return {"engine": name, "exists": False, "available": False, "error": "no such engine"}
        return {"engine": name, "exists": True, "available": self._engines[name][1]}


def default_registry(config: Config | None = None) -> Registry:
    config = config or Config()
    return (
        Registry()
        .register("pruned", pruned_engine(config.pruned))
        .register("article", article_engine(config.article))
    )
