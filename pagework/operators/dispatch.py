"""Engine dispatch (D1-D4, D6): one linear fold over attempts.

Each stage sees only the rows that are still pending: their page is the engine's input, all other
rows pass null. The plan stays one scan with no union and no shuffle, and a Python engine is called
for exactly the rows that reach it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pagework import errors, schemas
from pagework.config import Config
from pagework.functions.text import q, q_list
from pagework.functions.urls import truncate_content
from pagework.operators.engines import Inputs, Registry, failure_struct
from pagework.operators.rules import RuleSet

# Columns the fold reads; everything else on a row is passed through.
_WORK = frozenset(
    "html status_code redirected_url domain rule_matched rule_engine css_selector options valid "
    "page_id captured_at".split()
)


def engine_order(registry: Registry, config: Config | None) -> list[str]:
    """Names to try, in order: the configured ones, or all registered ones when none are named."""
    return list(config.engine_order) if config and config.engine_order else registry.names()


def _no_engine(registry: Registry, name: str) -> str:
    known = f"{name} IN ({q_list(registry.names())})" if registry.names() else "false"
    code = f"CASE WHEN {known} THEN {q(errors.ENGINE_UNAVAILABLE)} ELSE {q(errors.ENGINE_UNKNOWN)} END"
    state = f"CASE WHEN {known} THEN 'is not available' ELSE 'does not exist' END"
    return failure_struct(code, f"concat('engine \\'', {name}, '\\' ', {state})")


def attempt(
    df: DataFrame,
    out: str,
    registry: Registry,
    engine: str,
    names: list[str],
    gate: str,
    css: str | None,
    options: str | None,
    option_keys: frozenset[str],
) -> DataFrame:
    """Add ``out``, the attempt of the engine that the expression ``engine`` names, for rows
    where ``gate`` holds. ``names`` are the engines it may name; others are not planned."""
    columns = df.columns
    df = df.selectExpr("*", f"{engine} AS {out}_name", f"coalesce({gate}, false) AS {out}_gate")
    branches = []
    for i, name in enumerate(n for n in names if registry.get(n)):
        mine = f"({out}_gate AND {out}_name = {q(name)})"
        inputs = Inputs(
            url="url",
            html=f"CASE WHEN {mine} THEN html END",
            css=None if css is None else f"CASE WHEN {mine} AND {css} <> '' THEN {css} END",
            options=options,
            option_keys=option_keys,
            status_code="status_code",
            redirected_url="redirected_url",
        )
        df = registry.get(name)(df, f"{out}_{i}", inputs)
        branches.append(f"WHEN {mine} THEN {out}_{i}")
    branches.append(f"WHEN {out}_gate THEN {_no_engine(registry, f'{out}_name')}")
    return df.selectExpr(*columns, f"CASE {' '.join(branches)} END AS {out}")


def parse_loaded(
    df: DataFrame,
    registry: Registry,
    config: Config | None = None,
    rules: RuleSet | None = None,
    css: str | None = None,
    engine: str | None = None,
) -> DataFrame:
    """Run the engines over routed rows that already carry their page.

    ``df`` has url, html, status_code, redirected_url, valid and the routing columns; the result
    adds the response columns except ``pos`` and drops the page.
    """
    call_css = q(css) if css else None
    keep = [c for c in df.columns if c not in _WORK]
    none = frozenset[str]()

    if engine:
        df = attempt(df, "_a", registry, q(engine), [engine], "valid", call_css, None, none)
        return _responses(df, keep, "_a", "NULL", config)

    # The rule's own engine, with the rule's selector and options.
    if rules is not None and (rules.literal is None or rules.literal):
        asked = registry.names() if rules.engines is None else sorted(rules.engines)
        rule_css = call_css or ("css_selector" if rules.uses_css else None)
        df = attempt(
            df, "_a", registry, "rule_engine", asked, "valid AND rule_matched IS NOT NULL",
            rule_css, "options" if rules.option_keys else None, rules.option_keys,
        )
        done = "coalesce(_a.success, false)"
        df = df.selectExpr("*", f"{done} AS _done", f"CASE WHEN {done} THEN _a END AS _result").drop("_a")
    else:
        df = df.selectExpr("*", "false AS _done", f"CAST(NULL AS {schemas.ATTEMPT}) AS _result")

    # The fallback engines, with the call's selector and no options.
    order = engine_order(registry, config)
    messages: list[str] = []
    for i, name in enumerate(n for n in order if registry.get(n)):
        a = f"_f{i}"
        columns = [c for c in df.columns if c not in ("_done", "_result")]
        df = attempt(df, a, registry, q(name), [name], "valid AND NOT _done", call_css, None, none)
        ok = f"coalesce({a}.success, false)"
        reason = f"concat({q(name + ': ')}, coalesce({a}.error, {q(errors.UNKNOWN_ERROR)}))"
        df = df.selectExpr(
            *columns,
            f"_done OR {ok} AS _done",
            f"coalesce(_result, CASE WHEN {ok} THEN {a} END) AS _result",
            f"CASE WHEN valid AND NOT _done AND NOT {ok} THEN {reason} END AS {a}_msg",
        )
        messages.append(f"{a}_msg")

    if order:
        # array_join leaves out nulls: the engines that were not reached.
        listed = f"array_join(array({', '.join(messages)}), '; ')" if messages else "''"
        all_failed = failure_struct(q(errors.ALL_ENGINES_FAILED), f"concat('all engines failed (', {listed}, ')')")
    else:
        code = errors.NO_ENGINE_CONFIGURED
        all_failed = failure_struct(q(code), q(errors.MESSAGES[code]))
    return _responses(df, keep, f"coalesce(_result, {all_failed})", "CASE WHEN _done THEN rule_matched END", config)


def _responses(df: DataFrame, keep: list[str], result: str, rule: str, config: Config | None) -> DataFrame:
    """Response columns from the winning attempt; rows with an unusable URL fail as such."""
    # A blank URL and a malformed one are different failures.
    code = f"CASE WHEN url = '' THEN {q(errors.EMPTY_URL)} ELSE {q(errors.INVALID_URL)} END"
    text = f"CASE WHEN url = '' THEN {q(errors.MESSAGES[errors.EMPTY_URL])} ELSE {q(errors.MESSAGES[errors.INVALID_URL])} END"
    df = df.selectExpr(
        *keep,
        f"CASE WHEN valid THEN {result} ELSE {failure_struct(code, text)} END AS _win",
        f"CASE WHEN valid THEN CAST({rule} AS STRING) END AS _rule",
    )
    content = "_win.content"
    if config is not None:
        content = truncate_content(content, config.max_content_length)
    return df.selectExpr(
        *keep,
        "_win.title AS title",
        f"{content} AS content",
        "_win.content_format AS content_format",
        "_win.engine AS engine_used",
        # Failures outside an engine carry no rule.
        "CASE WHEN _win.success OR _win.engine <> '' THEN _rule END AS rule_matched",
        "_win.metadata AS metadata",
        "_win.success AS success",
        "_win.error_code AS error_code",
        "_win.error AS error",
    )
