"""Site rules (R1-R7): compile a rule table and route URLs by it.

A rule table is a DataFrame with schema :data:`pagework.schemas.RULES` plus ``rule_idx``, the list
position that breaks ties between equal priorities, and optionally ``line``, which breaks those that
are left. Routing has two forms with equal results:

* ``case``: the rules become one literal CASE chain in rank order. Stateless, no join; meant for
  the usual rule set of a few dozen entries and for streams.
* ``join``: domain rules are found by an equi-join on domain suffixes, regular expressions by an
  equi-join of the URLs' pieces with an inverted index of pieces that the patterns require; a pattern
  is tried only on URLs that hold one of its pieces. Neither plan nor cost of a row grows with the rules.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pagework import schemas
from pagework.config import Config
from pagework.functions.patterns import PATTERN_TYPE, compile_patterns, java_pattern, pieces_of
from pagework.functions.text import let, matches, q
from pagework.functions.urls import url_domain
from pagework.plans.materialize import materialize
from pagework.plans.skew import MIN_HOT_ROWS, lookup_join
from pagework.sources.pages import only_wanted

log = logging.getLogger(__name__)

LOGGED = 5  # patterns that never match
# Above this many rules, route() prefers the join form.
MAX_CASE_RULES = 64
_CHUNK = 32

_OPTION_TYPES = {
    "content_filter_threshold": float,
    "remove_overlay_elements": bool,
    "output_format": str,
    "include_comments": bool,
    "include_tables": bool,
    "include_links": bool,
    "deduplicate": bool,
    "target_language": str,
    "prune_xpath": lambda v: [v] if isinstance(v, str) else [str(x) for x in v],
}


def _entry(idx: int, rule: Mapping[str, Any]) -> dict[str, Any]:
    given = rule.get("extra_options") or {}
    options = {k: _OPTION_TYPES[k](given[k]) for k in schemas.OPTION_KEYS if given.get(k) is not None}
    return {
        "rule_idx": idx,
        "name": rule.get("name", ""),
        "match_type": rule.get("match_type", "domain"),
        "match_pattern": rule.get("match_pattern", ""),
        "engine": rule.get("engine", ""),
        "css_selector": rule.get("css_selector"),
        "extra_options": options or None,
        "priority": int(rule.get("priority", 0)),
    }


def rules_from_list(spark: SparkSession, rules: Iterable[Mapping[str, Any]]) -> DataFrame:
    """S2 for rules given in code. A bad entry is logged and skipped, the others still load."""
    rows = []
    for idx, rule in enumerate(rules):
        try:
            rows.append(_entry(idx, rule))
        except (AttributeError, TypeError, ValueError) as e:
            log.error("site rule %d skipped: %s", idx, e)
    # As a JSON literal the rules stay part of the plan; no task has to ship them.
    kind = f"ARRAY<STRUCT<rule_idx INT, {schemas.RULES}>>"
    return spark.sql(f"SELECT inline(from_json({q(json.dumps(rows))}, {q(kind)}))")


def domain_key(pattern: str) -> str:
    """The suffix a domain rule looks for: lower case, without a leading '*.'."""
    return f"CASE WHEN {pattern} LIKE '*.%' THEN lower(substr({pattern}, 3)) ELSE lower({pattern}) END"


_compile = F.arrow_udf(compile_patterns, PATTERN_TYPE)


def compile_rules(rules: DataFrame) -> DataFrame:
    """Fill defaults, mark rules that can never match, and rank the rest.

    ``rank`` orders by priority descending, list position and line. It is computed from the row itself,
    so a large table needs no global sort, and no two rules share one unless they are alike in
    every field. ``pattern`` holds the translated regular expression and the pieces it is indexed by.
    """
    r = rules.select(
        "rule_idx",
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("match_type", F.lit("domain")).alias("match_type"),
        F.coalesce("match_pattern", F.lit("")).alias("match_pattern"),
        F.coalesce("engine", F.lit("")).alias("engine"),
        "css_selector",
        F.col("extra_options").alias("options"),
        F.coalesce("priority", F.lit(0)).alias("priority"),
        (F.col("line") if "line" in rules.columns else F.lit(0)).cast("bigint").alias("line"),
    )
    told = _compile(F.when(F.col("match_type") == "regex", F.col("match_pattern")))
    r = r.withColumn("pattern", told)
    is_domain = (F.col("match_type") == "domain") & (F.col("match_pattern") != "")
    # What Java cannot compile comes out as null instead of ending the job.
    tried = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("matches"), F.col("pattern.java"), F.lit(""))
    is_regex = (F.col("match_type") == "regex") & F.col("pattern.java").isNotNull() & tried.isNotNull()
    whole = F.xxhash64(*(c for c in r.columns if c not in ("line", "pattern")))
    return r.select(
        "*",
        (is_domain | is_regex).alias("usable"),
        F.struct(
            (-F.col("priority").cast("bigint") * F.lit(2**32) + F.col("rule_idx")).alias("first"), "line", whole.alias("tie"),
        ).alias("rank"),
    )


def _log_unusable(rows: Iterable[Row]) -> None:
    bad = [r.match_pattern for r in rows if r.match_type == "regex" and not r.usable]
    if bad:
        log.error("site rule patterns that are no valid regular expressions, or use what Java's do not support, never match; among them: %s", bad[:LOGGED])


@dataclass(frozen=True)
class RuleSet:
    """A compiled rule table, with its literal rules, in rank order, when there are few enough of them."""

    table: DataFrame
    literal: tuple[Row, ...] | None
    kinds: frozenset[str]  # match types of usable rules

    @property
    def uses_css(self) -> bool:
        return self.literal is None or any(r.css_selector for r in self.literal)

    @property
    def option_keys(self) -> frozenset[str]:
        """Option keys some rule may set; a plan leaves out the work of all others."""
        if self.literal is None:
            return frozenset(schemas.OPTION_KEYS)
        return frozenset(
            k for r in self.literal if r.options for k, v in r.options.asDict().items() if v is not None
        )

    @property
    def engines(self) -> frozenset[str] | None:
        """Engine names some rule asks for; None when the table was not read."""
        return None if self.literal is None else frozenset(r.engine for r in self.literal)

    def with_literals(self) -> "RuleSet":
        """The same rules as literals of the plan, however many they are; for routing without a join."""
        return self if self.literal is not None else RuleSet(self.table, _in_order(self.table.collect()), self.kinds)


def _in_order(rows: Iterable[Row]) -> tuple[Row, ...]:
    return tuple(sorted((r for r in rows if r.usable), key=lambda r: r.rank))


def rule_set(rules: DataFrame, case_limit: int | None = MAX_CASE_RULES) -> RuleSet:
    """``case_limit``: rules up to which they become literals of the plan; None for always. A larger
    table is compiled once and written, and none of its patterns passes through the driver."""
    table = compile_rules(rules)
    few = (table if case_limit is None else table.limit(case_limit + 1)).collect()
    if case_limit is None or len(few) <= case_limit:
        _log_unusable(few)
        return RuleSet(table, _in_order(few), frozenset(r.match_type for r in few if r.usable))
    table = materialize(table, "rules")
    kinds = table.groupBy("match_type", "usable").agg(F.min("match_pattern").alias("match_pattern")).collect()
    _log_unusable(kinds)
    return RuleSet(table, None, frozenset(r.match_type for r in kinds if r.usable))


def match_domain(domain: str, pattern: str) -> str:
    """R2 as a condition: equal to the suffix, or ending in '.' and the suffix."""
    hit = let(domain_key(pattern), lambda k: f"({domain} = {k} OR endswith({domain}, concat('.', {k})))")
    return f"({domain} <> '' AND {pattern} <> '' AND {hit})"


def match_regex(url: str, pattern: str) -> str:
    """The pattern occurs anywhere in the URL."""
    java = java_pattern(pattern)
    return "false" if java is None else matches(url, java)


def _literal_hit(rule: Row, url: str, domain: str) -> str:
    if rule.match_type == "regex":
        return match_regex(url, rule.match_pattern)
    key = rule.match_pattern.lower().removeprefix("*.")
    return f"({domain} <> '' AND ({domain} = {q(key)} OR endswith({domain}, {q('.' + key)})))"


def _chunked(branches: list[str], kind: str) -> str:
    """One CASE over all branches, cut into pieces of moderate size."""
    cases = [
        f"CASE {' '.join(branches[i : i + _CHUNK])} END" for i in range(0, len(branches), _CHUNK)
    ]
    return f"CAST(coalesce({', '.join(cases)}) AS {kind})" if cases else f"CAST(NULL AS {kind})"


def first_literal(rules: Iterable[Row], url: str, domain: str) -> str:
    """R4 for literal rules: the number of the first rule that matches, else null."""
    return _chunked([f"WHEN {_literal_hit(r, url, domain)} THEN {i}" for i, r in enumerate(rules)], "INT")


_ROUTE_NAMES = ("rule_matched", "rule_engine", "css_selector", "options")


def _options_literal(rule: Row) -> str:
    given = rule.options.asDict()

    def literal(value: Any) -> str:
        return f"array({', '.join(map(q, value))})" if isinstance(value, list) else q(value)

    fields = ", ".join(f"'{k}', {literal(given[k])}" for k in schemas.OPTION_KEYS)
    return f"CAST(named_struct({fields}) AS {schemas.OPTIONS})"


def _pick(rules: Iterable[Row]) -> dict[str, str]:
    """The attributes of the literal rule whose number is in ``_rule``; null when there is none."""
    rules = list(rules)

    def chain(value, kind: str = "STRING") -> str:
        return _chunked([f"WHEN _rule = {i} THEN {v}" for i, r in enumerate(rules) if (v := value(r)) is not None], kind)

    return {
        "name": chain(lambda r: q(r.name)),
        "engine": chain(lambda r: q(r.engine)),
        "css_selector": chain(lambda r: q(r.css_selector) if r.css_selector else None),
        "options": chain(lambda r: None if r.options is None else _options_literal(r), schemas.OPTIONS),
    }


def _route_case(df: DataFrame, rules: RuleSet, url: str) -> DataFrame:
    assert rules.literal is not None
    df = df.withColumn("domain", F.expr(url_domain(url)))
    ranked = df.withColumn("_rule", F.expr(first_literal(rules.literal, url, "domain")))
    picked = _pick(rules.literal)
    return ranked.selectExpr(*df.columns, *[f"{picked[n]} AS {out}" for n, out in zip(picked, _ROUTE_NAMES)])


def domain_suffixes(domain: str) -> str:
    """'a.b.c' -> ['a.b.c', 'b.c', 'c']."""

    def tails(labels: str) -> str:
        return f"transform({labels}, (_, i) -> array_join(slice({labels}, i + 1, size({labels})), '.'))"

    return let(f"split({domain}, '[.]', -1)", tails)


_ENTRY = ("rank", "name", "engine", "css_selector", "options")


def best_domain_rule(domains: DataFrame, rules: RuleSet) -> DataFrame:
    """R2 as an equi-join: the best domain rule, as a struct, per distinct ``domain``.

    Each side is brought to one row per key before the join. Spark broadcasts a rule table whose
    measured bytes are few and else splits the partitions of popular suffixes ('com').
    """
    wanted = (
        rules.table.filter((F.col("match_type") == "domain") & F.col("usable"))
        .select(F.expr(domain_key("match_pattern")).alias("suffix"), "rank", F.struct(*_ENTRY).alias("entry"))
        .groupBy("suffix")
        .agg(F.min_by("entry", "rank").alias("entry"))
    )
    parts = (
        domains.select("domain").filter(F.col("domain") != "").distinct()
        .select("domain", F.explode(F.expr(f"array_distinct({domain_suffixes('domain')})")).alias("suffix"))
    )
    hits = parts.join(wanted, "suffix")
    return hits.groupBy("domain").agg(F.min_by("entry", F.col("entry.rank")).alias("_entry"))


def pattern_index(rules: RuleSet) -> DataFrame:
    """``piece, java, entry``: every usable pattern under the pieces that it is looked up by.

    A pattern offers covers, sets of pieces one of which every match holds. The one is taken whose
    pieces the fewest patterns offer, where a character more outweighs twice as many of them. A pattern
    without any stands under the empty piece, which every URL holds.
    """
    usable = rules.table.filter((F.col("match_type") == "regex") & F.col("usable"))
    # Rules of the same pattern can only ever yield the first of them.
    first = usable.groupBy("match_pattern").agg(F.min_by(F.struct(F.col("pattern.java").alias("java"), F.col("pattern.covers").alias("covers"), F.struct(*_ENTRY).alias("entry")), "rank").alias("r"))
    offered = first.select("match_pattern", F.posexplode("r.covers").alias("cover", "pieces"))
    offered = offered.select("match_pattern", "cover", F.explode("pieces").alias("piece"))
    counts = offered.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    costs = offered.join(counts, "piece").groupBy("match_pattern", "cover").agg(F.sum(F.col("n") / F.pow(F.lit(2.0), F.length("piece"))).alias("n"), F.collect_list("piece").alias("pieces"))
    best = costs.groupBy("match_pattern").agg(F.min_by("pieces", F.struct("n", "cover")).alias("pieces"))
    chosen = first.join(best, "match_pattern")
    return chosen.select(F.explode("pieces").alias("piece"), F.col("r.java").alias("java"), F.col("r.entry").alias("entry"))


def best_pattern_rule(urls: DataFrame, rules: RuleSet, url: str = "url") -> DataFrame:
    """R3 as an equi-join: the best rule by regular expression, as a struct, per distinct URL.

    The index is joined on the pieces of the URLs, of the lengths that it has; a pattern is tried on the
    URLs that share a piece with it and on no other. Nearly all pieces that the index does not have go
    before any URL is copied for them. The number of partitions is fixed because what follows works hard
    per row: URLs are so short that merged partitions would leave it to a few tasks.
    """
    index = materialize(pattern_index(rules), "pattern-index")
    lengths = index.agg(F.sort_array(F.collect_set(F.length("piece")))).scalar()
    partitions = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = urls.select(F.col(url).alias("_url")).filter("_url IS NOT NULL").distinct()
    texts = texts.repartition(partitions, F.xxhash64("_url"))  # by "_url" itself it would be dropped as done by distinct()
    parts = texts.withColumn("_lengths", lengths).select("_url", F.explode(F.expr(pieces_of("_url", "_lengths"))).alias("url"))
    parts = only_wanted(parts, index.select(F.col("piece").alias("url"))).withColumnRenamed("url", "piece")
    hits = parts.join(index, "piece").filter("_url RLIKE java")
    return hits.groupBy("_url").agg(F.min_by("entry", F.col("entry.rank")).alias("_found"))


def _route_join(df: DataFrame, rules: RuleSet, url: str, min_hot_rows: int) -> DataFrame:
    df = df.withColumn("domain", F.expr(url_domain(url)))
    # What tells rows of a hot domain or URL apart: the URL and the row's numbers.
    spread: Column = F.xxhash64(url, *(c for c, kind in df.dtypes if kind in ("bigint", "int", "smallint", "tinyint")))
    hit = lookup_join(df, best_domain_rule(df, rules), "domain", spread, min_hot_rows)
    best = F.col("_entry")
    if "regex" in rules.kinds:
        keyed = hit.withColumn("_url", F.col(url))
        hit = lookup_join(keyed, best_pattern_rule(df, rules, url), "_url", spread, min_hot_rows)
        by_pattern = F.coalesce(F.col("_found.rank") < F.col("_entry.rank"), F.col("_found").isNotNull())
        best = F.when(by_pattern, F.col("_found")).otherwise(best)
    names = ("name", "engine", "css_selector", "options")
    return hit.withColumn("_best", best).select(*df.columns, *[F.col(f"_best.{n}").alias(out) for n, out in zip(names, _ROUTE_NAMES)])


def route(
    df: DataFrame,
    rules: RuleSet,
    url: str = "url",
    strategy: str = "auto",
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add ``domain`` and the first matching rule (nulls when none matches) to every row."""
    if strategy == "auto":
        strategy = "join" if rules.literal is None else "case"
    if strategy == "case":
        return _route_case(df, rules, url)
    return _route_join(df, rules, url, min_hot_rows)


def force_engine(df: DataFrame, engine: str, url: str = "url") -> DataFrame:
    """Every row goes to one engine; rules are not consulted."""
    return df.select(
        "*",
        F.expr(url_domain(url)).alias("domain"),
        F.lit(None).cast("string").alias("rule_matched"),
        F.lit(engine).alias("rule_engine"),
        F.lit(None).cast("string").alias("css_selector"),
        F.lit(None).cast(schemas.OPTIONS).alias("options"),
    )


def resolve_options(df: DataFrame, config: Config, css: str | None = None) -> DataFrame:
    """The selector and options an attempt by rule works with, one column each.

    A selector of the call wins over the rule's; an option the rule sets wins over the settings.
    """
    settings = {**vars(config.pruned), **vars(config.article), "prune_xpath": None}
    chosen = [
        f"CAST(coalesce(options.{k}, {q(settings[k])}) AS {kind}) AS {k}"
        for k, kind in schemas.OPTION_FIELDS
    ]
    return df.selectExpr("*", f"coalesce({q(css or None)}, css_selector) AS css", *chosen)
