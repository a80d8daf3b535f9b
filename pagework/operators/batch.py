"""Batch parsing (D5) and the direct form over a table of captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagework import errors, schemas
from pagework.config import Config
from pagework.functions.urls import is_valid_url, strip_url
from pagework.operators.dispatch import parse_loaded
from pagework.operators.engines import Registry, default_registry, metadata_struct
from pagework.operators.rules import RuleSet, force_engine, route
from pagework.plans.skew import MIN_HOT_ROWS, lookup_join
from pagework.sources.pages import CaptureStore, fetch_pages, with_fetch_columns


def _routed(df: DataFrame, rules: RuleSet | None, engine: str | None, strategy: str) -> DataFrame:
    if engine or rules is None:
        return force_engine(df, engine or "")
    return route(df, rules, strategy=strategy)


def parse_pages(
    pages: DataFrame,
    rules: RuleSet | None = None,
    registry: Registry | None = None,
    config: Config | None = None,
    css: str | None = None,
    engine: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Parse every captured page under its own URL; ``pos`` is the page id.

    Nothing has to be looked up, so with the CASE form of routing the whole pipeline is one pass
    over the table without a shuffle, and works on a stream as well.
    """
    registry = registry or default_registry(config)
    df = with_fetch_columns(pages).select(
        F.col("page_id").alias("pos"),
        F.expr(strip_url("url")).alias("url"),
        "html", "status_code", "redirected_url",
    )
    df = df.withColumn("valid", F.expr(is_valid_url("url")))
    routed = _routed(df, rules, engine, strategy)
    parsed = parse_loaded(routed, registry, config, rules, css, engine)
    return parsed.select(*schemas.RESPONSE_COLUMNS)


def parse_batch(
    inputs: DataFrame,
    pages: DataFrame | CaptureStore,
    rules: RuleSet | None = None,
    registry: Registry | None = None,
    config: Config | None = None,
    css: str | None = None,
    engine: str | None = None,
    strategy: str = "auto",
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """One response per row of ``inputs`` (pos, url), duplicates and unusable URLs included.
    ``pages`` is a table of captures or a store of them.

    Every distinct URL is routed, looked up and parsed once, however often it was asked for; the
    results go back to the input rows in a join that spreads URLs asked for very often.
    """
    registry = registry or default_registry(config)
    extra = [c for c in inputs.columns if c not in ("pos", "url")]
    checked = inputs.select(
        "*", F.expr(strip_url("url")).alias("_url"),
    ).withColumn("_valid", F.expr(is_valid_url("_url")))
    checked = checked.select(
        *extra, "pos", F.coalesce("url", F.lit("")).alias("_given"), "_url",
        F.when(F.col("_valid"), F.col("_url")).alias("_key"),
    )
    urls = checked.filter(F.col("_key").isNotNull()).select(F.col("_key").alias("url")).distinct()
    loaded = fetch_pages(_routed(urls, rules, engine, strategy), pages).withColumn("valid", F.lit(True))
    parsed = parse_loaded(loaded, registry, config, rules, css, engine).withColumnRenamed("url", "_key")
    joined = lookup_join(checked, parsed, "_key", F.struct("pos", *extra), min_hot_rows)

    blank = F.col("_url") == ""
    code = F.when(blank, errors.EMPTY_URL).otherwise(errors.INVALID_URL)
    text = F.when(blank, errors.MESSAGES[errors.EMPTY_URL]).otherwise(errors.MESSAGES[errors.INVALID_URL])
    bad = F.col("_key").isNull()
    return joined.select(
        *extra,
        "pos",
        F.when(blank, F.col("_given")).otherwise(F.col("_url")).alias("url"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("content", F.lit("")).alias("content"),
        F.coalesce("content_format", F.lit("markdown")).alias("content_format"),
        F.coalesce("engine_used", F.lit("")).alias("engine_used"),
        "rule_matched",
        F.coalesce("metadata", F.expr(metadata_struct({}))).alias("metadata"),
        F.coalesce("success", F.lit(False)).alias("success"),
        F.when(bad, code).otherwise(F.col("error_code")).alias("error_code"),
        F.when(bad, text).otherwise(F.col("error")).alias("error"),
    )
