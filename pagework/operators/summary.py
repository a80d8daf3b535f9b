"""Outcome summary (D7): exact counts, and sketches that merge over batches and days."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("engine_used", "rule_matched", "success", "error_code")


def outcome_summary(responses: DataFrame) -> DataFrame:
    """Responses and mean content length per engine, rule, outcome and failure code."""
    return _counted(responses).select(*KEYS, "n", (F.col("chars") / F.col("n")).alias("avg_chars"))


def outcome_totals(responses: DataFrame) -> DataFrame:
    """The same with subtotals. ``level`` is 0 for full detail and 15 for the grand total; the
    subtotals are taken over the counted groups, not over the responses."""
    return (
        _counted(responses).rollup(*KEYS)
        .agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.grouping_id().alias("level"))
        .select(*KEYS, "level", "n", (F.col("chars") / F.col("n")).alias("avg_chars"))
    )


def _counted(responses: DataFrame) -> DataFrame:
    return responses.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("content").cast("bigint")).alias("chars")
    )


# A sketch of distinct URLs is off by 1.04 / sqrt(2 ** LG_URLS), 0.4 %, as a standard error, and exact below some
# thousands; the rank of a quantile of lengths is off by about 2.3 / LENGTHS, 0.06 %, and exact below LENGTHS values.
LG_URLS = 16
LENGTHS = 4096
QUANTILES = (0.5, 0.9, 0.99)


def outcome_sketches(responses: DataFrame, lg_urls: int = LG_URLS, lengths: int = LENGTHS) -> DataFrame:
    """A mergeable row per engine, rule, outcome and failure code: ``n``, and sketches of ``urls`` and of content ``lengths``.

    Partial sketches are made where the responses are, so no URL and no length is shuffled. Store the rows
    of every batch and read all of them by :func:`read_sketches`.
    """
    return responses.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("url", lg_urls).alias("urls"),
        F.expr(f"kll_sketch_agg_bigint(CAST(length(content) AS BIGINT), {lengths})").alias("lengths"),
    )


def merge_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """The sketches of several batches as one row per combination of ``keys``, which may be fewer than they came with."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("urls").alias("urls"), F.expr("kll_merge_agg_bigint(lengths)").alias("lengths"))


def read_sketches(sketches: DataFrame, *keys: str, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """``keys``, ``n``, ``n_urls`` (different URLs) and a column ``chars_<percent>`` for each quantile of content lengths."""
    merged = merge_sketches(sketches, *keys)
    told = [f"kll_sketch_get_quantile_bigint(lengths, {x}D) AS chars_{round(x * 100)}" for x in quantiles]
    return merged.selectExpr(*keys, "n", "hll_sketch_estimate(urls) AS n_urls", *told)


def sketch_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A ``write`` for streams that stores the sketches of each batch below ``path`` by its number, so a batch that is
    repeated replaces its own. Read them with ``spark.read.parquet(path)``."""

    def write(responses: DataFrame, number: int) -> None:
        outcome_sketches(responses).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def observed(responses: DataFrame, name: str) -> DataFrame:
    """``responses`` with running counts that a listener of the query gets after every batch, as the event's observed
    metrics of that name: responses, failures, and an estimate of different URLs."""
    return responses.observe(
        name, F.count(F.lit(1)).alias("n"), F.count_if(~F.col("success")).alias("failed"), F.approx_count_distinct("url").alias("n_urls"))
