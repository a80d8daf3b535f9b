"""Streaming (F4, F5): the page pipeline over unbounded tables of captured pages and of requests.

Routing in its CASE form and the engines are stateless row expressions, so a stream of pages needs no
watermark and no state; each page yields exactly one response. Requests wait for their captures in
an outer join of two streams, whose state the watermarks bound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagework import schemas
from pagework.config import Config
from pagework.functions.urls import is_valid_url, strip_url
from pagework.operators.batch import parse_pages
from pagework.operators.dispatch import parse_loaded
from pagework.operators.engines import Registry, default_registry
from pagework.operators.rules import RuleSet, force_engine, route, rule_set
from pagework.plans.materialize import new_path
from pagework.sources.pages import with_fetch_columns
from pagework.sources.rule_files import load_rules
from pagework.sources.rule_versions import RuleVersions


def read_page_stream(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """A stream of captured pages from the Parquet files of a folder. A ``glob`` without wildcards names one table
    in it, a file or a folder of files."""
    pages = spark.readStream.schema(schemas.PAGES)
    if any(c in glob for c in "*?[{"):
        return pages.option("pathGlobFilter", glob).parquet(folder)
    # A stream's path may be a file only where it is a pattern; a filter of names would leave out a folder's files.
    return pages.parquet(f"{folder}/{{{glob}}}")


def parse_stream(pages: DataFrame, rules: RuleSet | None = None, **options) -> DataFrame:
    """responses of a stream of pages, routed by the CASE form, however many rules there are."""
    return parse_pages(pages, rules.with_literals() if rules is not None else None, strategy="case", **options)


def parse_request_stream(
    requests: DataFrame,
    captures: DataFrame,
    rules: RuleSet | None = None,
    registry: Registry | None = None,
    config: Config | None = None,
    css: str | None = None,
    engine: str | None = None,
    wait: str = "10 minutes",
    before: str = "1 hour",
    late: str = "5 minutes",
) -> DataFrame:
    """F4 for requests that arrive one at a time: one response per request (pos, url, asked_at).

    ``captures`` has page_id, url, html, ``captured_at`` (a timestamp) and the optional fetch columns. A request
    takes the newest capture of its URL from ``before`` its own time to ``wait`` after it, whichever of the
    two arrives first; rows may be ``late`` by their event time. When the watermark has passed that
    time, the request is answered: with what there is, or as a page that could not be fetched. No state
    outlives ``wait`` + ``before`` + ``late``. The responses are those of ``parse_batch`` over the same rows.
    """
    registry = registry or default_registry(config)
    asked = requests.withWatermark("asked_at", late).select(
        "pos", "asked_at", F.coalesce("url", F.lit("")).alias("_given"), F.expr(strip_url("url")).alias("_url"))
    asked = asked.withColumn("_key", F.when(F.expr(is_valid_url("_url")), F.col("_url")))
    found = with_fetch_columns(captures).withWatermark("captured_at", late).select(
        F.col("url").alias("_of"), "captured_at", F.struct("captured_at", "page_id").alias("_when"), F.struct("html", "status_code", "redirected_url").alias("_page"))
    near = f"_key = _of AND captured_at >= asked_at - INTERVAL {before} AND captured_at <= asked_at + INTERVAL {wait}"
    joined = asked.join(found, F.expr(near), "left_outer")
    newest = joined.groupBy("pos", "asked_at", "_given", "_url", "_key").agg(F.max_by("_page", "_when").alias("_page"))
    loaded = newest.select("pos", "_given", F.col("_url").alias("url"), "_page.html", "_page.status_code", "_page.redirected_url", F.col("_key").isNotNull().alias("valid"))
    if engine or rules is None:
        routed = force_engine(loaded, engine or "")
    else:
        rules = rules.with_literals()
        routed = route(loaded, rules, strategy="case")
    parsed = parse_loaded(routed, registry, config, rules, css, engine)
    return parsed.withColumn("url", F.when(F.col("url") == "", F.col("_given")).otherwise(F.col("url"))).select(*schemas.RESPONSE_COLUMNS)


ONCE = {"availableNow": True}


def write_stream(
    responses: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Append the responses of a stream to a Parquet folder, once each. Without ``trigger`` (such as
    ``{"processingTime": "1 minute"}``, which runs on) it stops at the end of the available input."""
    checkpoint = checkpoint or new_path(responses.sparkSession, "stream")
    return (
        responses.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE)).start()
    )


def hot_rules_stream(
    pages: DataFrame,
    rules: str | RuleVersions,
    write: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """every micro-batch reads the stored rules again, so edited rules apply without a restart.

    ``rules`` is a path, or versions of rules: then the responses have a column ``rules_version``, and a
    batch that is repeated after a failure works with the version that it had at first. ``write``
    gets the responses and the batch number; as a batch may be repeated, it should write by batch number.
    """
    checkpoint = checkpoint or new_path(pages.sparkSession, "stream")

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if isinstance(rules, str):
            write(parse_pages(batch, rule_set(load_rules(spark, rules)), **options), number)
            return
        version = rules.version_of(spark, number, checkpoint)
        responses = parse_pages(batch, rule_set(rules.load(spark, version)), **options)
        write(responses.withColumn("rules_version", F.lit(version).cast("long")), number)

    return pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()
