"""Readable reports.

A report is a row per part: ``part`` of ``total``, numbered inside its request, whatever the size.
The texts of a report, read in order of their parts, are the report. Numbers come from counts per
bucket of positions and ranks inside a bucket, so no task ranks a whole long request; the bucket
size changes how the work is cut, never the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagework import errors
from pagework.functions.text import q
from pagework.functions.urls import extract_urls, filter_valid, strip_url
from pagework.operators.batch import parse_batch
from pagework.operators.engines import message
from pagework.plans.materialize import materialize
from pagework.sources.pages import CaptureStore

BUCKET = 256


def format_response() -> str:
    """one response as text, from the columns of a response row."""
    rule = "CASE WHEN rule_matched <> '' THEN concat('Rule: ', rule_matched) END"
    failed = f"concat('Failed: ', coalesce(error, {q(errors.UNKNOWN_ERROR)}), '\\nURL: ', url)"
    good = (
        "concat_ws('\\n', concat('Title: ', title), concat('URL: ', url), "
        f"concat('Engine: ', engine_used), {rule}, '', 'Content:', content)"
    )
    return f"CASE WHEN success THEN {good} ELSE {failed} END"


def _numbered(df: DataFrame, group: str, flag: str, bucket: int) -> DataFrame:
    """``df`` with ``_i`` and ``_n``: rank (from 1) and number of the rows of its group with the same ``flag``."""
    cut = df.withColumn("_bucket", F.expr(f"pos div {bucket}"))
    counts = cut.groupBy(group, flag, "_bucket").agg(F.count("*").alias("_c"))
    inside = Window.partitionBy(group, flag).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group, flag, "_bucket", F.coalesce(F.sum("_c").over(inside), F.lit(0)).alias("_before"),
        F.sum("_c").over(Window.partitionBy(group, flag)).alias("_n"),
    )
    rank = F.row_number().over(Window.partitionBy(group, flag, "_bucket").orderBy("pos"))
    ranked = cut.withColumn("_rank", rank)
    return ranked.join(offsets, [group, flag, "_bucket"]).withColumn("_i", F.col("_before") + F.col("_rank"))


def _headed(text: str) -> str:
    """A part with its 'i/n' header (none for a single part), led by its separator."""
    lead = "CASE WHEN _i > 1 THEN '\\n\\n' ELSE '' END"
    header = "CASE WHEN _n > 1 THEN concat('=== Result ', _i, '/', _n, ' ===\\n') ELSE '' END"
    return f"concat({lead}, {header}, {text})"


def format_responses(
    responses: DataFrame, group: str = "request_id", requests: DataFrame | None = None, bucket: int = BUCKET
) -> DataFrame:
    """(group, part, total, text), a row per response. ``responses`` has the group column, ``pos`` as a
    whole number that orders the responses of a group, and the response columns; pass a written
    table, it is read twice. With ``requests``, groups without responses get one part, a fixed text.
    """
    entries = responses.select(group, "pos", F.expr(format_response()).alias("text"), F.lit(True).alias("_one"))
    out = _numbered(entries, group, "_one", bucket).selectExpr(
        group, "_i AS part", "_n AS total", f"{_headed('text')} AS text"
    )
    if requests is None:
        return out
    # Only ids meet in this join: the texts of a long report must not gather in one task.
    empty = requests.select(group).join(responses.select(group).distinct(), group, "left_anti")
    return out.unionByName(empty.selectExpr(group, "1L AS part", "1L AS total", f"{q(errors.NO_RESULTS)} AS text"))


def _inputs(requests: DataFrame) -> DataFrame:
    """Requests with the array of their URLs and the code of unusable ones."""
    found = requests.select("request_id", F.expr(extract_urls("text")).alias("_all"), "text")
    checked = found.withColumn("_urls", F.expr(filter_valid("_all")))
    blank = F.expr(strip_url("text")) == ""
    code = (
        F.when(blank, errors.NO_INPUT)
        .when(F.size("_all") == 0, errors.NO_URL_FOUND)
        .when(F.size("_urls") == 0, errors.NO_VALID_URL)
    )
    return checked.select("request_id", "_urls", code.alias("_code"))


def execute_requests(
    requests: DataFrame, pages: DataFrame | CaptureStore, bucket: int = BUCKET, **parse_options
) -> DataFrame:
    """(request_id, part, total, ok, code, text) for every request (request_id, text), a row per response.

    A request fails as a whole when it is blank, names no usable URL, or all its URLs fail. Otherwise
    its report shows the successes, numbered among themselves, and then lists the failed URLs.
    """
    inputs = _inputs(requests)
    urls = inputs.filter(F.col("_code").isNull()).select("request_id", F.posexplode("_urls").alias("pos", "url"))
    urls = urls.withColumn("pos", F.col("pos").cast("bigint"))
    parsed = parse_batch(urls, pages, **parse_options)
    # Counting comes before writing: without a written table every URL would be parsed twice.
    parsed = materialize(parsed, "responses")
    entries = parsed.select(
        "request_id", "pos", "success", "url", F.coalesce("error", F.lit(errors.UNKNOWN_ERROR)).alias("error"),
        F.expr(f"CASE WHEN success THEN {format_response()} END").alias("text"),
    )
    good = parsed.groupBy("request_id").agg(F.count_if("success").alias("_good"), F.count("*").alias("_all"))
    joined = _numbered(entries, "request_id", "success", bucket).join(good, "request_id")
    section = f"CASE WHEN _i = 1 THEN {q(errors.FAILED_SECTION)} ELSE '\\n' END"
    only = f"CASE WHEN _i = 1 THEN {q(errors.ALL_FAILED_PREFIX)} ELSE '; ' END"
    failed = f"CASE WHEN _good > 0 THEN concat({section}, url, ': ', error) ELSE concat({only}, error) END"
    done = joined.selectExpr(
        "request_id", "CASE WHEN success THEN _i ELSE _good + _i END AS part", "_all AS total", "_good > 0 AS ok",
        f"CASE WHEN _good = 0 THEN {q(errors.ALL_FAILED)} END AS code",
        f"CASE WHEN success THEN {_headed('text')} ELSE {failed} END AS text",
    )
    # A request with a usable URL has at least one response, so the two parts cover all requests.
    refused = inputs.filter(F.col("_code").isNotNull()).selectExpr(
        "request_id", "1L AS part", "1L AS total", "false AS ok", "_code AS code", f"{message('_code')} AS text"
    )
    return done.unionByName(refused)
