"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

OPTION_FIELDS = (
    ("content_filter_threshold", "DOUBLE"),
    ("remove_overlay_elements", "BOOLEAN"),
    ("output_format", "STRING"),
    ("include_comments", "BOOLEAN"),
    ("include_tables", "BOOLEAN"),
    ("include_links", "BOOLEAN"),
    ("deduplicate", "BOOLEAN"),
    ("target_language", "STRING"),
    ("prune_xpath", "ARRAY<STRING>"),
)
OPTION_KEYS = tuple(name for name, _ in OPTION_FIELDS)
OPTIONS = f"STRUCT<{', '.join(f'{name}: {kind}' for name, kind in OPTION_FIELDS)}>"

# The rule table as users store it.
RULES = (
    "name STRING, match_type STRING, match_pattern STRING, engine STRING, "
    f"css_selector STRING, extra_options {OPTIONS}, priority INT"
)

METADATA_FIELDS = (
    ("status_code", "INT"),
    ("redirected_url", "STRING"),
    ("author", "STRING"),
    ("date", "STRING"),
    ("sitename", "STRING"),
    ("description", "STRING"),
    ("language", "STRING"),
    ("hostname", "STRING"),
    ("image", "STRING"),
    ("fingerprint", "STRING"),
    ("categories", "ARRAY<STRING>"),
    ("tags", "ARRAY<STRING>"),
)
METADATA = f"STRUCT<{', '.join(f'{name}: {kind}' for name, kind in METADATA_FIELDS)}>"

ATTEMPT = (
    "STRUCT<engine: STRING, success: BOOLEAN, title: STRING, content: STRING, "
    f"content_format: STRING, metadata: {METADATA}, error_code: STRING, error: STRING>"
)

BLOCKS_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("tag", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("link_chars", T.IntegerType()),
            T.StructField("html", T.StringType()),
        ]
    )
)
REGION_TYPE = T.StructType(
    [T.StructField("region", T.StringType()), T.StructField("error", T.StringType())]
)

_METADATA_KINDS = {"INT": T.IntegerType(), "STRING": T.StringType(), "ARRAY<STRING>": T.ArrayType(T.StringType())}

# What a Python engine returns per page.
PYTHON_RESULT_TYPE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_format", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("raised", T.BooleanType()),
        T.StructField("metadata", T.StructType([T.StructField(name, _METADATA_KINDS[kind]) for name, kind in METADATA_FIELDS])),
    ]
)

PAGES = "page_id BIGINT, url STRING, html STRING"
REQUESTS = "request_id BIGINT, text STRING"
RESPONSES = (
    "pos BIGINT, url STRING, title STRING, content STRING, content_format STRING, "
    f"engine_used STRING, rule_matched STRING, metadata {METADATA}, success BOOLEAN, "
    "error_code STRING, error STRING"
)
RESPONSE_COLUMNS = (
    "pos",
    "url",
    "title",
    "content",
    "content_format",
    "engine_used",
    "rule_matched",
    "metadata",
    "success",
    "error_code",
    "error",
)
