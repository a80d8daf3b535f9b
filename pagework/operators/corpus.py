"""Whole-table steps around extraction: corpus deduplication (X11) and fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagework.functions.fingerprints import fingerprint
from pagework.functions.text import non_empty

BITS = 32
POSITIONS = 2**32


def dedup_paragraphs(paragraphs: DataFrame, min_chars: int = 1) -> DataFrame:
    """X11: of each paragraph text of at least ``min_chars`` characters keep the first copy, in the
    order of (page_id, pos). Shorter paragraphs all stay.

    ``paragraphs`` has page_id, pos and text. Copies meet in a grouping on the text itself, which
    aggregates before the shuffle: a footer on every page costs one row per task. A short paragraph
    forms its own group, so a frequent short text is not one large group either.
    """
    short = F.length("text") < min_chars
    # One number per place, in reading order: unlike a struct it fits a hash aggregation buffer.
    place = F.expr(f"CAST(page_id AS DECIMAL(20, 0)) * {POSITIONS}BD + pos")
    first = paragraphs.groupBy(
        "text",
        F.when(short, F.col("page_id")).alias("_page"),
        F.when(short, F.col("pos")).alias("_pos"),
    ).agg(F.min(place).alias("_first"))
    return first.selectExpr(
        f"CAST(floor(_first / {POSITIONS}BD) AS BIGINT) AS page_id",
        f"CAST(pmod(_first, {POSITIONS}BD) AS INT) AS pos",
        "text",
    )


def join_paragraphs(paragraphs: DataFrame, separator: str = "\n\n") -> DataFrame:
    """Put the paragraphs of each page back together in order; a group is one page."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return paragraphs.groupBy("page_id").agg(
        F.array_join(F.transform(rows, lambda r: r["text"]), separator).alias("content")
    )


def dedup_documents(documents: DataFrame, key: str = "page_id", content: str = "content") -> DataFrame:
    """X11: keep the first copy, by ``key``, of each content. Returns ``key`` and ``content``."""
    return documents.groupBy(content).agg(F.min(key).alias(key)).select(key, content)


def fingerprints(documents: DataFrame, key: str, text: str) -> DataFrame:
    """32-bit SimHash over the word tokens of a text, as eight hex digits; '' without tokens.

    A token votes with the first eight hex digits of its MD5. All partial sums of a document arise in
    the task that holds it, so what is shuffled is one narrow row per document. Faster than the expression for
    long texts, which :func:`with_fingerprints` uses to stay in one pass.
    """
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    words = documents.select(key, F.explode_outer(tokens).alias("token"))
    hashed = words.select(key, F.expr("CAST(conv(substring(md5(token), 1, 8), 16, 10) AS BIGINT)").alias("h"))
    votes = [
        F.sum(F.when(F.shiftright("h", i).bitwiseAND(F.lit(1)) == 1, 1).otherwise(-1)).alias(f"b{i}")
        for i in range(BITS)
    ]
    total = hashed.groupBy(key).agg(F.count("h").alias("n"), *votes)
    value = sum((F.when(F.col(f"b{i}") > 0, F.lit(1 << i)).otherwise(F.lit(0)) for i in range(BITS)), F.lit(0))
    text_value = F.lower(F.lpad(F.hex(value.cast("bigint")), BITS // 4, "0"))
    return total.select(key, F.when(F.col("n") > 0, text_value).otherwise("").alias("fingerprint"))


def with_fingerprints(responses: DataFrame) -> DataFrame:
    """Set ``metadata.fingerprint`` of successful responses, in the pass that reads them. Responses of an
    article engine with the option ``fingerprint`` have it already."""
    told = F.expr(f"CASE WHEN success THEN {non_empty(fingerprint('content'))} END")
    return responses.withColumn("metadata", F.col("metadata").withField("fingerprint", told)).select(*responses.columns)
