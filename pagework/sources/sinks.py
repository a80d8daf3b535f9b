"""Sinks for responses and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagework import schemas


def write_responses(responses: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S3: responses as Parquet."""
    responses.write.mode(mode).parquet(path)


def response_json(columns: tuple[str, ...] = schemas.RESPONSE_COLUMNS) -> Column:
    """S3: one JSON object per response with every field present, null or not."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def responses_to_json(responses: DataFrame) -> DataFrame:
    return responses.select("pos", response_json().alias("json"))


def write_text(reports: DataFrame, path: str, text: str = "text", mode: str = "errorifexists") -> None:
    """One readable text per row. Line breaks inside a text are kept; a form feed ends it."""
    reports.select(F.col(text).alias("value")).write.mode(mode).option("lineSep", "\n\f\n").text(path)
