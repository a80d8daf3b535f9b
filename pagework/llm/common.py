"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of ``df`` that are none of ``names`` (compared as Spark does, without case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts: one narrow scan, so that later steps can be cut to pieces of even size."""
    total = df.agg(F.sum(F.octet_length(F.col(quoted(text))))).first()[0]
    return int(total or 0)


def pieces(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-total // each))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What runs inside sends texts to Python workers in batches of at most so many rows. A batch of long texts is
    held several times over, by the JVM, by Arrow and as strings, in every worker of an executor."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Return what earlier tasks of a reused worker have left to the system, where the C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
