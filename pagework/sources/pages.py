"""Captured pages (S1): the table that stands for fetching a URL, and a store of captures by URL."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagework import schemas
from pagework.functions.text import q

# Words of 64 bits in the filter of wanted URLs. It is broadcast: this many pairs of numbers at most,
# whatever the number of URLs.
FILTER_WORDS = 1 << 18
FILTER_BITS = 4  # set for a URL, all in one word
BUCKETS = 200  # of a store, if not told

STORED = f"{schemas.PAGES}, status_code INT, redirected_url STRING, captured_at STRING"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A captured-pages table with its declared schema, so no file is opened to plan a query."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def with_fetch_columns(pages: DataFrame) -> DataFrame:
    """Add the optional ``status_code`` and ``redirected_url`` columns as nulls if missing; a
    redirect to the requested URL itself is no redirect."""
    return pages.withColumns(
        {
            "status_code": _column(pages, "status_code", "int").cast("int"),
            "redirected_url": F.when(
                _column(pages, "redirected_url", "string") != F.col("url"),
                _column(pages, "redirected_url", "string"),
            ),
        }
    )


def latest_captures(pages: DataFrame) -> DataFrame:
    """Page id and ``_at``, the time, of the newest capture per URL; without ``captured_at``, the highest page id.

    Reads no HTML and aggregates before the shuffle, so a URL captured very often is no hot key.
    """
    if "captured_at" not in pages.columns:
        return pages.groupBy("url").agg(F.max("page_id").alias("page_id")).withColumn("_at", F.lit(None).cast("string"))
    newest = F.max(F.struct("captured_at", "page_id"))
    return pages.groupBy("url").agg(newest.alias("_c")).select("url", F.col("_c.page_id").alias("page_id"), F.col("_c.captured_at").cast("string").alias("_at"))


def _word(url: str) -> str:
    return f"pmod(xxhash64({url}), {FILTER_WORDS})"


def _bits(url: str) -> str:
    """The bits of a URL in its word, drawn from a second hash."""
    return " | ".join(f"shiftleft(1L, CAST(shiftright(xxhash64({url}, 1), {6 * k}) & 63 AS INT))" for k in range(FILTER_BITS))


def only_wanted(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """``pages`` without almost all that are not among ``urls``, and with all that are: a Bloom filter of the
    wanted URLs, built by one aggregation and applied where the pages are scanned."""
    words = urls.selectExpr(f"{_word('url')} AS _word", f"{_bits('url')} AS _mask").groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    there = pages.withColumn("_word", F.expr(_word("url"))).join(F.broadcast(words), "_word")
    return there.filter(f"(_mask & ({_bits('url')})) = ({_bits('url')})").drop("_word", "_mask")


@dataclass(frozen=True)
class CaptureStore:
    """The newest capture of every URL, in a table bucketed and sorted by URL."""

    table: str

    def fetch(self, urls: DataFrame) -> DataFrame:
        """See :func:`fetch_pages`. The URLs are dealt to the buckets and hashed there; each bucket's captures
        stream past them where they are stored, so no HTML meets an exchange, however many URLs are asked for."""
        captures = urls.sparkSession.table(self.table).drop("captured_at")
        return urls.hint("shuffle_hash").join(captures, "url", "left")


def write_captures(pages: DataFrame, path: str, buckets: int = BUCKETS, table: str | None = None) -> CaptureStore:
    """Store the newest capture of every URL below ``path``, which all executors reach, as a table of the session's catalog.

    A row per URL is left, so no bucket is hot. A page id may come back for another address or time.
    """
    table = table or f"captures_{uuid.uuid4().hex}"
    dated = with_fetch_columns(pages).withColumn("captured_at", _column(pages, "captured_at", "string").cast("string"))
    newest = latest_captures(pages).withColumnRenamed("_at", "captured_at")
    same = (dated.url == newest.url) & (dated.page_id == newest.page_id) & dated.captured_at.eqNullSafe(newest.captured_at)
    chosen = dated.join(newest, same, "left_semi").selectExpr("page_id", "url", "html", "status_code", "redirected_url", "captured_at")
    # One task writes a bucket, so a bucket is one sorted file.
    chosen.repartition(buckets, "url").write.format("parquet").option("path", path).bucketBy(buckets, "url").sortBy("url").saveAsTable(table)
    return CaptureStore(table)


def open_captures(spark: SparkSession, path: str, buckets: int = BUCKETS, table: str | None = None) -> CaptureStore:
    """A store that :func:`write_captures` wrote in an earlier session, with the same number of buckets."""
    table = table or f"captures_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({STORED}) USING parquet CLUSTERED BY (url) SORTED BY (url) INTO {buckets} BUCKETS LOCATION {q(path)}")
    return CaptureStore(table)


def fetch_pages(urls: DataFrame, pages: DataFrame | CaptureStore) -> DataFrame:
    """Add ``page_id``, ``html``, ``status_code`` and ``redirected_url`` to distinct URLs.

    From a store, no HTML moves at all. From a plain table, a filter of the wanted URLs keeps other pages from
    leaving the scan (nearly all, up to about a million URLs; for more, use a store). The newest capture
    is looked up on narrow rows first; the wide HTML rows then move once, keyed by their page id, and only the
    chosen capture of a page id stays.

    URLs without a capture have no page id; a salt keeps them from meeting in one task. The number of
    partitions is fixed because what follows works hard per row: merging partitions that look small
    before the HTML is joined would leave the extraction to a few tasks.
    """
    if isinstance(pages, CaptureStore):
        return pages.fetch(urls)
    partitions = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64("url"), F.lit(2**31))
    pages = only_wanted(pages, urls.select("url"))
    wanted = (
        urls.join(latest_captures(pages), "url", "left")
        .withColumn("_salt", F.when(F.col("page_id").isNull(), spread).otherwise(F.lit(0)))
        .repartition(partitions, "page_id", "_salt")
    )
    # pmod(x, 1) is always 0, but the optimizer cannot fold it and drop the column from the key.
    bodies = with_fetch_columns(pages).select(
        "page_id", F.pmod("page_id", F.lit(1)).cast("bigint").alias("_salt"), "html", "status_code", "redirected_url",
        F.col("url").alias("_of"), _column(pages, "captured_at", "string").cast("string").alias("_when"),
    )
    found = wanted.join(bodies, ["page_id", "_salt"], "left")
    # A page id may come back for another address or time: only the chosen capture counts.
    chosen = found.filter(F.col("page_id").isNull() | ((F.col("_of") == F.col("url")) & F.col("_when").eqNullSafe(F.col("_at"))))
    return chosen.drop("_salt", "_of", "_when", "_at")
