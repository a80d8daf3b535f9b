"""Partition counts for inputs that arrive in too few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame

# What follows works hard per row: some 10 ms for a page whose text is extracted in three forms.
ROWS = 2000


def spread(df: DataFrame, key: str, rows: int = ROWS) -> DataFrame:
    """Hash-partition ``df`` on a unique key when it has fewer partitions than there are cores, or fewer
    than one for so many ``rows``.

    A split of a file is bounded in bytes only, so its rows, and the longest task, would grow with the input
    until all splits are full. Parquet counts rows without reading any.
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, key)
