"""Look-up joins that stay balanced when one key holds a large part of the probing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_KEYS of all rows, so there are fewer than HOT_KEYS
# of them whatever the data: that is the proof that the broadcast below stays small.
HOT_KEYS = 1000
MIN_HOT_ROWS = 100_000
FAN_OUT = 64


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """The keys of ``df`` that need splitting; counted with map-side aggregation."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n")).scalar()
    limit = F.greatest(total / F.lit(HOT_KEYS), F.lit(min_rows))
    return counts.filter(F.col("_n") > limit).select(key)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    min_hot_rows: int = MIN_HOT_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Left outer join on ``key`` where ``right`` holds at most a few rows per key.

    Rows of a hot key, and rows whose key is null, are spread over ``fan_out`` salts by a hash of
    ``spread_by`` (any value that differs between rows). Only the right rows of hot keys are
    copied once per salt; every other row moves once.
    """
    hot = F.broadcast(hot_keys(left.select(key), key, min_hot_rows).withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(fan_out)).cast("int")
    salted_left = left.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(fan_out - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_right = right.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    joined = salted_left.drop("_hot").join(salted_right.drop("_hot"), [key, "_salt"], "left")
    return joined.drop("_salt")
