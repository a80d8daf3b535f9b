"""Stored rule tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagework import schemas

log = logging.getLogger(__name__)

LOGGED = 5  # skipped lines

# A path to prune may stand alone or in a list, so it is read as it is written.
STORED = f"rule_idx INT, {schemas.RULES}, _bad STRING".replace("prune_xpath: ARRAY<STRING>", "prune_xpath: STRING")


def _positions(lines: DataFrame) -> DataFrame:
    """Add ``_pos``, the number of the line in file order: lines of the splits before, and those
    above it in its own. Only a row per split meets in one task."""
    split = ["_file", "_block"]
    ahead = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    before = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_n")).select(*split, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*split).orderBy("_line")) - 1
    return lines.withColumn("_within", within).join(before, split).withColumn("_pos", F.col("_before") + F.col("_within"))


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules stored as JSON lines, with ``line``, their place in the file (from 0).

    A line without ``rule_idx`` has its place as such; rules of the same ``rule_idx`` rank by their
    places. A line that does not fit the schema is logged and skipped; the others load. ``prune_xpath`` may
    be one path or a list of them.
    """
    raw = (
        spark.read.schema(STORED)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .json(path)
    )
    lines = raw.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    bad = raw.filter(F.col("_bad").isNotNull()).select("name", "_bad").limit(LOGGED).collect()
    if bad:
        log.error("site rule lines skipped, among them: %s", [r._bad[:200] for r in bad])
    pruned = F.col("extra_options.prune_xpath")
    paths = F.when(pruned.startswith("["), F.from_json(pruned, "ARRAY<STRING>")).otherwise(F.array(pruned))
    options = F.col("extra_options").withField("prune_xpath", F.when(pruned.isNotNull(), paths))
    placed = _positions(lines).filter(F.col("_bad").isNull())
    columns = ["name", "match_type", "match_pattern", "engine", "css_selector", "extra_options", "priority"]
    return placed.withColumns(
        {"rule_idx": F.coalesce("rule_idx", F.col("_pos").cast("int")), "extra_options": options.cast(schemas.OPTIONS)}
    ).select("rule_idx", *columns, F.col("_pos").alias("line"))


def save_rules(rules: DataFrame, path: str) -> None:
    """Write a rule table in the form :func:`load_rules` reads."""
    rules.select("rule_idx", *[c for c in
                               ("name", "match_type", "match_pattern", "engine", "css_selector",
                                "extra_options", "priority")]).write.json(path)
