"""Stored rules in versions, for queries that run on while rules are edited."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagework.sources.rule_files import load_rules, save_rules

_LOG = "version LONG, folder STRING"


@dataclass(frozen=True)
class RuleVersions:
    """Rule tables below ``path``, which all executors reach, and a log that names the finished ones.

    A version counts from the moment its log row is committed, after its rules are wholly written, so a reader
    finds either the old rules or the new ones. Versions are never changed; the last one in the log is current.
    """

    path: str

    @classmethod
    def create(cls, rules: DataFrame, path: str) -> "RuleVersions":
        """A new store with ``rules`` as version 1."""
        store = cls(path)
        store._add(rules, 1)
        return store

    def _add(self, rules: DataFrame, version: int) -> int:
        folder = f"version-{version}-{uuid.uuid4().hex}"
        save_rules(rules, f"{self.path}/{folder}")
        row = rules.sparkSession.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder"))
        row.write.mode("append").json(f"{self.path}/log")
        return version

    def publish(self, rules: DataFrame) -> int:
        """Make ``rules`` the current version; gives its number. Of two that are published at once the larger folder name counts."""
        return self._add(rules, self.current(rules.sparkSession) + 1)

    def _log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_LOG).json(f"{self.path}/log")

    def current(self, spark: SparkSession) -> int:
        return self._log(spark).agg(F.max("version")).first()[0]

    def load(self, spark: SparkSession, version: int) -> DataFrame:
        folder = self._log(spark).filter(F.col("version") == version).agg(F.max("folder")).first()[0]
        if folder is None:
            raise ValueError(f"no version {version} of the rules in {self.path}")
        return load_rules(spark, f"{self.path}/{folder}")

    def version_of(self, spark: SparkSession, batch: int, checkpoint: str) -> int:
        """The version that a batch of a stream works with: the current one when it is first asked for, and the
        same ever after, also when the batch is repeated by a query that was started again."""
        path = f"{checkpoint}/rule_versions"
        asked = spark.range(1).select(F.lit(batch).cast("long").alias("batch"), F.lit(self.current(spark)).cast("long").alias("version"))
        # An empty part makes the table readable before its first row is there.
        asked.limit(0).write.mode("append").json(path)
        known = spark.read.schema("batch LONG, version LONG").json(path)
        told = known.filter(F.col("batch") == batch).agg(F.min("version")).first()[0]
        if told is None:
            asked.write.mode("append").json(path)
            told = known.sparkSession.read.schema("batch LONG, version LONG").json(path).filter(F.col("batch") == batch).agg(F.min("version")).first()[0]
        return told
