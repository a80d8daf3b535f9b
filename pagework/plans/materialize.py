"""Cutting lineage through a table in the shared folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only local mode may go without that setting; its tables then go below the warehouse, never to a
    temporary folder. Every other master, ``local-cluster`` included, has to name a shared folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/pagework/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    Later steps that need only some columns then read only those, expensive steps before it run
    once however many branches follow, and lost executors do not restart the whole chain.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
