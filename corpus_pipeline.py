"""A corpus through five stages: toxicity, near duplicates, repeated passages, benchmarks, packing.

``run(spark, sf_dir)`` applies the stages to ``documents``. Every stage but the last gives back the
columns of documents, and its result is written as Parquet in the shared folder and read again, so
a lost executor never sets a job back by more than a stage.

Null, empty and wordless texts pass all stages but the second, where they are copies of one another; rows without
an id all pass it. Rows that are alike in every column are one document there and several elsewhere. Columns
beside the own ones keep their values, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagework.llm.common import table
from pagework.llm.decontaminate import drop_contaminated
from pagework.llm.packing import pack
from pagework.llm.simhash_tiles import keep_one
from pagework.llm.substring_dedup import drop_repeated_windows
from pagework.llm.tokens import default_tokenizer
from pagework.llm.toxicity import fit_toxicity, held_out, score_toxicity
from pagework.plans.materialize import materialize


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
OWN = ("doc_id", "text", "n_chars")


def keeps_columns(stage: Stage) -> Stage:
    """The stage with all other columns, whatever their names, set apart and back in their places."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rest = [c for c in docs.columns if c not in OWN]
        apart = docs.select(*OWN, F.struct(*rest).alias("_rest")) if rest else docs
        out = stage(spark, apart, sf_dir)
        return out.select(*(F.col("_rest")[c].alias(c) if c in rest else F.col(c) for c in docs.columns))

    return run


@keeps_columns
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on the labelled ones, does not call toxic."""
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.filter("predicted = 0").select(*docs.columns)


@keeps_columns
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies; see :func:`keep_one`."""
    return keep_one(docs)


@keeps_columns
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their words in repeated windows; a text without such words stays as it is."""
    cut = drop_repeated_windows(docs)
    removed = F.col("n_removed") > 0
    changed = {"n_chars": F.when(removed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
               "text": F.when(removed, F.col("kept_text")).otherwise(F.col("text"))}
    return cut.withColumns(changed).select(*docs.columns)


@keeps_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed into sequences."""
    return pack(docs, default_tokenizer(), special_as_text=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The trained machine, the linking by steps and the packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
