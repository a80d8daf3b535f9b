"""The registered queries of the operators for training data: whole tables in, contract columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_pipeline import run
from pagework.llm.chat_format import format_chats, read_loss, read_turns
from pagework.llm.common import table
from pagework.llm.decontaminate import contamination
from pagework.llm.filter_audit import audit_filters
from pagework.llm.fim_frames import fill_in_middle
from pagework.llm.html_consensus import extract_pages
from pagework.llm.ngram_join import jaccard_groups
from pagework.llm.packing import pack
from pagework.llm.quality_rules import judge_quality
from pagework.llm.simhash_tiles import simhash_groups
from pagework.llm.substring_dedup import drop_repeated_windows
from pagework.llm.suffix_dedup import drop_earlier_strings
from pagework.llm.token_planes import read_planes, write_planes
from pagework.llm.tokens import default_tokenizer
from pagework.llm.toxicity import fit_toxicity, held_out, score_toxicity


def op1_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = fit_toxicity(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score_toxicity(docs.select("doc_id", "text"), machine)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    return judge_quality(table(spark, sf_dir, "documents"), labels)[0]


def op3_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op4_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer(), special_as_text=False)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -1L AS conv_id, turn, role, '{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    chats = format_chats(turns.unionByName(extra))
    back = chats.select("conv_id", "valid", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_earlier_strings(table(spark, sf_dir, "documents"))
    digest = F.sha2("kept_bytes", 256).alias("kept_sha256")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


def op10_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_planes(table(spark, sf_dir, "documents"), default_tokenizer(), special_as_text=False)
    return read_planes(spark, path, with_ids=False)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op12_fim_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity_machine, op2_quality_rules, op3_html_consensus, op4_winnowing_decontamination, op5_best_fit_packing, op6_simhash_near_dedup, op7_chat_format, op8_substring_dedup, op9_suffix_array_dedup, op10_token_planes, op11_ngram_join, op12_fim_frames, op13_filter_audit, pipeline)
}
