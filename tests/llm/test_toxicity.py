"""The factorization machine: pairs that tell only together, held-out labels, its sums against the definition."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagework.llm.toxicity import SLOTS, Machine, _slots_of, fit_toxicity, held_out, score_toxicity


def test_a_pair_that_tells_only_together(spark):
    """The label is whether exactly one of two words is there: neither word alone tells anything."""
    random = np.random.default_rng(0)
    rows = []
    for i in range(6000):
        insult, group = (bool(x) for x in random.random(2) < 0.5)
        words = [f"w{k}" for k in random.integers(0, 400, 30)] + ["insult"] * insult + ["group"] * group
        rows.append((i, " ".join(random.permutation(words)), int(insult != group)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, toxic INT").repartition(4)
    machine = fit_toxicity(docs, docs.filter("doc_id < 4000").select("doc_id", "toxic"))
    scored = score_toxicity(docs.filter("doc_id >= 4000"), machine).collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in scored) >= 1900


@pytest.mark.parametrize("sf,least,false", [("sf0.01", 9, 2), ("sf0.1", 108, 4)])
def test_held_out_labels(spark, sf, least, false):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    machine = fit_toxicity(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score_toxicity(docs.join(labels.filter(held_out(F.col("doc_id"))), "doc_id"), machine).collect()
    assert sum(r.predicted for r in scored if r.toxic) >= least and sum(r.predicted for r in scored if not r.toxic) <= false


def test_scores_are_sums_over_pairs(spark):
    random = np.random.default_rng(1)
    machine = Machine(0.3, random.normal(0, 0.2, SLOTS).astype(np.float32), random.normal(0, 0.2, (SLOTS, 3)).astype(np.float32))
    texts = ["", None, "one", "One two, THREE three", "naïve prefixed prefixes 漢字", "a_b c", " ".join(f"word{i}" for i in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    for r in score_toxicity(docs, machine).collect():
        words = {w for w in (texts[r.doc_id] or "").lower().replace(",", " ").replace("_", " ").split()}
        slots = [s for w in words for s in _slots_of(w)]
        logit = machine.bias + sum(float(machine.weights[s]) for s in slots) + sum(float(machine.factors[a] @ machine.factors[b]) for a, b in itertools.combinations(slots, 2))
        assert abs(r.score - 1 / (1 + np.exp(-np.clip(logit, -50, 50)))) < 1e-3


def test_more_different_words_than_are_remembered(spark):
    machine = Machine.blank()
    machine.weights[_slots_of("insult")[0]] = 9.0
    text = " ".join(f"{i}x" for i in range(120_000))
    docs = spark.createDataFrame([(1, text + " insult"), (2, text), (3, "insult"), (4, "x")], "doc_id LONG, text STRING").coalesce(1)
    assert {r.doc_id: r.predicted for r in score_toxicity(docs, machine).collect()} == {1: 1, 2: 0, 3: 1, 4: 0}
