"""The stages of the pipeline, each on its own input, against brute force: copies, near copies, passages, benchmark
windows, nulls, repeated rows, clashing columns and an empty table."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from pagework.llm.simhash_tiles import keep_one

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, fp STRING, predicted STRING, n_removed STRING, block STRING"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    words = [w for _, t, *_ in docs for w in (t or "").split()[:20]]
    passage = " ".join(rnd.choices(words, k=60))
    odd = [(10**6 + k, f"{' '.join(rnd.choices(words, k=30))} {passage} tail {k}") for k in range(4)]
    odd += [(10**6 + 10, f"{' '.join(rnd.choices(words, k=30))} {benchmark[0]} end"), (10**6 + 11, None), (10**6 + 12, ""), (10**6 + 13, " \t"), (None, passage), (None, passage)]
    odd += [(10**6 + 20, "version one of a text that comes twice"), (10**6 + 20, "another version, quite a different one"), (10**6 + 21, "another version, quite a different one")]
    odd += [(10**6 + 30, "the same row " * 9)] * 3
    return [(*d, "s", "f", "p", "r", "b") for d in docs] + [(i, t, None, "x", len(t or ""), "s", "f", "p", "r", "b") for i, t in odd]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def fingerprint(text):
    w = WORD.findall(lower(text))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=int) if hashes else np.zeros(64, int)
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(hashes))


def after(spark, docs, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert out.columns == docs.columns
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_near_copies(spark, rows, docs):
    named = [r for r in rows if r[0] is not None]
    prints = np.array([fingerprint(r[1]) for r in named], np.uint64)
    part = np.arange(len(named))
    for a in range(len(named)):
        for b in np.flatnonzero(np.bitwise_count(prints ^ prints[a]) <= 3):
            part[part == part[b]] = part[a]
    kept = after(spark, docs, "simhash_near_dedup")
    assert [r for r in kept if r[0] is None] == [r for r in sorted(rows, key=repr) if r[0] is None]
    kept = [r for r in kept if r[0] is not None]
    of = {r: part[i] for i, r in enumerate(named)}
    assert len(kept) == len(set(part)) and {of[r] for r in kept} == set(part)
    assert all(r[0] == min(x[0] for x, p in of.items() if p == of[r]) for r in kept)
    assert sorted(r[1] for r in kept if r[0] == 10**6 + 20) == ["another version, quite a different one", "version one of a text that comes twice"]


def test_one_of_equal_ids_is_chosen_alike(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "x"), (2, "a b c d", "a"), (1, "something else here now", "x")]
    frames = [spark.createDataFrame(random.Random(k).sample(rows, 5), "doc_id LONG, text STRING, source STRING").repartition(3) for k in range(3)]
    kept = [sorted(tuple(r) for r in keep_one(f).collect()) for f in frames]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2 and all(r[0] == 1 for r in kept[0])


def test_passages(spark, rows, docs):
    texts = [WORD.findall(r[1] or "") for r in rows]
    counts = {}
    for w in texts:
        for k in range(len(w) - 34):
            counts[tuple(w[k : k + 35])] = counts.get(tuple(w[k : k + 35]), 0) + 1
    want = []
    for r, w in zip(rows, texts):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 34):
            if counts[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = True
        text = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((r[0], text, *r[2:4], len(text), *r[5:]) if gone.any() else r)
    assert after(spark, docs, "substring_dedup") == sorted(want, key=repr)


def test_benchmark_windows(spark, rows, docs):
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = PLAIN.findall(lower(r.text))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in windows}

    def clean(text):
        w = PLAIN.findall(lower(text))
        return not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    want = [r for r in rows if clean(r[1])]
    assert 0 < len(want) < len(rows) and after(spark, docs, "decontamination") == sorted(want, key=repr)


def test_toxic_and_packed(spark, rows, docs):
    kept = after(spark, docs, "toxicity")
    assert set(kept) <= set(rows) and {r[0] for r in kept} >= {r[0] for r in rows if (r[1] or "").strip() == ""}
    packed = corpus_pipeline.packing(spark, docs, SF).collect()
    assert len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in packed}) == len(packed)
    used = {}
    for r in packed:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in used.values():
        at.sort()
        assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:])) and sum(n for _, n in at) <= 1024
    # Best fit needs at most 17/10 of the least number of sequences, which the tokens bound from below.
    assert len(used) <= 1.7 * -(-sum(r.length for r in packed) // 1024) + 1


def test_empty_table(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
