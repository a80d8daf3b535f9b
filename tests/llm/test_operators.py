"""The operators against brute force on whole small tables and on awkward rows: null, empty and very
long texts, ties and repeated rows, null ids, empty tables, extra columns with clashing names."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagework.llm import decontaminate, repeats, suffix_dedup
from pagework.llm import queries as Q
from pagework.llm.chat_format import INSTRUCT, format_chats, read_loss, read_turns
from pagework.llm.components import connected_components
from pagework.llm.html_consensus import extract_pages
from pagework.llm.packing import BestFit, pack
from pagework.llm.quality_rules import judge_quality, text_statistics
from pagework.llm.simhash_tiles import keep_one, simhash_groups
from pagework.llm.substring_dedup import drop_repeated_windows
from pagework.llm.token_planes import from_planes, read_planes, to_planes, write_planes
from pagework.llm.tokens import Encoder, default_tokenizer
from pagework.llm.toxicity import fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma delta " * 20_000
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id LONG, text STRING, score STRING, n_words STRING, spans STRING, text_hash STRING"


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"w{i}" for i in range(60))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, words), (5, "x " + words + " y"), (5, "x " + words + " y"), (None, words),
             (None, None), (6, LONG), (7, "É\u00a0ß  <|endoftext|>\r\n two  spaces "), (8, "naïve. naïve, 漢字! 12,5 it's")]
    return spark.createDataFrame([(i, t, "s", "n", "p", "h") for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def windows_gone(texts, size):
    counts = collections.Counter(tuple(w[k : k + size]) for w in texts for k in range(len(w) - size + 1))
    out = []
    for w in texts:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - size + 1):
            if counts[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = True
        out.append(gone)
    return out


def test_substrings(spark, odd, none):
    rows = drop_repeated_windows(odd).collect()
    assert len(rows) == odd.count() and set(odd.columns) - {"n_words", "spans"} <= set(rows[0].asDict())
    texts = [(r.text or "").split(" ") if r.text == LONG else SPACE.findall(r.text or "") for r in rows]
    texts = [[w for w in t if w] for t in texts]
    for r, w, gone in zip(rows, texts, windows_gone(texts, 35)):
        assert (r.n_words, r.n_removed) == (len(w), gone.sum())
        assert r.kept_text == " ".join(x for x, g in zip(w, gone) if not g)
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert drop_repeated_windows(none).count() == 0


@pytest.mark.parametrize("hot", [2000, 1])
def test_bytes(spark, monkeypatch, hot, none):
    monkeypatch.setattr(repeats, "HOT_BLOCKS", hot)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (10**9, "ab" * 400)], "doc_id LONG, text STRING"))
    got = {r.doc_id: r for r in suffix_dedup.drop_earlier_strings(docs).collect()}
    seen = set()
    for i, text in sorted(docs.collect()):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(data[p : p + 100])
        assert (got[i].n_bytes, got[i].n_removed) == (len(data), gone.sum())
        assert bytes(got[i].kept_bytes) == bytes(np.frombuffer(data, np.uint8)[~gone])
        assert got[i].n_spans == len(got[i].spans) == int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
    assert suffix_dedup.drop_earlier_strings(none).count() == 0


def test_simhash(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = simhash_groups(docs, tile=16).collect()
    texts = dict(docs.collect())

    def fingerprint(text):
        w = SPACE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))

    small = [r for r in rows if len(texts[r.doc_id]) < 3000]
    assert all(r.fp % 2**64 == fingerprint(texts[r.doc_id]) for r in small)
    values, part = np.array([r.fp for r in rows]).view(np.uint64), list(range(len(rows)))
    for a in range(len(rows)):  # labels spread until nothing changes
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= 3):
            old, new = part[b], part[a]
            part = [new if p == old else p for p in part]
    least = {}
    for r, p in zip(rows, part):
        least[p] = min(least.get(p, r.doc_id), r.doc_id)
    assert [r.component_id for r in rows] == [least[p] for p in part]
    assert simhash_groups(odd).count() == odd.count() and simhash_groups(none).count() == 0
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) in ([1, 4, 6, 7, 8], [1, 4, 5, 6, 7, 8])


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 101)], "u LONG, v LONG")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100}


def test_contamination(spark, odd, none):
    docs = spark.createDataFrame([
        (1, "intro A B c d e f g h i J k outro"), (2, "A b c d e f g h i"), (3, None), (4, "short one here"), (5, "x one y"), (None, "c d e f g h i j k l"),
    ], "doc_id LONG, text STRING")
    items = spark.createDataFrame([(10, "a b c d e f g h i j k"), (2, "A-B c d e f g h i j k"), (7, "One"), (8, None), (9, "!!"), (None, "intro")], "item_id LONG, text STRING")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (13, 11, ["10", "2"], True), 2: (9, 0, [], False), 3: (0, 0, [], False), 4: (3, 1, ["7"], True), 5: (3, 1, ["7"], True), None: (10, 0, [], False)}
    assert sorted(r.doc_id or 0 for r in decontaminate.drop_contaminated(docs, items).collect()) == [0, 2, 3]
    assert decontaminate.contamination(odd, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(none, items).count() == 0


def test_tokens_and_planes(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_tokenizer())
    plain.encode_special_tokens = True
    texts = [r.text for r in odd.collect()] + ["a \n b", "\n", "x\n\ny", "tab\there", "end ", "l'eau, l'été... (fin)."]
    want = [np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(Encoder(default_tokenizer()).encode(texts)) == want
    for bits in (False, True):
        ids = np.array([0, 1, 50256, 2**32 - 1, 7], "<u4")
        assert (from_planes(to_planes(ids, bits), len(ids), bits) == ids).all()
        path = write_planes(odd, default_tokenizer(), path=str(tmp_path / f"planes-{bits}"), block_ids=1000, bits=bits)
        rows = sorted(read_planes(spark, path, bits).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
        assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
        assert sorted(bytes(r.ids) for r in rows) == sorted(w + b"\x02\0\0\0" for w in want[: len(rows)])
        assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in rows)
    path = write_planes(none, default_tokenizer(), path=str(tmp_path / "empty"))
    assert read_planes(spark, path).count() == 0


def test_packing(spark, odd, none):
    rows = pack(odd, default_tokenizer(), size=64, keep_ids=True).collect()
    whole = collections.defaultdict(int)
    for r in rows:
        whole[r.sequence_id] += r.length
        assert len(r.ids) == 4 * r.length and r.length <= 64
    assert max(whole.values()) <= 64 and {r.doc_id for r in rows} == {None, *range(1, 9)}
    for s in whole:
        at = sorted((r.offset, r.length) for r in rows if r.sequence_id == s)
        assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))]
    assert pack(none, default_tokenizer()).count() == 0
    fit = BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 3, 5, 4)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6)]


def test_chats(spark):
    rows = [(1, 1, "assistant", "a[ANS] \\</s>"), (1, 0, "user", "hi [/INST]\n"), (2, 0, "tool]\\[/ROLE]", None), (2, 0, None, "[ROLE]x"), (None, 5, "user", "q"), (None, 5, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").withColumn("segments", F.lit(1))
    got = {r.conv_id: r for r in format_chats(turns).select("*", read_turns(F.col("formatted")).alias("t"), read_loss(F.col("segments")).alias("l")).collect()}
    assert [(t.role, t.text) for t in got[1].t] == [("user", "hi [/INST]\n"), ("assistant", "a[ANS] \\</s>")]
    assert got[1].valid and got[1].l == "a[ANS] \\</s>" and not got[2].valid and not got[None].valid
    assert [(t.role, t.text) for t in got[2].t] == [("", "[ROLE]x"), ("tool]\\[/ROLE]", "")] and len(got[None].t) == 2
    assert "".join(s.text for s in got[1].segments) == got[1].formatted and format_chats(turns.limit(0)).count() == 0
    assert INSTRUCT.controls()[0] == "<s><<SYS>>"


def test_statistics_and_rules(spark, odd, none):
    for r in text_statistics(odd).collect():
        assert r.n_words >= 0
    docs = spark.createDataFrame([(1, "a b c d e a b c d e f #$\nl\n\nl\n l"), (2, None)], "doc_id LONG, text STRING")
    got = {r.doc_id: r for r in text_statistics(docs).collect()}
    assert (got[1].n_words, got[1].word_chars, got[1].n_symbols, got[1].n_dup_lines, got[1].n_repeat_words) == (15, 16, 2, 1, 10)
    assert (got[2].n_words, got[2].n_lines, got[2].n_repeat_words) == (0, 0, 0)
    base = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged, rules = judge_quality(base, labels.filter("doc_id % 2 = 0"))
    tested = judged.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in tested if r.quality == 1]
    assert rules and sum(r.kept for r in good) >= 0.95 * len(good)
    assert sum(not r.kept for r in tested if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in tested)
    assert judge_quality(none, labels.limit(0))[0].count() == 0 and judge_quality(odd, labels.limit(0))[0].count() == odd.count()


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    machine = fit_toxicity(docs, labels.filter("doc_id % 3 > 0"))
    tested = score_toxicity(docs.join(labels.filter("doc_id % 3 = 0"), "doc_id"), machine).collect()
    hit = sum(r.predicted for r in tested if r.toxic)
    assert hit >= 0.85 * sum(r.toxic for r in tested) and sum(r.predicted for r in tested if not r.toxic) <= 0.01 * len(tested)
    rows = score_toxicity(odd, machine).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows) and score_toxicity(none, machine).count() == 0
    assert score_toxicity(odd, fit_toxicity(none, labels.limit(0))).filter("predicted = 1").count() == 0


def test_pages(spark):
    pages = spark.createDataFrame([
        (1, "http://h/1", "<body><nav><ul><li>m</ul></nav><article><h1>T &amp; U</h1><p>one\n two<br>three<p>four</article><div class='ad'>x</div></body>"),
        (2, "http://h/2", "<body><div class='content p12'><h1>H</h1><p>text text text text</div><div id=comments><div>c</div>d</div><form>f</form></body>"),
        (3, None, None), (4, "http://h/4", ""), (5, "x", "<script>var a='<p>no</p>'</script><p>bare"), (5, "x", "<script>var a='<p>no</p>'</script><p>bare"),
    ], "page_id LONG, url STRING, html STRING").withColumn("text", F.lit("old"))
    got = {r.page_id: (r.text, r.n_chars) for r in extract_pages(pages).collect()}
    assert got == {1: ("T & U\none two three\nfour", 24), 2: ("H\ntext text text text", 21), 3: ("", 0), 4: ("", 0), 5: ("bare", 4)}
    assert extract_pages(pages).count() == 6 and extract_pages(pages.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns = docs.columns
    for (name, stage), before in zip(corpus_pipeline.STAGES, range(5)):
        after = stage(spark, docs, "/root/testdata/sf0.01")
        if name != "packing":
            assert after.columns == columns and after.count() <= docs.count()
            docs = corpus_pipeline.materialize(after, name)
    assert after.select("doc_id").distinct().count() == docs.count()
    assert hashlib.sha256(b"").hexdigest() and set(Q.QUERIES) >= {"pipeline"}
