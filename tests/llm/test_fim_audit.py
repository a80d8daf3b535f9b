"""Fill-in-the-middle and the filter audit against brute force on whole small tables and awkward rows."""

import collections
import hashlib
import itertools
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from pagework.llm.filter_audit import Trie, audit_filters, filter_masks, shared
from pagework.llm.fim_frames import draw, fill_in_middle, output, rebuild, store_frames

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id LONG, text STRING, source STRING, n STRING, form STRING, mask STRING, prefix STRING, hot STRING"
PACKER = zstandard.ZstdCompressor(level=1)


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \t\n", words, words, " x é  y\n漢字 ", "a <P> b", "<" * 50 + " <S <M", "w" * 5000 + " tail ", "é" * 3000, "A B # " * 300,
             "long word " * 30_000, "same start " * 400 + "1", "same start " * 400 + "2", "same start " * 400]
    rows = [(i, t, None if i % 4 == 0 else f"s{i % 4}") for i, t in enumerate(texts)] + [(3, words, "s3"), (None, words, "s1"), (None, None, None)]
    return spark.createDataFrame([(*r, "n", "f", "m", "p", "h") for r in rows], SCHEMA).repartition(3)


def fim(key, text):
    units = UNIT.findall(text)
    first, second, c, d = draw("" if key is None else str(key), len(units))
    parts = ["".join(p) for p in (units[:first], units[first:second], units[second:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c >= 50:
        return len(units), "plain", None, None, text
    if d < 80:
        return len(units), "spm", len(parts[0]), len(parts[1]), f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return len(units), "psm", len(parts[0]), len(parts[1]), f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


@pytest.mark.parametrize("size", [7, 1 << 16])
def test_fim(spark, odd, size):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionAll(odd.select(F.col("doc_id") + 10**9, "text"))
    want = collections.Counter((i, *fim(i, t or "")) for i, t in docs.collect())
    rows = fill_in_middle(docs, frame_bytes=size, keep_output=True).collect()
    assert collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows) == want
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    texts = collections.Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs.collect())
    assert collections.Counter((r.doc_id, r.restored_sha256) for r in rows) == texts
    assert all(r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() for r in rows)


def test_fim_columns(spark, odd):
    out = fill_in_middle(odd)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] and out.count() == odd.count()
    assert fill_in_middle(odd.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 8, 100])
def test_frames(size):
    texts = ["a", " a", "a ", " ", "ab cd  ef\n", "é ü\t漢字  x", "  lead", "one", "x" * 40 + " y", "\n" * 20, "a b  c", "<<S <P <M< a<"]
    for text in texts:
        stored, units = store_frames(text.encode(), size, PACKER), UNIT.findall(text)
        assert stored.n == len(units) and stored.chars[-1] == len(text)
        for k in range(len(units) + 1):
            frame, byte, chars = stored.place(k)
            before = b"".join(stored.stream((0, 0), (frame, byte))).decode()
            assert before == "".join(units[:k]) and chars == len(before)
            for form in ("psm", "spm", "plain"):
                cuts = [stored.place(k)[:2], stored.place(len(units))[:2]]
                assert b"".join(rebuild(output(stored, form, cuts), form, PACKER, size)).decode() == text


def masks(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, text, part in rows:
        text = text or ""
        words = WORD.findall(text)
        failed = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                  bool(re.search(r"[#$%&*|]", text)), i is not None and i > least[text]]
        yield part or "", "".join(f for f, x in zip("ABCDE", failed) if x), i


def brute_audit(rows, quality, toxic):
    out = collections.defaultdict(lambda: [0] * 7)
    found = list(masks(rows))
    for part in {p for p, _, _ in found}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [(m, i) for p, m, i in found if p == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                row = out[part, order, step]
                row[:6] = [len(left), len(gone), sum(f in m for m, _ in everything) - len(gone), sum(m == f for m, _ in everything),
                           sum(i in quality for _, i in gone), sum(i in toxic for _, i in gone)]
        for f in "ABCDE":
            where = [k for k in out if k[0] == part and k[1][k[2] - 1] == f]
            for k in where:
                out[k][6] = sum(out[w][1] for w in where)
    return dict(out)


def test_audit(spark, odd):
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    docs = base.unionAll(odd.select("doc_id", "text", "source").withColumn("doc_id", F.col("doc_id") + 10**9))
    labels = spark.read.parquet(f"{SF}/labels.parquet").unionByName(spark.createDataFrame([(10**9 + 4, 1, 1), (10**9 + 4, 0, 0), (None, 1, 1)], "doc_id LONG, quality INT, toxic INT"))
    said = labels.filter("doc_id IS NOT NULL").collect()
    quality, toxic = {r.doc_id for r in said if r.quality == 1}, {r.doc_id for r in said if r.toxic == 1}
    rows = audit_filters(docs, labels).collect()
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(rows) == len(got) and got == brute_audit(docs.collect(), quality, toxic)


@pytest.mark.parametrize("lengths", [(1, 4), (16, 64, 256, 1024, 4096)])
def test_masks(spark, odd, lengths):
    """Small partitions and a text that is too frequent for any: prefixes grow, hot texts are dealt out."""
    copies = spark.range(1000, 1400).select(F.col("id").alias("doc_id"), F.lit("the same text " * 30).alias("text"), F.lit("s").alias("source"))
    docs = odd.select("doc_id", "text", "source").unionAll(copies)
    want = collections.Counter((p, m, i) for p, m, i in masks(docs.collect()))
    rows = filter_masks(docs, partition_bytes=20_000, lengths=lengths).collect()
    assert collections.Counter((r.part, "".join(f for k, f in enumerate("ABCDE") if r.mask >> k & 1), r.id) for r in rows) == want
    assert filter_masks(odd).count() == odd.count()
    assert audit_filters(odd.limit(0), odd.select("doc_id").limit(0).selectExpr("doc_id", "1 quality", "0 toxic")).count() == 0


def test_trie():
    texts = [b"", b"a", b"ab", b"abc" * 100, b"abc" * 100 + b"x", b"abc" * 99 + b"abd", b"b", b"a", b""]
    trie = Trie()
    for row, t in enumerate(texts):
        trie.insert(t, 10 - row, row)
    assert sorted((n.least, n.rows) for n in trie.terminals()) == sorted(
        (min(10 - r for r in rows), rows) for rows in ([r for r, x in enumerate(texts) if x == t] for t in set(texts)))
    for a, b in itertools.product([b"", b"x" * 500, b"x" * 499 + b"y", b"x" * 100 + b"z" * 400, b"y"], repeat=2):
        n = shared(a, b)
        assert a[:n] == b[:n] and (n in (len(a), len(b)) or a[n] != b[n])
