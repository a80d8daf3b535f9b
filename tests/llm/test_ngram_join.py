"""The Jaccard join against brute force over all pairs, and its rounds and filters on groups that are hard for them."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from pagework.llm import ngram_join
from pagework.llm.ngram_join import _open_pairs, gram_hashes, jaccard_groups

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id LONG, text STRING, class STRING, key STRING, n_shingles STRING, component_id STRING"


def grams(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """``n, component`` of each row, by comparing all pairs."""
    sets, part = [grams(t) for _, t in rows], list(range(len(rows)))
    by_gram = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by_gram[g].append(i)
    for i, s in enumerate(sets):
        common = collections.Counter(j for g in s for j in by_gram[g] if j > i)
        for j, k in common.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k) and part[i] != part[j]:
                old, new = part[j], part[i]
                part = [new if p == old else p for p in part]
    least = {}
    for (i, _), p in zip(rows, part):
        if i is not None:
            least[p] = min(least.get(p, i), i)
    return collections.Counter((i, len(s), least.get(p)) for (i, _), s, p in zip(rows, sets, part))


def joined(docs, **options):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(docs, **options).collect())


@pytest.fixture(scope="module")
def odd(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, " ".join(words)), (5, " ".join(words).upper()), (5, " ".join(words).upper()), (None, " ".join(words)),
             (None, None), (6, "alpha beta gamma delta " * 20_000), (7, "Alpha  beta x"), (8, "alpha beta x"), (9, "one"), (10, "one two"), (11, "é " * 9),
             (12, "É " * 9), (5, "another text with this id here"), (13, "another text with this id here"), (None, "only null ids"), (None, "only null ids")]
    return spark.createDataFrame([(i, t, "c", "k", "n", "p") for i, t in texts], SCHEMA).repartition(3)


def test_awkward_rows(spark, odd):
    assert joined(odd, block_bytes=500, range_grams=100) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert jaccard_groups(odd).columns == ["doc_id", "n_shingles", "component_id"] and jaccard_groups(odd.limit(0)).count() == 0


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    assert joined(docs) == want == joined(docs, block_bytes=50_000, range_grams=5000)


@pytest.mark.parametrize("seed", range(3))
def test_chains(spark, monkeypatch, seed):
    """Sets around the bar: chains whose ends are far apart, a passage that many share, groups that leaders do not
    connect; with few leaders the second round has most of the links to find."""
    monkeypatch.setattr(ngram_join, "LEADERS", seed)
    random.seed(seed)
    common = [f"c{i}" for i in range(30)]
    rows = []
    for chain in range(6):
        words = [f"{chain}-{i}" for i in range(random.choice((12, 40, 90)))]
        for step in range(25):
            rows.append((len(rows), " ".join(words + (common if chain % 3 == 0 else []))))
            at = random.randrange(len(words))
            words = words[:at] + [f"{chain}-{step}-n"] * random.choice((0, 1, 1, 2)) + words[at + random.choice((0, 1)) :]
    rows += [(len(rows) + k, " ".join(common + [f"own{k}-{i}" for i in range(random.choice((1, 3, 5, 8)))])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    assert joined(docs) == brute(rows)


@pytest.mark.parametrize("edits", [1, 2])
def test_a_hot_group_makes_few_pairs(spark, monkeypatch, edits):
    """300 near copies of one text: links to drawn members connect them, no pair is left open. With two edits each
    a pair of members is seldom similar enough, but every member has several partners."""
    words = [f"w{i}" for i in range(160)]
    random.seed(edits)
    texts = []
    for k in range(300):
        text = list(words)
        for i in range(edits):
            text[random.randrange(160)] = f"new{k}-{i}"
        texts.append((k, " ".join(text)))
    docs = spark.createDataFrame(texts, "doc_id LONG, text STRING")
    assert edits == 1 or 0.02 < sum(5 * len(grams(a) & grams(b)) >= 4 * len(grams(a) | grams(b)) for (_, a), (_, b) in zip(texts, texts[1:] + texts[:1])) / 300 < 0.95
    left = []
    monkeypatch.setattr(ngram_join, "_open_pairs", lambda *a: left.append(_open_pairs(*a)) or left[0])
    assert {r.component_id for r in jaccard_groups(docs).collect()} == {0} and left[0].count() == 0


def test_grams():
    for text in ("a b c d e f a b c d e", "a b", "", None, "A B c D e", "x " * 50):
        assert len(gram_hashes(text)) == len(grams(text))
    assert (gram_hashes("A b c d e") == gram_hashes("a B C D E")).all() and gram_hashes("a b") != gram_hashes("b a")
