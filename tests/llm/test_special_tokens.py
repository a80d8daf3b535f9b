"""The registered queries' ids against the untouched tokenizers library, on texts with the string of an added token."""

import collections
import zlib

import numpy as np

import corpus_pipeline
from pagework.llm import queries
from pagework.llm.tokens import Encoder, default_tokenizer

TEXTS = ["plain words, plain words.", "a<|endoftext|>b", "one <|endoftext|> two\nthree <|endoftext|>", "<|endoftext|>", "<|endoftext |>", "plain  <|endoftext|>\n\n", None, ""]


def test_registered_queries(spark, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_tokenizer())
    want = [np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for t in TEXTS]
    assert want[3] == np.array([50256, 2], "<u4").tobytes()
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id LONG, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    crcs = collections.Counter((k, len(w) // 4, zlib.crc32(w)) for k, w in enumerate(want))
    rows = sorted(queries.op10_token_planes(spark, str(tmp_path)).collect())
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == crcs
    assert [r.start for r in rows] == [sum(len(w) for w in want[:k]) // 4 for k in range(len(want))]
    for packed in (queries.op5_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        assert collections.Counter((r.doc_id, r.length, r.ids_crc32) for r in packed.collect()) == crcs


def test_added_tokens_that_are_no_single_words(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    for added in ("two words", "\n ", "x.y"):
        plain = Tokenizer.from_file(default_tokenizer())
        plain.add_tokens([AddedToken(added, normalized=False)])
        path = str(tmp_path / f"{len(added)}.json")
        plain.save(path)
        texts = [f"these are two words\n and {added} or x.y.", "only words, no more"]
        want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert list(Encoder(path, special_as_text=False).encode(texts)) == want
