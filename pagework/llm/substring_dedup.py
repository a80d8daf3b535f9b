"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

A word's value is a polynomial of its bytes, mixed; a window's hash is the polynomial of its words'
values, both modulo 2 ** 64 from running sums, so a whole block of documents is hashed in a few
numpy passes. Windows that occur twice anywhere, whether in one document or in several, merge into
maximal intervals of words to remove. Equal windows always have equal hashes; different windows
share one with a chance of 2 ** -64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from pagework.llm.repeats import Blocks, in_order, read_bits, repeated_hashes

BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd, so they have inverses
RESULTS = ("n_words", "n_removed", "spans", "kept_text")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (shift and multiply rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """The words of a block of texts: byte bounds, values, and the number of words of each text."""

    def __init__(self, texts: list[str | None]):
        encoded = [(t or "").encode() for t in texts]
        self.data = b"\n".join([*encoded, b""])
        raw = np.frombuffer(self.data, np.uint8)
        inside = np.concatenate(([False], ~_SPACE[raw], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        n = len(raw) + 1
        sums = np.zeros(n, np.uint64)
        np.cumsum(BYTE_VALUES[raw] * powers(BYTE_BASE, n)[:-1], out=sums[1:])
        back = powers(pow(BYTE_BASE, -1, 1 << 64), n)
        self.values = mix((sums[self.end] - sums[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64))
        # First word of each text, and one past the last.
        bounds = np.cumsum([0, *(len(e) + 1 for e in encoded)])
        self.first = np.searchsorted(self.start, bounds)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``size`` words that lies within one text."""
        n = len(self.values)
        if n < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values * powers(WORD_BASE, n), out=sums[1:])
        back = powers(pow(WORD_BASE, -1, 1 << 64), n)
        hashes = mix((sums[size:] - sums[:-size]) * back[: n - size + 1])
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.flatnonzero(text[: n - size + 1] == text[size - 1 :])
        return at, hashes[at]


def covered(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n positions lie in [p, p + size) for a p of ``at``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return np.cumsum(step[:n]) > 0


def runs(mask: np.ndarray) -> np.ndarray:
    """Maximal runs of true as rows (start, end)."""
    padded = np.concatenate(([False], mask, [False]))
    return np.flatnonzero(padded[1:] != padded[:-1]).reshape(-1, 2)


def drop_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``spans`` (array of [first, end) word numbers, maximal)
    and ``kept_text`` (the other words, joined by one space); input columns of these names go.

    A word is a run without ASCII white space. Removed is every word covered by a window of
    ``window`` words whose sequence also starts anywhere else, the same text included, first
    occurrences too. Null and empty texts have no words and a kept_text of "". Repeated rows repeat
    each other's windows. Rows come out as often as they came in, null ids included; an empty table
    gives none.
    """
    blocks = Blocks(docs, id_col, text_col, RESULTS)

    def hashes_of(block: pa.Table) -> np.ndarray:
        return Words(block["_text"].to_pylist()).windows(window)[1]

    answers, ranges = repeated_hashes(blocks, hashes_of, blocks.total // 6)

    def cut(block: pa.Table, answer: pa.Table) -> pa.Table:
        block = in_order(block)
        words = Words(block["_text"].to_pylist())
        at, hashes = words.windows(window)
        distinct, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
        again = read_bits(answer, distinct, ranges) | (times > 1)
        gone = covered(at[again[which]], window, len(words.values)) if len(at) else np.zeros(len(words.values), bool)
        removed, spans, kept = [], [], []
        for lo, hi in zip(words.first[:-1], words.first[1:]):
            mask = gone[lo:hi]
            removed.append(int(mask.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in runs(mask)])
            stay = np.flatnonzero(~mask) + lo
            kept.append(b" ".join([words.data[s:e] for s, e in zip(words.start[stay].tolist(), words.end[stay].tolist())]).decode())
        return pa.table({
            "_id": block["_id"], "_text": block["_text"], "_rest": block["_rest"],
            "n_words": pa.array(np.diff(words.first), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept_text": pa.array(kept, pa.string()),
        })

    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([
        *(StructField(n, blocks.fields[n]) for n in ("_id", "_text", "_rest")),
        StructField("n_words", LongType()), StructField("n_removed", LongType()),
        StructField("spans", ArrayType(span)), StructField("kept_text", StringType()),
    ])
    out = blocks.docs.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(cut, schema)
    return unpack(out, blocks, docs, id_col, text_col, RESULTS)


def unpack(out: DataFrame, blocks: Blocks, docs: DataFrame, id_col: str, text_col: str, results: tuple[str, ...]) -> DataFrame:
    """The carried columns back in the order of ``docs``, then the results."""
    from pyspark.sql import functions as F

    columns = []
    for c in docs.columns:
        if c == id_col:
            columns.append(F.col("_id").alias(c))
        elif c == text_col:
            columns.append(F.col("_text").alias(c))
        elif c in blocks.rest:
            columns.append(F.col("_rest")[c].alias(c))
    return out.select(*columns, *results)
