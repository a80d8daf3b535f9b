"""Which hashes occur in more than one block of documents: a count of hashes over the whole corpus.

Documents are dealt to blocks of a few megabytes. Each block sends its distinct hashes once, sorted
and packed as binary pieces by range of hash, so a hash that a third of all documents hold still
arrives once per block. The range's task counts them and answers each block with one bit per hash.
Twice the hash volume never moves: there are no rows per window and no rows per position.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagework.llm.common import others, pieces, quoted, text_bytes

BLOCK_BYTES = 2 << 20
HOT_BLOCKS = 2000  # a hash in more blocks than that is reported as hot
RANGE_HASHES = 2_000_000  # expected distinct hashes in the task of one range


class Blocks:
    """Documents as ``_block, _id, _text, _rest`` with the sizes that later steps are cut by."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, results: tuple[str, ...] = (),
                 block_bytes: int = BLOCK_BYTES):
        self.total = text_bytes(docs, text_col)
        self.blocks = pieces(self.total, block_bytes)
        self.rest = others(docs, (id_col, text_col, *results))
        rest = F.struct(*(quoted(c) for c in self.rest)) if self.rest else F.lit(None).cast("boolean")
        the_id, text = F.col(quoted(id_col)), F.col(quoted(text_col))
        self.docs = docs.select(
            F.pmod(F.xxhash64(the_id, text), F.lit(self.blocks)).cast("int").alias("_block"),
            the_id.alias("_id"), text.alias("_text"), rest.alias("_rest"),
        )
        self.fields = {f.name: f.dataType for f in self.docs.schema.fields}


def in_order(block: pa.Table) -> pa.Table:
    """The rows of a block in an order that does not depend on how they arrived."""
    return block.sort_by([("_id", "ascending"), ("_text", "ascending")])


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (((hashes >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)).astype(np.int64)


def repeated_hashes(
    blocks: Blocks, hashes_of: Callable[[pa.Table], np.ndarray], expected: int
) -> tuple[DataFrame, int]:
    """Bits of the hashes that occur in two blocks or more: ``_block, range, bits, hot``, and the number of ranges.

    ``hashes_of`` gives the hashes of a block, in any order, repeats included. ``bits`` belong to
    the block's distinct hashes of the range in ascending order; ``hot`` likewise, for hashes in
    more than ``HOT_BLOCKS`` blocks.
    """
    ranges = pieces(expected, RANGE_HASHES)

    def send(block: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"_block": pa.array([], pa.int32()), "range": pa.array([], pa.int32()), "hashes": pa.array([], pa.binary())})
        distinct = np.unique(hashes_of(block))
        number = range_of(distinct, ranges)
        cuts = np.flatnonzero(np.diff(number)) + 1
        parts = np.split(distinct, cuts) if len(distinct) else []
        return pa.table({
            "_block": pa.array([block["_block"][0].as_py()] * len(parts), pa.int32()),
            "range": pa.array(number[np.concatenate(([0], cuts))] if parts else [], pa.int32()),
            "hashes": pa.array([p.tobytes() for p in parts], pa.binary()),
        })

    def count(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in rows["hashes"].to_pylist()]
        everything = np.sort(np.concatenate(parts))
        twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
        hot = np.unique(everything[HOT_BLOCKS:][everything[HOT_BLOCKS:] == everything[: max(0, len(everything) - HOT_BLOCKS)]])
        bits = [[np.packbits(member(p, those)).tobytes() for p in parts] for those in (twice, hot)]
        return pa.table({"_block": rows["_block"], "range": rows["range"],
                         "bits": pa.array(bits[0], pa.binary()), "hot": pa.array(bits[1], pa.binary())})

    sent = blocks.docs.groupBy("_block").applyInArrow(send, "_block int, range int, hashes binary")
    return sent.groupBy("range").applyInArrow(count, "_block int, range int, bits binary, hot binary"), ranges


def member(values: np.ndarray, those: np.ndarray) -> np.ndarray:
    """Which of ``values`` are among ``those``, which are sorted."""
    if not len(those):
        return np.zeros(len(values), bool)
    at = np.searchsorted(those, values)
    at[at == len(those)] = 0
    return those[at] == values


def read_bits(answer: pa.Table, distinct: np.ndarray, ranges: int, column: str = "bits") -> np.ndarray:
    """For each of the block's distinct hashes (ascending): whether another block has it too."""
    number = range_of(distinct, ranges)
    out = np.zeros(len(distinct), bool)
    for r, bits in zip(answer["range"].to_pylist(), answer[column].to_pylist()):
        lo, hi = np.searchsorted(number, (r, r + 1))
        out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo)
    return out
