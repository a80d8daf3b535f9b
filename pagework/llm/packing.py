"""Bounded-space online best-fit packing of documents into token sequences.

A document's ids, end id included, are one piece, or, if they are longer than a sequence, pieces of
full length behind a shorter first one. Full pieces are sequences of their own. All others arrive
in a random but fixed order at a packer with a fixed number of open sequences. Its open sequences
are stacked by free space, and a bitset has a bit for every free space that occurs: the tightest
fit is the lowest set bit from the piece's length on. If a new sequence is needed and all are open,
the fullest closes first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from pagework.llm.common import give_back, pieces, quoted, small_batches
from pagework.llm.tokens import END_ID, Encoder
from pagework.plans.materialize import materialize

OPEN = 1024
PIECES_PER_TASK = 200_000


class BestFit:
    """Open sequences of ``size`` tokens, ``most`` at once."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open, self.count = size, most, 0, 0
        self.bits = 0  # bit f: some open sequence has f tokens free
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """Sequence number and offset for a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.size, self.count
            self.count += 1
        if free > length:
            self.by_free[free - length].append(number)
            self.bits |= 1 << (free - length)
            self.open += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
    end_id: int = END_ID, keep_ids: bool = False, special_as_text: bool = True,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, with ``ids`` (little-endian bytes) on request."""
    kind = docs.schema[id_col].dataType
    fields = [StructField("doc_id", kind), StructField("piece", IntegerType()), StructField("start", LongType()),
              StructField("length", LongType()), StructField("ids_crc32", LongType())]
    schema = StructType(fields + [StructField("ids", BinaryType())] * keep_ids)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder = Encoder.of(tokenizer, special_as_text)
        for batch in batches:
            row, numbers, starts, lengths, crcs, parts = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                at, number = 0, 0
                while at < total:
                    length = (total - at) % size or size
                    part = ids[4 * at : 4 * (at + length)]
                    row.append(i)
                    numbers.append(number)
                    starts.append(at)
                    lengths.append(length)
                    crcs.append(zlib.crc32(part))
                    if keep_ids:
                        parts.append(part)
                    at, number = at + length, number + 1
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(numbers, pa.int32()),
                       pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
            if keep_ids:
                columns.append(pa.array(parts, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(quoted(id_col)), F.col(quoted(text_col))).mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
    open_sequences: int = OPEN, pieces_per_task: int = PIECES_PER_TASK, keep_ids: bool = False,
    special_as_text: bool = True,
) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``; sequences are gapless from 0.

    Null and empty texts are their end id alone. Repeated rows and null ids are packed as rows of
    their own. An empty table gives no rows; columns beside the two are ignored. Pieces that tie for
    a place are told apart by id, start and content, and equal ones are exchangeable. The pieces are
    written once, so a packer that runs again gets the same pieces in the same order. Strings of the
    tokenizer's special tokens are ordinary text, or one id with ``special_as_text`` off.
    """
    with small_batches(docs.sparkSession):
        cut = materialize(token_pieces(docs, tokenizer, id_col, text_col, size, keep_ids=keep_ids, special_as_text=special_as_text), "pieces")
    tasks = pieces(cut.count(), pieces_per_task)
    mixed = F.xxhash64("doc_id", "start", "ids_crc32")
    arriving = (
        cut.withColumn("_at", mixed)
        .repartition(tasks, "_at")
        .sortWithinPartitions("_at", "doc_id", "start", "length", "ids_crc32")
        .drop("_at")
    )
    schema = StructType([*cut.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        packer = BestFit(size, open_sequences)
        for batch in batches:
            placed = [packer.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + n for n, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())],
                names=schema.names,
            )

    return arriving.mapInArrow(run, schema)
