"""Token ids in plane files: fixed-size id blocks, transposed to byte or bit planes, each compressed.

A file is a run of blocks. A block holds up to ``block_ids`` unsigned 32-bit ids; its planes stand
one behind the other, each a zstandard frame. Planes above the highest one in use are left out. The
chunk index is a Parquet table with a row per block: file, place and plane lengths, the number of
ids, and the documents that end in it with their lengths. Files carry a name of their own for each
attempt, and Spark commits index rows of one attempt per task only, so a task that is lost or run
twice leaves nothing that a reader sees.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, DataType, LongType, StringType, StructField, StructType

from pagework.llm.common import give_back, pieces, quoted, small_batches, text_bytes
from pagework.llm.tokens import END_ID, Encoder
from pagework.plans.materialize import new_path

BLOCK_IDS = 1 << 16
SHARD_BYTES = 32 << 20  # of text; a worker learns the words of near documents once in a shard


def _index(id_type: DataType) -> StructType:
    """A row per block; the documents are those whose last id is in it."""
    kinds = {"shard": LongType(), "block": LongType(), "file": StringType(), "first_byte": LongType(),
             "plane_bytes": ArrayType(LongType()), "n_ids": LongType(), "doc_lengths": ArrayType(LongType()),
             "doc_ids": ArrayType(id_type)}
    return StructType([StructField(n, k) for n, k in kinds.items()])


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first, up to the highest in use."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if bits:
        table = np.unpackbits(raw, axis=1, bitorder="little")[:, :top]
        return [np.packbits(p, bitorder="little").tobytes() for p in table.T]
    return [np.ascontiguousarray(p).tobytes() for p in raw[:, : -(-top // 8)].T]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The ids again."""
    if bits:
        table = np.zeros((n, 32), np.uint8)
        for i, p in enumerate(planes):
            table[:, i] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
        return np.packbits(table, axis=1, bitorder="little").reshape(-1).view("<u4")
    raw = np.zeros((n, 4), np.uint8)
    for i, p in enumerate(planes):
        raw[:, i] = np.frombuffer(p, np.uint8)
    return raw.reshape(-1).view("<u4")


def _qualified(spark: SparkSession, path: str) -> str:
    """The URI that Spark itself takes a path for: one without a scheme lies on Hadoop's default file system."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = there.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(there).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _store(path: str):
    """File system and path of a URI, for workers: local, Hadoop or object stores alike."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_planes(
    docs: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, block_ids: int = BLOCK_IDS, bits: bool = False, level: int = 1,
    special_as_text: bool = True,
) -> str:
    """Write all ids in ascending order of ``id_col``, each document followed by ``end_id``; gives the path.

    Null ids come first, rows of the same id in the order of their texts. Null and empty texts are
    their end id alone. An empty table gives an index without rows. Other columns are ignored.
    Strings of the tokenizer's special tokens are ordinary text, or one id with ``special_as_text`` off.
    """
    spark = docs.sparkSession
    path = _qualified(spark, path or new_path(spark, "planes"))
    narrow = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    shards = pieces(text_bytes(narrow, "text"), SHARD_BYTES)
    # By range, then sorted: shard numbers ascend with the ids, and rows of one id stay together.
    placed = narrow.repartitionByRange(shards, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    end = end_id.to_bytes(4, "little")
    schema = _index(docs.schema[id_col].dataType)
    arrow = to_arrow_schema(schema)
    store, top = _store(path)
    store.create_dir(top + "/files", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder, packer = Encoder.of(tokenizer, special_as_text), zstandard.ZstdCompressor(level=level)
        shard, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.planes"
        files, folder = _store(path)
        out, at, rows, pending, held = None, 0, [], [], 0
        ends: list[tuple[int, object]] = []  # documents that end in the block: length, id

        def flush(data: bytes) -> None:
            nonlocal at, ends
            ids = np.frombuffer(data, "<u4")
            frames = [packer.compress(p) for p in to_planes(ids, bits)]
            for f in frames:
                out.write(f)
            rows.append((shard, len(rows), name, at, [len(f) for f in frames], len(ids),
                         [n for n, _ in ends], [key for _, key in ends]))
            at, ends = at + sum(map(len, frames)), []

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                out = out or files.open_output_stream(f"{folder}/files/{name}")
                ids += end
                length = len(ids) // 4
                while held + len(ids) // 4 >= block_ids:
                    cut = 4 * (block_ids - held)
                    pending.append(ids[:cut])
                    ids = ids[cut:]
                    if not ids:
                        ends.append((length, key))
                    flush(b"".join(pending))
                    pending, held = [], 0
                if ids:
                    pending.append(ids)
                    held += len(ids) // 4
                    ends.append((length, key))
        if out:
            if held:
                flush(b"".join(pending))
            out.close()
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    with small_batches(spark):
        placed.mapInArrow(run, schema).write.parquet(path + "/index")
    return path


def read_planes(spark: SparkSession, path: str, bits: bool = False, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` (little-endian bytes) of every document, from the files."""
    path = _qualified(spark, path)
    index = spark.read.parquet(path + "/index")
    totals = index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row per file: the running sum of these is small.
    firsts = totals.select(
        "shard", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))).alias("first")
    )
    files = index.groupBy("shard").agg(
        F.array_sort(F.collect_list(F.struct("block", "file", "first_byte", "plane_bytes", "n_ids", "doc_lengths", "doc_ids"))).alias("blocks")
    ).join(firsts, "shard").select("shard", "blocks", F.coalesce("first", F.lit(0)).alias("first"))
    doc_type = index.schema["doc_ids"].dataType.elementType
    schema = StructType([StructField("doc_id", doc_type), *(StructField(n, LongType()) for n in ("start", "n_tokens", "ids_crc32")),
                         *[StructField("ids", BinaryType())] * with_ids])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for blocks, start in zip(batch.column("blocks"), batch.column("first").to_pylist()):
                keys, starts, lengths, crcs, contents, rest = [], [], [], [], [], b""
                source = None
                for block in blocks:
                    b = block.as_py()
                    source = source or store.open_input_file(f"{folder}/files/{b['file']}")
                    source.seek(b["first_byte"])
                    planes = [unpack.decompress(source.read(n)) for n in b["plane_bytes"]]
                    data, at = rest + from_planes(planes, b["n_ids"], bits).tobytes(), 0
                    for n, key in zip(b["doc_lengths"], b["doc_ids"]):
                        ids = data[at : at + 4 * n]
                        keys.append(key)
                        starts.append(start)
                        lengths.append(n)
                        crcs.append(zlib.crc32(ids))
                        if with_ids:
                            contents.append(ids)
                        start, at = start + n, at + 4 * n
                    rest = data[at:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, to_arrow_type(doc_type)), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(crcs, pa.int64()), *[pa.array(contents, pa.binary())] * with_ids], names=schema.names)

    return files.mapInArrow(run, schema)
