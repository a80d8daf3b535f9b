"""Fill-in-the-middle over seekable compressed frames.

A text is stored as independent zstandard frames of at most ``frame_bytes`` bytes. With each frame
stand the running counts of units and code points at its end, so the frame that holds a cut is found
by its count and only that frame is decompressed to place it. The output and the text rebuilt from
it are streamed frame by frame in their own order: no step holds a whole text but the one that stores it.

A unit is white space with the word behind it, or the white space at the end of a text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from pagework.llm.common import quoted
from pagework.plans.materialize import materialize

FRAME_BYTES = 1 << 16
SPACE = b" \t\n\v\f\r"
P, S, M = b"<P>", b"<S>", b"<M>"
SEED = 42
PERCENT_FIM, PERCENT_SPM = 50, 80
# The order of the output: marks and, by number, the parts prefix, suffix and middle behind them.
ORDERS = {"psm": ((P, 0), (S, 2), (M, 1)), "spm": ((S, 2), (P, 0), (M, 1))}

FRAME = StructType([StructField("units", LongType()), StructField("chars", LongType()), StructField("data", BinaryType())])


def n_chars(data: bytes) -> int:
    """Code points of UTF-8 bytes, which may begin inside one."""
    return len(data) if data.isascii() else int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def cut_frames(data: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """The pieces of a text, cut between code points, and the units that end in each.

    A word ends where white space or the end of the text follows, so a word that goes on in the
    next piece ends there; the white space at the end of a text is a unit of the last piece.
    """
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        piece = data[at:end]
        units = len(piece.split())
        if end < len(data):
            units -= piece[-1] not in SPACE and data[end] not in SPACE
        else:
            units += piece[-1] in SPACE
        # A piece that begins with white space may owe the end of the word before it to the piece before.
        yield piece, units
        at = end


@dataclass
class Frames:
    """A stored text: compressed frames with running counts at the end of each."""

    units: list[int]
    chars: list[int]
    data: list[bytes]

    def __post_init__(self) -> None:
        self._unpack = zstandard.ZstdDecompressor()
        self._held: dict[int, bytes] = {}  # the frames of the cuts

    @property
    def n(self) -> int:
        return self.units[-1] if self.units else 0

    def frame(self, k: int) -> bytes:
        return self._held.get(k) or self._unpack.decompress(self.data[k])

    def place(self, unit: int) -> tuple[int, int, int]:
        """Where the first ``unit`` units end: frame, byte in it, code points before it in the text."""
        if unit == 0:
            return 0, 0, 0
        k = bisect_left(self.units, unit)
        piece = self._held.setdefault(k, self.frame(k))
        ends = unit - (self.units[k - 1] if k else 0)  # the cut is where this many units have ended here
        parts = piece.split(None, ends)
        # A rest without words is the unit of white space at the end, or belongs to the next unit.
        if len(parts) > ends:
            at = len(piece[: len(piece) - len(parts[ends])].rstrip(SPACE))
        elif len(parts) == ends:
            at = len(piece.rstrip(SPACE))
        else:
            at = len(piece)
        return k, at, (self.chars[k - 1] if k else 0) + n_chars(piece[:at])

    def stream(self, begin: tuple[int, int], end: tuple[int, int] | None) -> Iterator[bytes]:
        """The bytes between two places, a frame at a time."""
        last = end[0] if end else len(self.data) - 1
        for k in range(begin[0], last + 1):
            piece = self.frame(k) if k < len(self.data) else b""
            yield piece[begin[1] if k == begin[0] else 0 : end[1] if end and k == last else len(piece)]


def store_frames(data: bytes, size: int, packer: zstandard.ZstdCompressor) -> Frames:
    units, chars, frames = [], [], []
    for piece, n in cut_frames(data, size):
        units.append(n + (units[-1] if units else 0))
        chars.append(n_chars(piece) + (chars[-1] if chars else 0))
        frames.append(packer.compress(piece))
    return Frames(units, chars, frames)


def draw(key: str, n: int, seed: int = SEED) -> tuple[int, int, int, int]:
    """First and second cut in units, and the two numbers that choose the form."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    return *sorted((h1 % (n + 1), h2 % (n + 1))), h3 % 100, h4 % 100


def output(text: Frames, form: str, cuts: list[tuple[int, int]]) -> Iterator[bytes]:
    """The transformed text, a piece at a time."""
    if form == "plain":
        yield from text.stream((0, 0), None)
        return
    bounds = [(0, 0), *cuts, None]
    for mark, part in ORDERS[form]:
        yield mark
        yield from text.stream(bounds[part], bounds[part + 1])


class Spool:
    """Bytes kept as compressed frames until their turn."""

    def __init__(self, packer: zstandard.ZstdCompressor, size: int):
        self.packer, self.size, self.packed, self.open, self.n = packer, size, [], [], 0

    def add(self, piece: bytes) -> None:
        self.open.append(piece)
        self.n += len(piece)
        if self.n >= self.size:
            self.packed.append(self.packer.compress(b"".join(self.open)))
            self.open, self.n = [], 0

    def __iter__(self) -> Iterator[bytes]:
        unpack = zstandard.ZstdDecompressor()
        yield from map(unpack.decompress, self.packed)
        yield from self.open


def rebuild(pieces: Iterable[bytes], form: str, packer: zstandard.ZstdCompressor, size: int = FRAME_BYTES) -> Iterator[bytes]:
    """The text, a piece at a time, from its output and form alone.

    The marks are found in the stream, also where two pieces meet. No part of a transformed text
    holds a mark, and none can arise where parts and marks meet, since only marks begin with "<".
    """
    if form == "plain":
        yield from pieces
        return
    parts = [Spool(packer, size) for _ in range(3)]
    marks, to, rest = list(ORDERS[form]), None, b""
    for piece in pieces:
        rest += piece
        while marks and (at := rest.find(marks[0][0])) >= 0:
            if to is not None:
                parts[to].add(rest[:at])
            mark, to = marks.pop(0)
            rest = rest[at + len(mark) :]
        keep = 2 if marks else 0  # bytes that may begin a mark
        if to is not None and len(rest) > keep:
            parts[to].add(rest[: len(rest) - keep])
            rest = rest[len(rest) - keep :]
    parts[to].add(rest)
    for part in parts:
        yield from part


def _digest(pieces: Iterable[bytes]) -> str:
    sha = hashlib.sha256()
    for p in pieces:
        sha.update(p)
    return sha.hexdigest()


def frame_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES, level: int = 1) -> DataFrame:
    """``id_col, marked, frames``: the stored texts; ``marked`` says that a text holds one of the marks."""
    kind = docs.schema[id_col].dataType
    schema = StructType([StructField(id_col, kind), StructField("marked", IntegerType()), StructField("frames", ArrayType(FRAME))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            marked, sizes, units, chars, data = [], [0], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or b""
                marked.append(int(P in text or S in text or M in text))
                stored = store_frames(text, frame_bytes, packer)
                units += stored.units
                chars += stored.chars
                data += stored.data
                sizes.append(len(data))
            frames = pa.StructArray.from_arrays([pa.array(units, pa.int64()), pa.array(chars, pa.int64()), pa.array(data, pa.binary())], ["units", "chars", "data"])
            columns = [batch.column(0), pa.array(marked, pa.int32()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), frames)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(quoted(id_col)), F.col(quoted(text_col)).cast("binary").alias("_text")).mapInArrow(run, schema)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, percent_fim: int = PERCENT_FIM,
    percent_spm: int = PERCENT_SPM, frame_bytes: int = FRAME_BYTES, keep_output: bool = False,
) -> DataFrame:
    """One row per row: ``id_col, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``.

    ``keep_output`` adds ``output``, the transformed text itself. Cuts and form come from a hash of
    the id, so repeated rows get the same ones. A null text is empty, and empty texts and texts that
    hold a mark stay plain; a null id is drawn for as the empty string. Long texts are streamed by
    frames. An empty table gives no rows. Columns beside the two are ignored, whatever their names.
    """
    stored = materialize(frame_table(docs, id_col, text_col, frame_bytes), "frames")
    kinds = {"n": LongType(), "form": StringType(), "prefix_chars": LongType(), "middle_chars": LongType(),
             "output_sha256": StringType(), "restored_sha256": StringType()} | ({"output": StringType()} if keep_output else {})
    schema = StructType([stored.schema[id_col], *(StructField(k, v) for k, v in kinds.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            keys = batch.column(0).to_pylist()
            lists = batch.column(2)
            inner = lists.flatten()
            units, chars, data = (inner.field(f).to_pylist() for f in ("units", "chars", "data"))
            sizes, at = lists.value_lengths().to_pylist(), 0
            for key, marked, size in zip(keys, batch.column(1).to_pylist(), sizes):
                text = Frames(units[at : at + size], chars[at : at + size], data[at : at + size])
                at += size
                first, second, fim, spm = draw("" if key is None else str(key), text.n, seed)
                plain = marked or not size or fim >= percent_fim
                form = "plain" if plain else "spm" if spm < percent_spm else "psm"
                places = [] if plain else [text.place(first), text.place(second)]
                cuts = [(k, byte) for k, byte, _ in places]
                lengths = (None, None) if plain else (places[0][2], places[1][2] - places[0][2])
                whole = (b"".join(output(text, form, cuts)).decode(),) if keep_output else ()
                rows.append((text.n, form, *lengths, _digest(output(text, form, cuts)),
                             _digest(rebuild(output(text, form, cuts), form, packer, frame_bytes)), *whole))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()])]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return stored.mapInArrow(run, schema)
