"""Byte-exact dedup with a logarithmic family of sorted window arrays in every partition.

Every window of ``window`` bytes is assigned to an anchor, the k-gram with the least hash in it, so
equal windows have equal anchors. Neighbouring windows with the same anchor are a run. Runs whose
anchor occurs nowhere else cannot repeat and stay where they are; of the others the bytes go to the
partition of their anchor, in order of their documents. There the windows of each new batch of runs are
sorted by their bytes and looked up in the sorted windows of earlier batches, and those not seen before
become a new level; levels of about equal size merge, so a partition has a logarithmic number of them.
A level holds windows, cut to the one length that is asked for, not suffix positions with match lengths, and
lives as long as its task. What is found goes back to the blocks of documents as intervals of window starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from pagework.llm.common import pieces
from pagework.llm.repeats import Blocks, in_order, read_bits, repeated_hashes
from pagework.llm.substring_dedup import BYTE_BASE, BYTE_VALUES, mix, powers, runs, unpack

ANCHOR = 40
PARTITION_BYTES = 2 << 20
BLOCK_BYTES = 2 << 20  # hashing takes about 60 bytes for each
BATCH_BYTES = 256 << 10
RESULTS = ("n_bytes", "n_removed", "n_spans", "spans", "kept_bytes")


_tables: list[np.ndarray] = []  # of a worker: powers of the base and of its inverse, as long as any block needed


def _powers(size: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) < size:
        size = -(-size // (1 << 20)) << 20
        _tables[:] = [powers(BYTE_BASE, size), powers(pow(BYTE_BASE, -1, 1 << 64), size)]
    return _tables


class Bytes:
    """A block's texts as bytes, end to end, with their windows and anchors."""

    def __init__(self, texts: list[str | None], window: int, anchor: int):
        self.window, self.anchor = window, anchor
        encoded = [(t or "").encode() for t in texts]
        self.data = b"".join(encoded)
        self.bounds = np.cumsum([0, *map(len, encoded)])
        self.raw = np.frombuffer(self.data, np.uint8)
        n = len(self.raw)
        up, self.back = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[self.raw] * up[:n], out=self.sums[1:])

    def hashes(self, size: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Of the strings of ``size`` bytes that start at ``at``."""
        n = max(0, len(self.raw) - size + 1)
        return mix((self.sums[size:][:n][at] - self.sums[:n][at]) * self.back[:n][at])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows: first start, one past the last, hash of the anchor, text number."""
        n = len(self.raw) - self.window + 1
        none = np.empty(0, np.int64)
        if n <= 0:
            return none, none, none.astype(np.uint64), none
        hashes = self.hashes(self.anchor)
        low = np.uint64((1 << max(24, len(self.raw).bit_length())) - 1)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # the first of equal ones wins
        have, want = 1, self.window - self.anchor + 1
        while have < want:
            step = min(have, want - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        at = (least[:n] & low).astype(np.int64)
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        whole = text[:n] == text[self.window - 1 :]
        # A run ends where the anchor or the text changes.
        change = np.concatenate(([True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1]) | (text[1:n] != text[: n - 1]), [True]))
        edges = np.flatnonzero(change)
        first, last = edges[:-1], edges[1:]
        keep = whole[first]
        first, last = first[keep], last[keep]
        return first, last, hashes[at[first]], text[first]


class Family:
    """Sorted arrays of the different windows seen so far, of geometrically growing sizes."""

    def __init__(self, window: int):
        self.window, self.levels = window, []

    def add(self, contents: list[bytes]) -> np.ndarray:
        """Take runs in; for each of their windows, in order, whether it was there before."""
        sizes = np.array([len(c) for c in contents])
        counts = sizes - self.window + 1
        offset = np.repeat(np.cumsum(sizes) - sizes, counts)
        start = offset + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        data = np.frombuffer(b"".join(contents), np.uint8)
        windows = np.lib.stride_tricks.sliding_window_view(data, self.window)[start]
        strings = np.ascontiguousarray(windows).view(f"S{self.window}").ravel()
        order = np.argsort(strings, kind="stable")  # ties by arrival
        suffixes = strings[order]
        seen = np.zeros(len(order), bool)
        seen[1:] = suffixes[1:] == suffixes[:-1]
        for level in self.levels:
            at = np.searchsorted(level, suffixes)
            at[at == len(level)] = 0
            seen |= level[at] == suffixes
        new = suffixes[~seen]
        if len(new):
            self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            self.levels[-2:] = [np.sort(np.concatenate(self.levels[-2:]), kind="stable")]
        out = np.empty(len(order), bool)
        out[order] = seen
        return out


def drop_earlier_strings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100, anchor: int = ANCHOR
) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, spans`` (maximal [start, end) of removed bytes) and
    ``kept_bytes``; input columns of these names go.

    Texts are UTF-8 bytes. Removed is every byte covered by a string of ``window`` bytes that also
    starts earlier: in a row with a smaller id, or before in the same text. Null ids come last; rows
    of one id are ordered by a hash and their texts, so of repeated rows the first keeps its bytes.
    Null and empty texts are empty. Every row comes out once; an empty table gives none.
    """
    blocks = Blocks(docs, id_col, text_col, RESULTS, BLOCK_BYTES)
    id_type = blocks.fields["_id"]

    def hashes_of(block: pa.Table) -> np.ndarray:
        return Bytes(block["_text"].to_pylist(), window, anchor).runs()[2]

    answers, ranges = repeated_hashes(blocks, hashes_of, blocks.total // 30)

    def send(block: pa.Table, answer: pa.Table) -> pa.Table:
        block = in_order(block)
        texts = Bytes(block["_text"].to_pylist(), window, anchor)
        first, last, hashes, text = texts.runs()
        distinct, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
        again = (read_bits(answer, distinct, ranges) | (times > 1))[which]
        hot = read_bits(answer, distinct, ranges, "hot")[which][again]
        first, last, hashes, text = first[again], last[again], hashes[again], text[again]
        if hot.any():  # the runs of very common anchors go window by window, each by its own hash
            counts = np.where(hot, last - first, 1)
            of = np.repeat(np.arange(len(first)), counts)
            step = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            single = hot[of]
            first, last, hashes, text = first[of] + np.where(single, step, 0), last[of], hashes[of], text[of]
            last = np.where(single, first + 1, last)
            hashes = np.where(single, texts.hashes(window, first), hashes)
        held: set[bytes] = set()
        contents: list[bytes | None] = []
        keys = hashes.copy()
        for a, b in zip(first.tolist(), (last + window - 1).tolist()):
            content = texts.data[a:b]
            contents.append(None if content in held else content)  # a copy within the block: all of it is there before
            held.add(content)
        # What is decided already need not meet its anchor's partition, however common the anchor is.
        decided = np.flatnonzero([c is None for c in contents])
        keys[decided] = mix(first[decided].astype(np.uint64))
        return pa.table({
            "key": pa.array(keys.view(np.int64)), "_block": pa.array([block["_block"][0].as_py()] * len(first) if len(first) else [], pa.int32()),
            "_id": block["_id"].take(pa.array(text)), "row": pa.array(text.astype(np.int32)),
            "start": pa.array(first - texts.bounds[text]), "windows": pa.array(last - first), "content": pa.array(contents, pa.binary()),
        })

    sent = blocks.docs.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(send, StructType([
        StructField("key", LongType()), StructField("_block", IntegerType()), StructField("_id", id_type),
        StructField("row", IntegerType()), StructField("start", LongType()), StructField("windows", LongType()),
        StructField("content", BinaryType()),
    ]))
    placed = sent.repartition(pieces(blocks.total, PARTITION_BYTES), "key").sortWithinPartitions(
        F.asc_nulls_last("_id"), "_block", "row", "start"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, held = Family(window), set()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_BYTES // (2 * window)):
                batch = whole.slice(at, BATCH_BYTES // (2 * window))
                contents = batch.column("content").to_pylist()
                new = []
                for i, c in enumerate(contents):
                    if c is not None and c not in held:
                        held.add(c)
                        new.append(i)
                counts = batch.column("windows").to_numpy()
                seen = np.ones(int(counts.sum()), bool)
                ends = np.cumsum(counts)
                if new:
                    mine = np.concatenate([np.arange(ends[i] - counts[i], ends[i]) for i in new])
                    seen[mine] = family.add([contents[i] for i in new])
                # Intervals of seen windows, cut at the ends of runs.
                row = np.repeat(np.arange(len(counts)), counts)
                edge = np.flatnonzero(np.concatenate(([True], (seen[1:] != seen[:-1]) | (row[1:] != row[:-1]), [True])))
                lo, hi = edge[:-1], edge[1:]
                lo, hi = lo[seen[lo]], hi[seen[lo]]
                of = row[lo]
                shift = batch.column("start").to_numpy()[of] - (ends - counts)[of]
                yield pa.RecordBatch.from_arrays([
                    batch.column("_block").take(pa.array(of)), batch.column("row").take(pa.array(of)),
                    pa.array(lo + shift), pa.array(hi + shift),
                ], names=["_block", "row", "lo", "hi"])

    found = placed.mapInArrow(scan, "_block int, row int, lo long, hi long")

    def cut(block: pa.Table, intervals: pa.Table) -> pa.Table:
        block = in_order(block)
        encoded = [(t or "").encode() for t in block["_text"].to_pylist()]
        bounds = np.cumsum([0, *map(len, encoded)])
        step = np.zeros(bounds[-1] + 1, np.int64)
        base = bounds[intervals["row"].to_numpy()] if intervals.num_rows else np.empty(0, np.int64)
        np.add.at(step, base + intervals["lo"].to_numpy(), 1)
        np.add.at(step, base + intervals["hi"].to_numpy() + window - 1, -1)
        gone = np.cumsum(step)[:-1] > 0
        removed, spans, kept = [], [], []
        for i, data in enumerate(encoded):
            mask = gone[bounds[i] : bounds[i + 1]]
            removed.append(int(mask.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in runs(mask)])
            kept.append(np.frombuffer(data, np.uint8)[~mask].tobytes() if removed[-1] else data)
        return pa.table({
            "_id": block["_id"], "_text": block["_text"], "_rest": block["_rest"],
            "n_bytes": pa.array(np.diff(bounds)), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array([len(s) for s in spans], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept_bytes": pa.array(kept, pa.binary()),
        })

    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    out = blocks.docs.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(cut, StructType([
        *(StructField(n, blocks.fields[n]) for n in ("_id", "_text", "_rest")),
        StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()),
        StructField("spans", ArrayType(span)), StructField("kept_bytes", BinaryType()),
    ]))
    return unpack(out, blocks, docs, id_col, text_col, RESULTS)
