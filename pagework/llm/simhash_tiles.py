"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit fingerprint. Distinct fingerprints are laid out in tiles by the population
counts of their four quarters. Two fingerprints that differ in at most ``radius`` bits have quarter
counts that differ by at most ``radius`` in sum, so only tile pairs within that distance are
compared, and those completely: numpy exclusive-or and bit counts over the whole pair. Each tile
pair reports a spanning forest of its links instead of the links themselves, so a group of
near copies never multiplies; components of the forests are the components of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagework.llm.common import others, quoted
from pagework.llm.components import connected_components
from pagework.plans.materialize import materialize

QUARTERS = 4
TILE = 4096  # fingerprints in a tile: 32 KB
_STEP = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as a signed long.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are ``shingle`` words
    joined by one space, counted as often as they occur; a shorter text is one shingle; no word
    gives 0. A bit is set if more than half of the shingles' XXH64 (seed 42) have it.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    shifted = [words[i:] for i in range(shingle)] if len(words) > shingle else [[w] for w in words]
    counts, n = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    hashes = np.fromiter(
        map(partial(xxhash.xxh64_intdigest, seed=42), map(b" ".join, zip(*shifted))), np.uint64, n
    )
    for at in range(0, n, _STEP):
        part = hashes[at : at + _STEP].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` without the text, plus ``fp`` (long; replaces a column of that name)."""
    keep = others(docs, (text_col, "fp"))
    narrow = docs.select(*(quoted(c) for c in keep), F.col(quoted(text_col)).cast("string").alias("fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t, shingle) for t in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], fp], names=b.schema.names)

    return narrow.mapInArrow(run, narrow.withColumn("fp", F.lit(0).cast("long")).schema)


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``a``, or between ``a`` and ``b``: node, root."""
    other = a if b is None else b
    found: list[np.ndarray] = []
    for at in range(0, len(a), 512):
        near = np.bitwise_count(a[at : at + 512, None] ^ other[None, :]) <= radius
        if b is None:
            near &= np.arange(at, at + near.shape[0])[:, None] < np.arange(len(a))[None, :]
        hit = np.flatnonzero(near)
        if len(hit):
            i, j = np.divmod(hit, len(other))
            found.append(np.stack((i + at, j + (0 if b is None else len(a)))))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, j = np.concatenate(found, axis=1)
    nodes = (a if b is None else np.concatenate((a, b))).view(np.int64)
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        for end in (i, j, label[i], label[j]):
            np.minimum.at(new, end, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _tiles(fps: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """Cells with their number of tiles, and the tiles: ``cell, tile, fps``.

    A cell is the vector of the quarters' population counts: 17 ** 4 cells at most. The rows of a
    cell are dealt by a hash to as many tiles as its counted size needs.
    """
    counts = [F.bit_count(F.expr(f"shiftrightunsigned(fp, {16 * q}) & 65535")) for q in range(QUARTERS)]
    cell = sum((c * (17**q) for q, c in enumerate(counts)), F.lit(0)).cast("int")
    placed = fps.select("fp", cell.alias("cell"))
    cells = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    cells = materialize(cells, "cells")
    tiled = (
        placed.join(F.broadcast(cells), "cell")  # 17 ** 4 rows of two numbers at most
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .groupBy("cell", "tile")
        .agg(F.collect_list("fp").alias("fps"))
    )
    return cells, materialize(tiled, "tiles")


def _tile_pairs(cells: DataFrame, radius: int) -> DataFrame:
    """All pairs of tiles whose population counts lie within the radius, each pair once."""
    steps = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    digits = [F.expr(f"cast(floor(cell / {17**q}) as int) % 17") for q in range(QUARTERS)]
    step = F.explode(F.array(*(F.array(*map(F.lit, d)) for d in steps))).alias("step")
    other = cells.select("cell", "tiles", *(d.alias(f"d{q}") for q, d in enumerate(digits)), step)
    moved = [F.col(f"d{q}") + F.col("step")[q] for q in range(QUARTERS)]
    inside = " AND ".join(f"d{q} + step[{q}] BETWEEN 0 AND 16" for q in range(QUARTERS))
    near = other.filter(inside).select(
        F.col("cell").alias("a_cell"),
        F.explode(F.expr("sequence(0, tiles - 1)")).alias("a_tile"),
        sum((m * (17**q) for q, m in enumerate(moved)), F.lit(0)).cast("int").alias("cell"),
    ).filter("a_cell <= cell")
    return near.join(cells, "cell").select(
        "a_cell", "a_tile", F.col("cell").alias("b_cell"),
        F.explode(F.expr("sequence(0, tiles - 1)")).alias("b_tile"),
    ).filter("a_cell < b_cell OR a_tile <= b_tile")


def near_links(fps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """``fps(fp)``, distinct, to a forest ``u, v`` that connects what the links connect."""
    cells, tiles = _tiles(fps, tile)
    pairs = (
        _tile_pairs(cells, radius)
        .join(tiles.selectExpr("cell AS a_cell", "tile AS a_tile", "fps AS a_fps"), ["a_cell", "a_tile"])
        .join(tiles.selectExpr("cell AS b_cell", "tile AS b_tile", "fps AS b_fps"), ["b_cell", "b_tile"])
        .selectExpr("a_cell = b_cell AND a_tile = b_tile AS same", "a_fps", "b_fps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for same, a, b in zip(batch.column("same").to_pylist(), batch.column("a_fps"), batch.column("b_fps")):
                left = a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                right = None if same else b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                u, v = forest(left, right, radius)
                if len(u):
                    out.append((u, v))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(side)) for side in zip(*out)], names=["u", "v"]
                )

    return pairs.mapInArrow(run, "u long, v long")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
    tile: int = TILE,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fp`` (long), ``component_id``.

    Rows whose fingerprints are linked by steps of at most ``radius`` bits form a component, named
    by its smallest id. Null, empty and wordless texts have fingerprint 0 and are linked as any
    other. Repeated rows come out as often as they came in. Null ids are never the smallest unless
    the whole component has none; then component_id is null. An empty table gives no rows. Columns
    beside the two are ignored, whatever their names.
    """
    named = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    marked = materialize(with_fingerprint(named, "text", shingle), "fingerprints")
    # Copies meet here: one row per fingerprint, combined before the shuffle.
    distinct = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = connected_components(near_links(distinct.select("fp"), radius, tile))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named_fps = materialize(rooted.join(names, "root").select("fp", "component_id"), "named")
    return marked.join(named_fps, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, then the least hash of its text
    and of its other columns, so the choice is the same whatever is run again.

    Rows that are alike in every column count as one. Rows of one id with different texts are documents of
    their own. Rows without an id cannot be named and all stay. An empty table gives none.
    """
    rest = [quoted(c) for c, kind in docs.dtypes if c not in (id_col, text_col) and not kind.startswith(("map", "variant"))]
    # -0.0 and NaN apart, equal rows have equal hashes, and unequal ones differ but for a chance of 2 ** -64.
    key = F.struct(F.col(quoted(id_col)).alias("id"), F.xxhash64(quoted(text_col)).alias("text"), F.xxhash64(*rest, F.lit(0)).alias("rest"))
    named = docs.filter(F.col(quoted(id_col)).isNotNull()).select(key.alias("row"), F.col(quoted(text_col)).alias("text"))
    groups = simhash_groups(named, "row", "text", shingle, radius)
    keep = materialize(groups.filter("row = component_id").select(F.col("row").alias("_row")).distinct(), "kept")
    # The sorted join leaves the rows of a key together, so the last step needs no shuffle of its own.
    kept = docs.withColumn("_row", key).join(keep, "_row", "left_semi").dropDuplicates(["_row"]).drop("_row")
    return kept.unionAll(docs.filter(F.col(quoted(id_col)).isNull()))
