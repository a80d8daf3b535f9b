"""How text filters overlap: every filter's share under every order of application.

Filter E drops texts that are identical to one with a smaller id. The texts are range-partitioned by
adaptive prefixes: a prefix that too many texts begin with is lengthened until few enough share it, up to
the whole text. Each partition inserts its full texts into a compressed radix trie whose terminals hold the
minimum id and the rows that end there; a walk over the terminals gives the duplicate flags. Copies of
one text that are too many for a partition are dealt to several tries, and the minima of those meet in an
aggregation. What is left of a document is a mask of failed filters; masks are counted per part, and
all orders are read off the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pagework.llm.common import pieces, quoted
from pagework.plans.materialize import materialize

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
MIN_WORDS = 200
MARKS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PARTITION_BYTES = 16 << 20  # of text in a trie
LENGTHS = tuple(16 * 4**k for k in range(8))  # of prefixes, in code points, before the whole text
SHARE = 4  # a prefix may hold this part of a partition, so that ranges can be cut evenly


def text_mask(text: bytes) -> int:
    """Bit k: the text fails filter ``FILTERS[k]``, for those that look at one text (A to D)."""
    words = text.split()
    upper = len(text) - len(text.translate(None, UPPER))
    chars = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    failed = (len(words) < MIN_WORDS, 100 * len(set(words)) < 50 * len(words), 100 * upper > 2 * chars,
              len(text.translate(None, MARKS)) < len(text))
    return sum(f << k for k, f in enumerate(failed))


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a and b agree on the first ``low`` bytes and not on the first ``high``
    step = 64
    while low + step < high and a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Node:
    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.least, self.rows = label, {}, None, None


class Trie:
    """A compressed trie of whole texts; a terminal holds the least id and the rows of its text."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, text: bytes, key: object, row: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                at = len(text)
            elif text.startswith(child.label, at):
                at += len(child.label)
            else:
                n = shared(child.label, text[at : at + len(child.label)])
                upper = node.children[text[at]] = Node(child.label[:n])
                upper.children[child.label[n]] = child
                child.label = child.label[n:]
                child, at = upper, at + n
            node = child
        if node.rows is None:
            node.rows = []
        node.rows.append(row)
        if key is not None and (node.least is None or key < node.least):
            node.least = key

    def terminals(self) -> Iterator[Node]:
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.rows is not None:
                yield node
            waiting += node.children.values()


def _placed(docs: DataFrame, id_col: str, text_col: str, part_col: str, partition_bytes: int, lengths: tuple[int, ...]) -> tuple[DataFrame, int]:
    """``id, part, text, prefix, salt, hot`` and the number of partitions. ``prefix`` is the shortest
    beginning, of the given lengths or whole, that few enough texts share; where even the whole text is
    shared by too many rows, ``hot`` is its hash and ``salt`` deals its rows out."""
    narrow = docs.select(
        F.col(quoted(id_col)).alias("id"), F.coalesce(F.col(quoted(part_col)).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"),
    )
    rows, total = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    partitions = pieces(total, partition_bytes)
    most = max(1, rows // (partitions * SHARE))
    beginnings = [*(F.left("text", F.lit(n)) for n in lengths), F.col("text")]
    hashes = {f"h{k}": F.xxhash64(b) for k, b in enumerate(beginnings)}
    at_each = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.col(f"h{k}").alias("hash")) for k in range(len(hashes)))))
    # Fewer than SHARE * partitions prefixes of a length are heavy, however large the table is.
    counted = narrow.withColumns(hashes).select(at_each.alias("_")).select("_.*").groupBy("level", "hash").agg(F.count(F.lit(1)).alias("rows"))
    heavy = materialize(counted.filter(F.col("rows") > most), "heavy")
    placed = narrow.withColumns(hashes)
    for k in range(len(hashes)):
        those = heavy.filter(F.col("level") == k).select(F.col("hash").alias(f"h{k}"), F.col("rows").alias(f"n{k}"))
        placed = placed.join(F.broadcast(those), f"h{k}", "left")
    prefix: Column = F.col("text")
    for k in reversed(range(len(lengths))):
        prefix = F.when(F.col(f"n{k}").isNull(), beginnings[k]).otherwise(prefix)
    whole = len(lengths)
    hot = F.col(f"n{whole}").isNotNull()
    salt = F.pmod(F.xxhash64("id"), F.ceil(F.col(f"n{whole}") / most)).cast("int")
    return placed.select(
        "id", "part", "text", prefix.alias("prefix"), F.when(hot, salt).otherwise(0).alias("salt"), F.when(hot, F.col(f"h{whole}")).alias("hot"),
    ), partitions


def filter_masks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
    partition_bytes: int = PARTITION_BYTES, lengths: tuple[int, ...] = LENGTHS,
) -> DataFrame:
    """``id, part, mask``, a row per row: bit k of the mask says that filter k of ``FILTERS`` fails.

    A null text is empty and a null part the empty string. A row without an id has no smaller id and
    is none, and rows with the least id of their text are no duplicates, repeated rows included. An
    empty table gives no rows; columns beside the three are ignored.
    """
    placed, partitions = _placed(docs, id_col, text_col, part_col, partition_bytes, lengths)
    dealt = placed.repartitionByRange(partitions, "prefix", "salt").select("id", "part", F.col("text").cast("binary").alias("text"), "hot")
    kind = placed.schema["id"].dataType
    schema = StructType([StructField("id", kind), StructField("part", StringType()), StructField("mask", IntegerType()), StructField("hot", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, keys, masks, kept = Trie(), [], [], []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                trie.insert(text, key, len(keys))
                keys.append(key)
                masks.append(text_mask(text))
            kept.append(batch.select(["part", "hot"]))
        for node in trie.terminals():
            for row in node.rows:
                if keys[row] is not None and keys[row] > node.least:
                    masks[row] |= DUPLICATE
        at = 0
        for batch in kept:
            end = at + batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at:end], to_arrow_type(kind)), batch.column(0), pa.array(masks[at:end], pa.int32()), batch.column(1)], names=schema.names)
            at = end

    flagged = materialize(dealt.mapInArrow(run, schema), "masks")
    # Fewer hot texts than SHARE * partitions: each has more than that part of the rows.
    least = flagged.filter("hot IS NOT NULL").groupBy("hot").agg(F.min("id").alias("least"))
    late = F.when(F.col("id") > F.col("least"), F.col("mask").bitwiseOR(F.lit(DUPLICATE))).otherwise(F.col("mask"))
    return flagged.join(F.broadcast(least), "hot", "left").select("id", "part", late.alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: the documents of each mask, and those labelled good or toxic among them.

    If an id has several labels it counts as good, or as toxic, when one of them says so.
    """
    marks = labels.groupBy(F.col(quoted(id_col)).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = masks.join(marks, "id", "left")
    return marked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """A row per part, order and step from the counts of masks.

    Of the orders in which a document with k failures can be filtered, each of these filters removes
    it in the same number, so Shapley sums need no orders.
    """
    bits = {f: 1 << k for k, f in enumerate(FILTERS)}
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = F.explode(F.array(*(
        F.struct(F.lit(o).alias("filter_order"), F.lit(s + 1).alias("step"), F.lit(bits[o[s]]).alias("bit"), F.lit(sum(bits[f] for f in o[:s])).alias("earlier"))
        for o in orders for s in range(len(o)))))
    tried = counts.select("*", steps.alias("_")).select("part", "mask", "n", "good", "toxic", "_.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    before = F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    n = F.col("n")
    # 120 / k is whole for up to five failures.
    return tried.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~before, n).alias("kept"), total(fails & ~before, n).alias("removed"), total(fails & before, n).alias("redundant"),
        total(F.col("mask") == F.col("bit"), n).alias("unique_fails"), total(fails & ~before, F.col("good")).alias("good_lost"),
        total(fails & ~before, F.col("toxic")).alias("toxic_lost"),
        total(fails, n * F.expr(f"{len(orders)} div greatest(bit_count(mask), 1)")).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """The audit of whole documents; parts are the values of ``part_col``."""
    return audit(mask_counts(filter_masks(docs, id_col, text_col, part_col, partition_bytes), labels, id_col))
