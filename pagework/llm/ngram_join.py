"""N-gram Jaccard join by rare-first prefix filtering.

A document is the set of its distinct word n-grams. Documents of equal sets are one class. How many
classes hold an n-gram is counted over the whole corpus, and every set is ordered rarest first. Two
sets that are similar enough share an n-gram of their prefixes, the rarest part of each; the prefix of
the shorter set may be shorter still, as its partner is no smaller. An n-gram that one class alone holds
matches nothing, so a class whose prefix is all such n-grams has no partner and goes no further.

Candidates have to pass a length filter, a positional filter (what may still be shared from the common
n-gram on) and a suffix filter (how much two sets can share at most, by intervals of the order). Each pair
is verified once, on the whole sets. The first turns try in each posting list only the pairs of every
member with a few others, which connects groups of near copies in a linear number of pairs; the
last turn tries all candidates that are not yet in one component, so no component is lost.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from pagework.llm.common import pieces, quoted, text_bytes
from pagework.llm.components import connected_components
from pagework.plans.materialize import materialize

GRAM = 5
PERCENT = 80
BLOCK_BYTES = 4 << 20  # of text; a block's n-grams take about twice that
RANGE_GRAMS = 2_000_000  # of a range of hashes
LEADERS = 2  # beside the shortest set of a posting list
WORTH = 100  # another turn of drawn pairs follows while one in so many is a link
INTERVALS = 8  # of the order of n-grams, by how many classes hold them
_ODD = np.array([xxhash.xxh64_intdigest(f"word {k}") | 1 for k in range(64)], np.uint64)


def gram_hashes(text: str | None, size: int = GRAM) -> np.ndarray:
    """Hashes of the distinct n-grams, ascending. A-Z are lower-cased, words are runs without ASCII white
    space; fewer words than ``size`` are one n-gram, no word gives none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    of = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    n = len(words) - k + 1
    sums = reduce(np.add, (of[i : i + n] * _ODD[i] for i in range(k))) + np.uint64(k)
    sums ^= sums >> np.uint64(32)
    sums *= _ODD[-1]
    sums ^= sums >> np.uint64(29)
    return np.unique(sums)


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (((hashes >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)).astype(np.int64)


def _marked(docs: DataFrame, id_col: str, text_col: str, size: int, block_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """The documents by block, and a narrow written row for each: ``id, mark, block, n, key``, where
    ``key`` stands for the set and is null for the empty one."""
    the_id, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    total = text_bytes(docs, text_col)
    blocked = docs.select(
        F.pmod(F.xxhash64(the_id, text), F.lit(pieces(total, block_bytes))).cast("int").alias("block"), the_id.alias("id"),
        F.xxhash64(text).alias("mark"), text.alias("text"))
    kind = blocked.schema["id"]

    def run(batches):
        for batch in batches:
            sets = [gram_hashes(t, size) for t in batch.column("text").to_pylist()]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), batch.column("block"), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary())],
                names=["id", "mark", "block", "n", "key"])

    schema = StructType([kind, StructField("mark", LongType()), StructField("block", IntegerType()), StructField("n", LongType()), StructField("key", BinaryType())])
    return blocked, materialize(blocked.mapInArrow(run, schema), "sets"), total


def _classes(marked: DataFrame) -> DataFrame:
    """A row per different set: ``key, class, least`` (smallest id) and the row that stands for it:
    ``rep, mark, block``. Copies combine before the shuffle."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "block")).alias("first")
    found = marked.filter("key IS NOT NULL").groupBy("key").agg(first, F.min("id").alias("least"))
    return materialize(found.select("key", F.monotonically_increasing_id().alias("class"), "least", F.col("first.id").alias("rep"), "first.mark", "first.block"), "classes")


def _representatives(block: pa.Table, reps: pa.Table, size: int) -> list[tuple[int, np.ndarray]]:
    """Class and set of each document of the block that stands for a class."""
    wanted = dict(zip(zip(reps["rep"].to_pylist(), reps["mark"].to_pylist()), reps["class"].to_pylist()))
    texts, out = block["text"], []
    for i, at in enumerate(zip(block["id"].to_pylist(), block["mark"].to_pylist())):
        if (number := wanted.pop(at, None)) is not None:
            out.append((number, gram_hashes(texts[i].as_py(), size)))
    return out


def _frequencies(blocked: DataFrame, reps: DataFrame, size: int, ranges: int) -> DataFrame:
    """For each block and range of hashes, which of the block's n-grams are in two classes or more and in
    how many: ``block, range, bits, counts``. A block sends each of its n-grams once with its count."""

    def send(block: pa.Table, mine: pa.Table) -> pa.Table:
        sets = [s for _, s in _representatives(block, mine, size)]
        distinct, times = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_counts=True)
        number = _range_of(distinct, ranges)
        cuts = np.flatnonzero(np.diff(number)) + 1
        first = np.concatenate(([0], cuts)) if len(distinct) else cuts
        parts = zip(np.split(distinct, cuts), np.split(times.astype(np.uint32), cuts)) if len(distinct) else ()
        sent = [(h.tobytes(), t.tobytes()) for h, t in parts]
        own = block["block"][0].as_py() if block.num_rows else 0
        return pa.table({
            "block": pa.array([own] * len(sent), pa.int32()), "range": pa.array(number[first], pa.int32()),
            "hashes": pa.array([h for h, _ in sent], pa.binary()), "times": pa.array([t for _, t in sent], pa.binary()),
        })

    def count(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in rows["hashes"].to_pylist()]
        times = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["times"].to_pylist()])
        distinct, place = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(place, times, len(distinct)).astype(np.uint32)[place]
        bits, counts, at = [], [], 0
        for p in parts:
            mine = totals[at : at + len(p)]
            at += len(p)
            bits.append(np.packbits(mine > 1).tobytes())
            counts.append(mine[mine > 1].tobytes())
        return pa.table({"block": rows["block"], "range": rows["range"], "bits": pa.array(bits, pa.binary()), "counts": pa.array(counts, pa.binary())})

    sent = blocked.groupBy("block").cogroup(reps.groupBy("block")).applyInArrow(send, "block int, range int, hashes binary, times binary")
    return sent.groupBy("range").applyInArrow(count, "block int, range int, bits binary, counts binary")


def _prefix(n: int, percent: int) -> int:
    """How many of the rarest n-grams of a set a similar set that is no larger must meet."""
    return n - -(-percent * n // 100) + 1


def _short_prefix(n: int, percent: int) -> int:
    """The same for a similar set that is no smaller."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def _survivors(blocked: DataFrame, reps: DataFrame, answers: DataFrame, size: int, ranges: int, percent: int) -> DataFrame:
    """``class, n, alone, grams, intervals`` of classes that may have a partner: ``alone`` n-grams are in no
    other class, ``grams`` are the others, rarest first, and ``intervals`` count these by their frequency."""

    def order(block: pa.Table, told: pa.Table) -> pa.Table:
        both = told["range"].is_valid()
        answer, mine = told.filter(both), told.filter(pc.invert(both))
        sets = _representatives(block, mine, size)
        distinct = np.unique(np.concatenate([s for _, s in sets]) if sets else np.empty(0, np.uint64))
        number, held = _range_of(distinct, ranges), np.ones(len(distinct), np.uint32)
        for r, bits, counts in zip(answer["range"].to_pylist(), answer["bits"].to_pylist(), answer["counts"].to_pylist()):
            lo, hi = np.searchsorted(number, (r, r + 1))
            again = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
            held[lo:hi][again] = np.frombuffer(counts, np.uint32)
        rows = []
        for of, s in sets:
            times = held[np.searchsorted(distinct, s)]
            repeated = times > 1
            alone = len(s) - int(repeated.sum())
            if alone < _prefix(len(s), percent):
                s, times = s[repeated], times[repeated]
                rank = np.lexsort((s, times))
                intervals = np.bincount(np.minimum(np.log2(times).astype(np.int64) - 1, INTERVALS - 1), minlength=INTERVALS)
                rows.append((of, len(s) + alone, alone, s[rank].view(np.int64), intervals))
        columns = list(zip(*rows)) if rows else [()] * 5
        return pa.table({
            "class": pa.array(columns[0], pa.int64()), "n": pa.array(columns[1], pa.int64()), "alone": pa.array(columns[2], pa.int64()),
            "grams": pa.array(columns[3], pa.list_(pa.int64())), "intervals": pa.array(columns[4], pa.list_(pa.int64())),
        })

    # One side to cogroup with: a block's representatives and the answers to its n-grams.
    told = reps.withColumns({"range": F.lit(None).cast("int"), "bits": F.lit(None).cast("binary"), "counts": F.lit(None).cast("binary")}).unionByName(
        answers, allowMissingColumns=True)
    schema = StructType([*(StructField(c, LongType()) for c in ("class", "n", "alone")),
                         StructField("grams", ArrayType(LongType())), StructField("intervals", ArrayType(LongType()))])
    return materialize(blocked.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(order, schema), "survivors")


def _postings(survivors: DataFrame, percent: int) -> DataFrame:
    """A row per n-gram of a prefix: ``gram, class, n, at`` (place in the whole order), ``short`` (whether it is in
    the shorter prefix too), ``intervals``. N-grams in one prefix only are left out."""
    prefix = F.expr(f"n - ceil({percent} * n / 100) + 1 - alone").cast("int")
    short = F.expr(f"n - ceil({2 * percent} * n / {100 + percent}) + 1")
    rows = survivors.select("class", "n", "alone", "intervals", F.posexplode(F.slice("grams", F.lit(1), prefix)).alias("k", "gram"))
    return materialize(rows.select("gram", "class", "n", (F.col("alone") + F.col("k")).alias("at"), (F.col("alone") + F.col("k") < short).alias("short"), "intervals"), "postings")


def _length_filter(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _led_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Every member of a posting list with its leaders: the shortest set and those with the least hashes."""
    draws = [F.min(F.struct(F.xxhash64(F.col("class"), F.lit(k)).alias("draw"), "class", "n")).alias(f"leader{k}") for k in range(LEADERS)]
    leaders = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("n", "class")).alias("shortest"), *draws).filter("members > 1")
    them = [F.struct(F.col(f"{name}.class").alias("a"), F.col(f"{name}.n").alias("an")) for name in ("shortest", *(f"leader{k}" for k in range(LEADERS)))]
    tried = postings.select("gram", "class", "n").join(leaders.select("gram", F.array_distinct(F.array(*them)).alias("leaders")), "gram")
    pairs = tried.select("class", "n", F.explode("leaders").alias("_")).select("class", "n", "_.*").filter("a <> class").filter(_length_filter("an", "n", percent))
    return pairs.select(F.least("a", "class").alias("u"), F.greatest("a", "class").alias("v")).distinct()


def _open_postings(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Posting lists with members of different components, and the ``root`` of each member."""
    rooted = postings.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    open_grams = rooted.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("short").alias("led")).filter("low < high AND led").select("gram")
    return materialize(rooted.join(open_grams, "gram", "left_semi"), "open")


def _drawn_pairs(rooted: DataFrame, percent: int, turn: int) -> DataFrame:
    """Members of open posting lists with a few members of other components, drawn anew for each list and turn: the
    larger a component is, the likelier they are of it."""
    draws = [F.min(F.struct(F.xxhash64("class", "gram", F.lit(LEADERS * turn + k)).alias("draw"), "class", "n", "root")).alias(f"leader{k}") for k in range(max(1, LEADERS))]
    leaders = rooted.groupBy("gram").agg(*draws)
    them = [F.struct(F.col(f"leader{k}.class").alias("a"), F.col(f"leader{k}.n").alias("an"), F.col(f"leader{k}.root").alias("ar")) for k in range(max(1, LEADERS))]
    tried = rooted.select("gram", "class", "n", "root").join(leaders.select("gram", F.array(*them).alias("leaders")), "gram")
    pairs = tried.select("class", "n", "root", F.explode("leaders").alias("_")).select("class", "n", "root", "_.*").filter("ar <> root").filter(_length_filter("an", "n", percent))
    return pairs.select(F.least("a", "class").alias("u"), F.greatest("a", "class").alias("v")).distinct()


def _open_pairs(rooted: DataFrame, percent: int) -> DataFrame:
    """All candidates that lie in different components: pairs of a shorter and a longer set that share an n-gram of
    the one's short and the other's prefix and pass the length, positional and suffix filters."""
    a = rooted.filter("short").selectExpr("gram", "class AS a", "n AS an", "at AS aat", "intervals AS ai", "root AS ar")
    b = rooted.selectExpr("gram", "class AS b", "n AS bn", "at AS bat", "intervals AS bi", "root AS br")
    pairs = a.join(b, "gram").filter("ar <> br AND (an < bn OR an = bn AND a < b)").filter(_length_filter("an", "bn", percent))
    needed = f"{percent} * (an + bn)"
    pairs = pairs.filter(f"{100 + percent} * least(an - aat, bn - bat) >= {needed}")
    pairs = pairs.filter(f"{100 + percent} * aggregate(zip_with(ai, bi, (x, y) -> least(x, y)), 0L, (x, y) -> x + y) >= {needed}")
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def _components(postings: DataFrame, survivors: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of the linked classes: turns of drawn pairs while these still find links, then all open pairs."""
    tried = materialize(_led_pairs(postings, percent), "tried")
    links = materialize(_verified(tried, survivors, percent), "links")
    roots, turn = connected_components(links), 0
    while True:
        rooted = _open_postings(postings, roots)
        drawn = materialize(_drawn_pairs(rooted, percent, turn).join(tried, ["u", "v"], "left_anti"), "tried")
        links = materialize(_verified(drawn, survivors, percent), "links")
        tried, found, n = tried.unionAll(drawn), links.count(), drawn.count()
        if found:
            roots = connected_components(links.unionAll(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))
        if found * WORTH < n or not found:
            break
        turn += 1
    rest = _open_pairs(_open_postings(postings, roots), percent).join(tried, ["u", "v"], "left_anti")
    links = _verified(rest, survivors, percent)
    return connected_components(links.unionAll(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))


def _verified(pairs: DataFrame, survivors: DataFrame, percent: int) -> DataFrame:
    """The pairs of sets that are similar enough, by their whole intersections."""
    sets = survivors.select("class", "n", "grams")
    both = pairs.join(sets.selectExpr("class AS u", "n AS un", "grams AS ug"), "u").join(sets.selectExpr("class AS v", "n AS vn", "grams AS vg"), "v")
    return both.withColumn("common", F.size(F.array_intersect("ug", "vg"))).filter(f"100 * common >= {percent} * (un + vn - common)").select("u", "v")


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = GRAM, percent: int = PERCENT,
    block_bytes: int = BLOCK_BYTES, range_grams: int = RANGE_GRAMS,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id``.

    Documents whose sets of n-grams have a Jaccard similarity of ``percent`` / 100 or more are linked;
    ``component_id`` is the smallest id that is reachable. Null and wordless texts are linked with nothing.
    Repeated rows come out as often as they came in. A null id is never the smallest unless the
    whole component has no other; then component_id is null. An empty table gives no rows. Columns beside
    the two are ignored, whatever their names.
    """
    blocked, marked, total = _marked(docs, id_col, text_col, size, block_bytes)
    classes = _classes(marked)
    reps = classes.select("block", "rep", "mark", "class")
    ranges = pieces(total // 4, range_grams)
    answers = _frequencies(blocked, reps, size, ranges)
    survivors = _survivors(blocked, reps, answers, size, ranges, percent)
    roots = _components(_postings(survivors, percent), survivors, percent).withColumnRenamed("node", "class")
    rooted = classes.select("key", "class", "least").join(roots, "class", "left").select("key", "least", F.coalesce("root", "class").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(names, "root").select("key", "component_id"), "named")
    # Empty sets match no key, and are dealt out by their ids.
    out = marked.withColumn("_key", F.coalesce("key", F.unhex(F.hex(F.xxhash64("id"))))).join(named.withColumnRenamed("key", "_key"), "_key", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
