"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text is cut to words; its k-grams are hashed, and of each window of w consecutive k-grams the
one with the least hash is kept as a fingerprint. Texts that share k + w - 1 words share a
fingerprint there. Document fingerprints that a benchmark item has too are extended: the word
windows around them are compared word for word with the items' windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagework.llm.common import UPPER, quoted
from pagework.plans.materialize import materialize

GRAM = 4
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> Column:
    """A-Z in lower case; words are runs of a-z, 0-9 and all characters beyond ASCII."""
    low = F.translate(F.coalesce(F.col(quoted(text)), F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(low, _SPLIT), lambda w: w != "")


def _fingerprints(texts: DataFrame, key: str, gram: int, window: int) -> DataFrame:
    """``key, words, marks``: marks are the winnowed positions (from 1) with their hashes.

    The least hash of each run of ``w`` grams is found with log2(w) passes of pairwise minima over
    the whole array; ties take the first. Texts below ``window`` words have no marks.
    """
    w = window - gram + 1
    # Hashes of words, then of pairs of neighbouring grams until they are ``gram`` words long.
    hashed = texts.selectExpr(key, "words", f"IF(size(words) >= {window}, transform(words, x -> xxhash64(x)), array()) AS g")
    length = 1
    while length < gram:
        by = min(length, gram - length)
        hashed = hashed.selectExpr(
            key, "words",
            f"zip_with(slice(g, 1, greatest(size(g) - {by}, 0)), slice(g, {by + 1}, greatest(size(g) - {by}, 0)), "
            "(a, b) -> xxhash64(a, b)) AS g",
        )
        length += by
    hashed = hashed.selectExpr(key, "words", "transform(g, (h, i) -> struct(h, i + 1 AS at)) AS least")
    step = 1
    while step < w:
        by = min(step, w - step)
        hashed = hashed.selectExpr(
            key, "words", 
            f"zip_with(slice(least, 1, greatest(size(least) - {by}, 0)), slice(least, {by + 1}, greatest(size(least) - {by}, 0)), "
            "(a, b) -> IF(a.h <= b.h, a, b)) AS least",
        )
        step += by
    # A kept gram is the least of neighbouring windows, so its repeats stand side by side.
    return hashed.selectExpr(key, "words", "filter(least, (m, i) -> i = 0 OR get(least, i - 1).at <> m.at) AS marks")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """``item, size, gram``: the distinct windows of every item, words joined by one space. An item
    of fewer words, but not none, is one window."""
    worded = items.select(F.col(quoted(id_col)).alias("item"), _words(text_col).alias("words")).filter("size(words) > 0")
    sized = worded.selectExpr("item", "words", f"least(size(words), {window}) AS size")
    return sized.selectExpr(
        "item", "size", "explode(array_distinct(transform(sequence(1, size(words) - size + 1), i -> array_join(slice(words, i, size), ' ')))) AS gram"
    )


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = 10, gram: int = GRAM,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and ``text_hash, n_words, n_hit, n_items, items`` (ids as
    sorted strings), ``spans`` (array of [start, end) word numbers, maximal), ``contaminated``.

    Null and empty texts have no words and no hits; so have items without words. Rows are told apart
    by id and text: rows with the same id and the same text are judged alike, null ids included.
    Repeated items count once per id, items with null ids never. Empty tables on either side work:
    no documents, no rows; no items, no hits.
    """
    worded = docs.select(F.col(quoted(id_col)).alias("id"), F.xxhash64(quoted(text_col)).alias("mark"), _words(text_col).alias("words"))
    windows = materialize(
        item_windows(items.filter(F.col(quoted(item_id_col)).isNotNull()), item_id_col, item_text_col, window), "windows"
    )
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # ``window`` numbers at most
    found = _candidates(worded, items, item_text_col, window, gram)
    for size in sorted(s for s in sizes if s < window):
        found = found.unionAll(_short(worded, windows, size))
    # Only what shares a fingerprint is here: each window's place once, then word for word.
    places = materialize(found.distinct(), "places")
    hits = places.join(windows.select("size", "gram").distinct(), ["size", "gram"], "left_semi")
    spans = hits.groupBy("id", "mark").agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("starts"))
    named = (
        places.select("id", "mark", "size", "gram").distinct()
        .join(windows, ["size", "gram"]).select("id", "mark", "item").distinct()
        .groupBy("id", "mark").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    judged = spans.join(named, on=[spans.id.eqNullSafe(named.id), spans.mark == named.mark]).select(
        spans.id.alias("hit_id"), spans.mark.alias("hit_mark"), "items",
        # Starts ascend; a window that begins inside or right behind the last span lengthens it.
        F.expr(
            "aggregate(starts, cast(array() AS array<struct<start: int, end: int>>), (spans, s) -> "
            "CASE WHEN size(spans) > 0 AND s.start <= element_at(spans, -1).end THEN concat(slice(spans, 1, size(spans) - 1), "
            "array(struct(element_at(spans, -1).start AS start, greatest(element_at(spans, -1).end, s.start + s.size) AS end))) "
            "ELSE concat(spans, array(struct(s.start AS start, s.start + s.size AS end))) END)"
        ).alias("spans"),
    )
    # Counting needs neither lower case nor the words: the pieces between, less an empty first and last one.
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    cut = docs.select(F.col(quoted(id_col)).alias("id"), F.xxhash64(quoted(text_col)).alias("mark"), F.split(text, _BETWEEN).alias("cut"))
    counted = cut.selectExpr(
        "id", "mark", "size(cut) - IF(cut[0] = '', 1, 0) - IF(size(cut) > 1 AND element_at(cut, -1) = '', 1, 0) AS n"
    )
    joined = counted.join(judged, on=[counted.id.eqNullSafe(judged.hit_id), counted.mark == judged.hit_mark], how="left")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return joined.select(
        F.col("id").alias(id_col), F.col("mark").alias("text_hash"), F.col("n").cast("long").alias("n_words"),
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size(F.coalesce("items", F.array())), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"),
        F.col("hit_mark").isNotNull().alias("contaminated"),
    )


def _candidates(worded: DataFrame, items: DataFrame, item_text_col: str, window: int, gram: int) -> DataFrame:
    """``id, mark, start, size, gram``: windows of documents around fingerprints that an item has.

    Each fingerprint takes the words around it along, so that it can be extended without a second
    look at the document. The items' distinct fingerprints are a written table, so Spark knows its
    size and sends it to the documents when it is small; otherwise the fingerprints meet in a
    shuffled semi-join, which keeps every row and never multiplies.
    """
    marks = _fingerprints(items.select(_words(item_text_col).alias("words"), F.lit(0).alias("none")), "none", gram, window)
    wanted = materialize(marks.selectExpr("inline(transform(marks, m -> struct(m.h AS h)))").distinct(), "marks")
    both = _fingerprints(worded.selectExpr("struct(id, mark) AS key", "words"), "key", gram, window)
    reach = window - gram
    around = both.selectExpr(
        "key",
        f"inline(transform(marks, m -> struct(m.h AS h, greatest(m.at - {reach}, 1) AS first, "
        f"slice(words, greatest(m.at - {reach}, 1), m.at + {window - 1} - greatest(m.at - {reach}, 1) + 1) AS near)))",
    )
    shared = around.join(wanted, "h", "left_semi")
    return shared.selectExpr(
        "key.id AS id", "key.mark AS mark", "first",
        f"posexplode(transform(sequence(1, size(near) - {window - 1}), i -> array_join(slice(near, i, {window}), ' '))) AS (step, gram)",
    ).selectExpr("id", "mark", "first + step - 1 AS start", f"{window} AS size", "gram")


def _short(worded: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """The same for items of ``size`` words: their only window is its own fingerprint."""
    wanted = materialize(windows.filter(f"size = {size}").select("gram").distinct(), "short")
    grams = worded.filter(f"size(words) >= {size}").selectExpr(
        "id", "mark", f"posexplode(transform(sequence(1, size(words) - {size - 1}), i -> array_join(slice(words, i, {size}), ' '))) AS (start, gram)"
    )
    return grams.join(wanted, "gram", "left_semi").selectExpr("id", "mark", "start", f"{size} AS size", "gram")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a window of an item; all columns stay. Rows are told apart by
    id and text, so a clean row stays even where its id is null or repeated."""
    judged = contamination(docs, items, id_col, text_col, **options).filter("contaminated")
    gone = materialize(judged.select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    same = docs[quoted(id_col)].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[quoted(text_col)]) == gone["_hash"])
    return docs.join(gone, same, "left_anti")
