"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of every text come from one pass of built-in expressions. Sequential covering then learns
from the labelled ones: a rule grows by the threshold with the best gain, counted in Spark over all
labelled rows left (a table of feature, bin and label counts, of fixed size, comes back for each
step), is pruned on rows set aside, and takes the rows it covers away. The list comes out as ordered
conditional expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagework.llm.common import UPPER, others, quoted
from pagework.plans.materialize import materialize

WINDOW = 5
BINS = 32
SYMBOLS = "#*$%&|<>"
_SPACE = r"[\x20\x09-\x0D]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Name and SQL of what rules look at; all are 0 for texts without words.
FEATURES = {
    "words": "cast(n_words AS double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "call_rate": "n_calls / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}
EXTRA = ("n_lines", "n_distinct", "n_upper", "n_calls")


def _paired(name: str, by: int) -> str:
    """SQL: the hash of every element of an array of hashes with the one ``by`` places on."""
    rest = f"greatest(size({name}) - {by}, 0)"
    return f"zip_with(slice({name}, 1, {rest}), slice({name}, {by + 1}, {rest}), (a, b) -> xxhash64(a, b))"


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the counts ``BASE`` and ``EXTRA``; columns of these names go.

    Words are runs without ASCII white space; repeated are the words in ``WINDOW``-word windows that
    occur twice or more in the text, told by 64-bit hashes of their words. Null and empty texts
    count 0 everywhere.
    """
    keep = [quoted(c) for c in others(docs, (text_col, *BASE, *EXTRA))]
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))

    def without(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")

    cut = docs.select(
        F.struct(*keep).alias("_keep") if keep else F.lit(None).cast("boolean").alias("_keep"),
        F.filter(F.split(text, _SPACE), lambda w: w != "").alias("_w"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
        without(SYMBOLS).alias("n_symbols"), without(UPPER).alias("n_upper"), without("!?").alias("n_calls"),
    )
    counts = cut.selectExpr(
        "_keep", "n_symbols", "n_upper", "n_calls", "cast(size(_w) AS long) AS n_words",
        "aggregate(_w, 0L, (n, w) -> n + length(w)) AS word_chars", "cast(size(_l) AS long) AS n_lines",
        "cast(size(_l) - size(array_distinct(_l)) AS long) AS n_dup_lines", "cast(size(array_distinct(_w)) AS long) AS n_distinct",
        "transform(_w, w -> xxhash64(w)) AS _1",
    )
    names = ["_keep", *EXTRA, *(b for b in BASE if b != "n_repeat_words")]
    # Hashes of two, four and five words from those of one.
    two = counts.selectExpr(*names, "_1", _paired("_1", 1) + " AS _2")
    four = two.selectExpr(*names, "_1", _paired("_2", 2) + " AS _4")
    five = four.selectExpr(*names, "zip_with(slice(_4, 1, greatest(size(_4) - 1, 0)), slice(_1, 5, greatest(size(_1) - 4, 0)), (a, b) -> xxhash64(a, b)) AS _5")
    # Most texts have no window twice, which a set tells; the others sort their windows.
    placed = five.selectExpr(
        *names, "IF(size(array_distinct(_5)) = size(_5), array(), array_sort(transform(_5, (h, i) -> struct(h, i)))) AS _s"
    )
    again = placed.selectExpr(
        *names,
        "array_sort(transform(filter(_s, (x, k) -> coalesce(get(_s, k - 1).h = x.h, false) OR coalesce(get(_s, k + 1).h = x.h, false)), x -> x.i)) AS _p",
    )
    gaps = f"zip_with(_p, slice(_p, 2, size(_p)), (a, b) -> least(coalesce(b - a, {WINDOW}), {WINDOW}))"
    done = again.selectExpr("_keep", *names[1:], f"aggregate({gaps}, 0L, (n, g) -> n + g) AS n_repeat_words")
    kept = [F.col("_keep")[c.strip("`").replace("``", "`")].alias(c.strip("`").replace("``", "`")) for c in keep]
    return done.select(*kept, *BASE, *EXTRA)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


def _cover(rule: list[Condition]) -> str:
    return " AND ".join(c.sql() for c in rule) or "true"


def _counts(rows: DataFrame, edges: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """Per feature and bin: rows to reject and rows to keep. Of fixed size, whatever the rows."""
    names = list(edges)
    def bin_of(name: str) -> str:
        edge_list = ", ".join(f"{e!r}D" for e in edges[name])
        return f"size(filter(array({edge_list}), e -> {name} > e))" if edges[name] else "0"

    bins = F.expr("array(" + ", ".join(f"struct({i} AS f, {bin_of(n)} AS b)" for i, n in enumerate(names)) + ")")
    table = rows.select("bad", F.explode(bins).alias("x")).groupBy("x.f", "x.b").agg(
        F.sum(F.col("bad").cast("int")).alias("bad"), F.sum((~F.col("bad")).cast("int")).alias("good")
    )
    out = {n: [(0, 0)] * (len(edges[n]) + 1) for n in names}
    for f, b, bad, good in table.collect():
        out[names[f]][b] = (bad, good)
    return out


def learn_rules(
    labelled: DataFrame, features: list[str], min_precision: float = 0.95, min_rows: int = 8, max_rules: int = 12, max_conditions: int = 3
) -> list[Rule]:
    """``labelled(key, bad, features...)`` to a decision list for bad rows.

    A quarter of the rows, by a hash of their keys, is set aside for pruning. A rule stays if it
    covers ``min_rows`` of the rows it grew on and the share of bad ones is ``min_precision`` on
    both parts. Thresholds are quantiles of the bad rows and of all.
    """
    rows = materialize(labelled.withColumn("aside", F.pmod(F.xxhash64("key"), F.lit(4)) == 3), "labelled")
    grid = [i / BINS for i in range(1, BINS)]
    quantiles = [F.percentile_approx(n, grid, 1000).alias(n) for n in features]
    found = [rows.agg(*quantiles).first(), rows.filter("bad").agg(*quantiles).first()]
    edges = {n: sorted({float(x) for row in found for x in (row[n] or [])}) for n in features}
    rules: list[Rule] = []
    left = rows
    for _ in range(max_rules):
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            counts = _counts(left.filter(f"NOT aside AND {_cover(rule)}"), edges)
            bad, good = (sum(c[k] for c in counts[features[0]]) for k in (0, 1))
            if bad < min_rows or not good and rule:
                break
            best: tuple[float, Condition | None] = (0.0, None)
            for name, bins in counts.items():
                below = [0, 0]
                for i, edge in enumerate(edges[name]):
                    below = [below[0] + bins[i][0], below[1] + bins[i][1]]
                    for above, p, n in ((False, *below), (True, bad - below[0], good - below[1])):
                        if p >= min_rows:
                            gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                            if gain > best[0] + 1e-9:
                                best = (gain, Condition(name, above, edge))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # The shortest prefix that is as good on the rows set aside.
        sums = [F.sum(F.when(F.expr(f"{which} AND {_cover(rule[:k])}") & (F.col("bad") == F.lit(kind)), 1).otherwise(0))
                for k in range(1, len(rule) + 1) for which in ("NOT aside", "aside") for kind in (True, False)]
        row = [x or 0 for x in left.agg(*sums).first()]
        scored = []
        for k in range(len(rule)):
            p, n, q, m = row[4 * k : 4 * k + 4]
            if p >= min_rows and p >= min_precision * (p + n) and q >= min_precision * (q + m):
                scored.append((round((q - m) / (q + m), 3) if q + m else 0.0, q, -k, Rule(tuple(rule[: k + 1]), p / (p + n), p)))
        if not scored:
            break
        rules.append(max(scored, key=lambda s: s[:3])[3])
        left = left.filter(f"NOT ({rules[-1].sql()})")
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row (from 1), null if none does."""
    out = F.when(F.lit(False), F.lit(0))
    for i, rule in enumerate(rules, 1):
        out = out.when(F.expr(rule.sql()), F.lit(i))
    return out


def judge_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options
) -> tuple[DataFrame, list[Rule]]:
    """One row per row of ``docs``: ``id_col``, ``BASE``, ``base_failed``, ``rule`` (which rejects it), ``kept``;
    and the rules.

    Rules are learnt from labelled rows that pass the base checks; null labels and ids are left out,
    of several labels of an id the lowest counts. Without labels there are no rules. Repeated rows
    and null ids come out as they came in; an empty table gives none.
    """
    named = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    counted = materialize(text_statistics(named), "statistics")
    base = counted.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")).selectExpr(
        "*", *(f"{sql} AS {name}" for name, sql in FEATURES.items())
    )
    known = labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("q")).filter(
        "id IS NOT NULL AND q IS NOT NULL").groupBy("id").agg(F.min("q").alias("q"))
    labelled = base.filter("NOT base_failed").join(known, "id").select(F.col("id").alias("key"), (F.col("q") == 0).alias("bad"), *FEATURES)
    rules = learn_rules(labelled, list(FEATURES), **options)
    judged = base.withColumn("rule", verdict(rules)).withColumn("kept", F.expr("NOT base_failed AND rule IS NULL"))
    return judged.select(F.col("id").alias(id_col), *BASE, "base_failed", "rule", "kept"), rules
