"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text and the first letters of its longer words; every term of every
text has one of ``SLOTS`` slots by its hash. score = sigmoid(bias + sum of weights + sum over pairs of
terms of the product of their factors), so a pair such as an insult and the mention of a group counts
beyond its two words, also where neither tells anything by itself. The machine is fitted with numpy on the
labelled sample: weights start from, and are drawn back to, the log-odds of their slots, shrunk by what chance
alone would do; factors are learnt for all slots alike. No term is left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagework.llm.common import others, quoted
from pagework.plans.materialize import materialize

MAX_LABELLED = 20_000  # labelled rows that the fit reads at most, chosen by a hash of their ids
SLOTS = 1 << 18
EXAMPLES = 90_000  # that the fit looks at, in passes over the sample
PASSES = (4, 30)  # at least and at most
BATCH = 64
CHANCE = 20.0  # chi-square that chance alone reaches among so many slots; the prior is shrunk by it
THRESHOLD = 0.3
RESULTS = ("score", "predicted")
_WORD = re.compile(r"[^\W_]+")
PREFIXES = (4, 5)


def _slot(term: str) -> int:
    data = term.encode()
    return (zlib.crc32(data) * 2654435761 ^ zlib.adler32(data)) % SLOTS


def _slots_of(word: str) -> list[int]:
    return [_slot(word), *(_slot(f"{word[:n]}*") for n in PREFIXES if len(word) > n)]


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Machine:
    """A weight and factors for every slot."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    @classmethod
    def blank(cls, rank: int = 1) -> "Machine":
        return cls(-3.0, np.zeros(SLOTS, np.float32), np.zeros((SLOTS, rank), np.float32))

    def words(self, words: list[str]) -> np.ndarray:
        """What each word adds to a text's sums: its weights less half the squares of its factors, and the factors."""
        slots = [_slots_of(w) for w in words]
        flat = np.fromiter((s for of in slots for s in of), np.int64)
        starts = np.cumsum([0, *map(len, slots)])[:-1]
        factors = self.factors[flat]
        alone = self.weights[flat] - 0.5 * (factors * factors).sum(1)
        return np.add.reduceat(np.column_stack((alone, factors)), starts, axis=0) if len(slots) else np.empty((0, 1 + factors.shape[1]), np.float32)

    def logit(self, sums: np.ndarray) -> float:
        """Of the sums over a text's words."""
        return self.bias + float(sums[0]) + 0.5 * float(sums[1:] @ sums[1:])


def _prior(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log-odds of the slots among the labelled texts; none where chance may have made them."""
    seen, yes = np.zeros(SLOTS), np.zeros(SLOTS)
    for row, label in zip(rows, labels):
        slots = np.unique(row)
        seen[slots] += 1
        if label:
            yes[slots] += 1
    n, positives = len(rows), labels.sum()
    expected = seen * (positives / n)
    strength = np.divide((yes - expected) ** 2, expected * (1 - positives / n), out=np.zeros(SLOTS), where=seen > 0)
    odds = np.log((yes + 0.5) / (positives + 1)) - np.log((seen - yes + 0.5) / (n - positives + 1))
    kept = np.maximum(0, 1 - np.divide(CHANCE, strength, out=np.full(SLOTS, np.inf), where=strength > 0))
    return (0.5 * odds * kept).astype(np.float32)  # a word counts by up to three terms


def fit(rows: list[np.ndarray], labels: np.ndarray, rank: int = 8, rate: float = 0.1, pull: float = 0.005, decay: float = 0.01, seed: int = 7) -> Machine:
    """Gradient steps on the logistic loss over small batches; the rarer label weighs up to four times less than its odds.

    ``rows`` are the slots of the texts' terms. A step is divided by the root of the text's length, so that
    long texts do not outweigh short ones.
    """
    random = np.random.default_rng(seed)
    prior = _prior(rows, labels)
    m = Machine(-3.0, prior.copy(), random.normal(0, 0.01, (SLOTS, rank)).astype(np.float32))
    seen = np.full((SLOTS, rank), 1e-3, np.float32)
    positives = max(1, int(labels.sum()))
    weight = np.where(labels > 0, max(1.0, min(50.0, (len(labels) - positives) / positives / 4)), 1.0)
    batches = np.array_split(random.permutation(len(rows)), -(-len(rows) // BATCH))
    for turn in range(min(PASSES[1], max(PASSES[0], EXAMPLES // len(rows)))):
        step = rate / (1 + 0.1 * turn)
        for number in random.permutation(len(batches)):
            batch = np.array([i for i in batches[number] if len(rows[i])], np.int64)
            if not len(batch):
                continue
            sizes = np.array([len(rows[i]) for i in batch])
            flat, starts, of = np.concatenate([rows[i] for i in batch]), np.cumsum(sizes) - sizes, np.repeat(np.arange(len(batch)), sizes)
            factors = m.factors[flat]
            sums = np.add.reduceat(factors, starts, axis=0)
            alone = np.add.reduceat(m.weights[flat] - 0.5 * (factors * factors).sum(1), starts)
            logits = m.bias + alone + 0.5 * (sums * sums).sum(1)
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[batch]) * weight[batch]
            m.bias -= step * float(error.mean())
            each = (error / np.sqrt(sizes) / len(batch)).astype(np.float32)[of]
            order = np.argsort(flat, kind="stable")
            used, first = np.unique(flat[order], return_index=True)
            slope = np.add.reduceat(each[order], first)
            m.weights[used] -= step * slope + pull * (m.weights[used] - prior[used])
            slopes = np.add.reduceat((each[:, None] * (sums[of] - factors))[order], first, axis=0)
            seen[used] += slopes * slopes
            m.factors[used] = m.factors[used] * (1 - step * decay) - step * slopes / np.sqrt(seen[used])
    return m


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> Machine:
    """Fit on the texts of at most ``max_labelled`` rows of ``labels``, those with the least id hashes.

    Rows with a null id or label are left out. One label row per id counts (the larger label).
    Without usable rows the model scores every text alike, low.
    """
    chosen = (
        labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).cast("int").alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    )
    chosen = materialize(chosen, "labelled")
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    # Bounded: max_labelled rows. Copies count once.
    sample = texts.join(F.broadcast(chosen), "id").groupBy("text").agg(F.max("y").alias("y"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(sorted(s for w in _words(t) for s in _slots_of(w)), np.int32).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.binary())], names=["y", "slots"])

    picked = sorted((r.y > 0, bytes(r.slots)) for r in sample.select("y", "text").mapInArrow(pick, "y int, slots binary").collect())
    outcome = np.array([float(y) for y, _ in picked])
    if not 0 < outcome.sum() < len(outcome):
        return Machine.blank()
    return fit([np.frombuffer(s, np.int32) for _, s in picked], outcome)


def score_toxicity(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold); columns of these names go.

    Only the text is looked at. Null, empty and wordless texts get the score of the bias alone.
    Every row comes out once; an empty table gives none.
    """
    keep = [c for c in docs.columns if c in set(others(docs, RESULTS))]
    at = keep.index(text_col)
    remembered = 100_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 1 + machine.factors.shape[1]
        known: dict[str, int] = {}  # words, by their rows in the table
        table = np.empty((2 * remembered, width), np.float32)
        for batch in batches:
            logits = []
            for text in batch.column(at).to_pylist():
                words = _words(text)
                new = list(words.difference(known))
                if len(known) + len(new) > remembered:
                    known.clear()
                    new = list(words)
                if len(new) > remembered:  # a text of more different words than are remembered
                    parts = (machine.words(new[i : i + remembered]) for i in range(0, len(new), remembered))
                    logits.append(machine.logit(sum(p.sum(0, dtype=np.float64) for p in parts)))
                    continue
                if new:
                    table[len(known) : len(known) + len(new)] = machine.words(new)
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                places = np.sort(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                logits.append(machine.logit(table[places].sum(0, dtype=np.float64)))
            score = 1 / (1 + np.exp(-np.clip(np.array(logits), -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*batch.schema.names, *RESULTS]
            )

    out = docs.select(*(quoted(c) for c in keep))
    return out.mapInArrow(run, out.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema)


def held_out(id_col: Column) -> Column:
    """Rows that no fit of the registered queries sees: crc32 of the id as text is 2 modulo 4."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2
