"""Token ids of texts by a public tokenizer file, quickly for texts that repeat their words.

A byte-level tokenizer with the usual splitting pattern never merges across a single space or line
end between two characters that are not white space: the space begins the next piece, the line end
is a piece of its own. So such a text is cut there, each different piece is encoded once by the
tokenizers library, and a text's ids are the joined ids of its pieces. Texts with other white space,
and texts that hold the string of an added token, are encoded as they are.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Iterator

import numpy as np

END_ID = 2
CACHED_PIECES = 700_000  # of a worker, about 200 bytes each; when they are full, long pieces go, or all
WORDS_AT_ONCE = 256
SLICE_CHARS = 1 << 20
MARKS = ".,;:!?"
MARKS_SET = frozenset(MARKS)


assert array("I").itemsize == 4 and sys.byteorder == "little"


class Encoder:
    """Little-endian unsigned 32-bit ids of texts, as bytes. Strings of special tokens are ordinary text,
    or with ``special_as_text`` off what the library makes of them by itself: the token's one id."""

    _ready: dict[tuple[str, bool], "Encoder"] = {}

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        found = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in found if not (special_as_text and t.special)]
        self.cut = all(t.split() == [t] for t in self.added)  # else one may lie across the cuts
        self.first: dict[str, bytes] = {}  # pieces at the start of a line
        self.later: dict[str, bytes] = {}  # words behind a space
        self.marks: dict[str, bytes] = {}
        self.line_end = self._ids(["\n"])[0]
        self.line_end_id = int.from_bytes(self.line_end, "little")

    @classmethod
    def of(cls, path: str, special_as_text: bool = True) -> "Encoder":
        """One encoder for each worker process, file and reading of special tokens."""
        key = path, special_as_text
        if key not in cls._ready:
            cls._ready[key] = cls(path, special_as_text)
        return cls._ready[key]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, known: dict[str, bytes], words: set[str], space: str) -> None:
        """Words without white space only: a text of known words has none but what it was cut at."""
        words.discard("")
        together = list(words)
        new = words if " ".join(together).split() == together else {w for w in words if w.split() == [w]}
        if len(known) + len(new) > CACHED_PIECES:
            for word in [w for w in known if len(w) > 10]:
                del known[word]
            if 2 * len(known) > CACHED_PIECES:
                known.clear()
        # A mark behind a letter or a digit begins a piece of its own, so such words go by their stems.
        stems = {w: w.rstrip(MARKS) for w in new if w[-1] in MARKS_SET}
        marked = [w for w, stem in stems.items() if stem and stem[-1].isalnum()]
        fresh = list({*new.difference(marked), *(stems[w] for w in marked)}.difference(known))
        if fresh:
            self._learn_all(known, fresh, "\n" + space)
        for w in marked:
            stem = stems[w]
            known[w] = known[stem] + self._mark(w[len(stem):])

    def _learn_all(self, known: dict[str, bytes], words: list[str], between: str) -> None:
        """Many words in one text, each behind a line end, whose id no word has."""
        at = range(0, len(words), WORDS_AT_ONCE)
        texts = [between + between.join(words[i : i + WORDS_AT_ONCE]) for i in at]
        for i, data in zip(at, self._ids(texts)):
            ends = np.append(np.flatnonzero(np.frombuffer(data, "<u4") == self.line_end_id), len(data) // 4) * 4
            bounds = ends.tolist()
            for word, lo, hi in zip(words[i : i + WORDS_AT_ONCE], bounds, bounds[1:]):
                known[word] = data[lo + 4 : hi]

    def _mark(self, marks: str) -> bytes:
        if marks not in self.marks:
            self.marks[marks] = self._ids([marks])[0]
        return self.marks[marks]

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not self.cut:
            return self._ids(texts)
        holding = {k for k, t in enumerate(texts) for a in self.added if a in t}
        if holding:
            whole, rest = iter(self._ids([texts[k] for k in sorted(holding)])), iter(self._by_words([t for k, t in enumerate(texts) if k not in holding]))
            return [next(whole if k in holding else rest) for k in range(len(texts))]
        return self._by_words(texts)

    def _by_words(self, texts: list[str]) -> list[bytes]:
        first, later = self.first.get, self.later.get
        at_start: set[str] = set()
        behind: set[str] = set()
        found = []
        for t in texts:
            rows, holes = [], []
            for line in t.split("\n"):
                words = line.split(" ")
                row = list(map(later, words))
                row[0] = first(words[0])
                if None not in row:
                    rows.append(b"".join(row))
                    continue
                missing, j = [], -1
                for _ in range(row.count(None)):
                    j = row.index(None, j + 1)
                    missing.append((j, words[j]))
                if missing[0][0] == 0:
                    at_start.add(words[0])
                behind.update([w for j, w in missing if j])
                holes.append((len(rows), missing))
                rows.append(row)
            found.append((rows, holes))
        self._learn(self.first, at_start, "")
        self._learn(self.later, behind, " ")
        odd = []
        for k, (rows, holes) in enumerate(found):
            for i, missing in holes:
                row = rows[i]
                for j, word in missing:
                    row[j] = later(word) if j else first(word)
                if None in row:
                    odd.append(k)
                    break
                rows[i] = b"".join(row)
        whole = dict(zip(odd, self._ids([texts[k] for k in odd]))) if odd else {}
        return [whole[k] if k in whole else self.line_end.join(rows) for k, (rows, _) in enumerate(found)]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text; null and empty texts have none."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end] or "") <= SLICE_CHARS):
                chars += len(texts[end] or "")
                end += 1
            coded = iter(self._encode([t for t in texts[at:end] if t]))
            for t in texts[at:end]:
                yield next(coded) if t else b""
            at = end


def default_tokenizer() -> str:
    """The file that the registered queries use; operators take a path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
