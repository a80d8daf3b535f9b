"""Fingerprints of texts as one expression."""

from __future__ import annotations

from pagework.functions.text import let

BITS = 32
LANE = 21  # bits of a counter; three of them share a long, so a text may have two million tokens
GROUPS = range(-(-BITS // 3))


def fingerprint(text: str) -> str:
    """32-bit SimHash over the word tokens of a text, as eight hex digits; '' without tokens.

    A token votes with the first eight hex digits of its MD5. The votes are counted in one fold over the
    tokens: each number of its state holds the counters of three bits side by side, and a token adds to it what
    a table has for its three bits. Nothing is exploded, so the text needs no shuffle and no second read.
    """
    tokens = f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), t -> t <> '')"
    votes = f"transform({tokens}, t -> CAST(conv(substring(md5(t), 1, 8), 16, 10) AS BIGINT))"
    table = ", ".join(f"{sum((k >> j & 1) << LANE * j for j in range(3))}L" for k in range(8))

    def counted(hashes: str) -> str:
        zero = f"named_struct({', '.join(f"'c{i}', 0L" for i in GROUPS)})"
        added = ", ".join(f"'c{i}', s.c{i} + get(array({table}), CAST(shiftright(h, {3 * i}) & 7 AS INT))" for i in GROUPS)
        return f"aggregate({hashes}, {zero}, (s, h) -> named_struct({added}))"

    def digits(hashes: str) -> str:
        def of(s: str) -> str:
            votes_of = [f"shiftright({s}.c{b // 3}, {LANE * (b % 3)}) & {(1 << LANE) - 1}" for b in range(BITS)]
            bits = [f"CASE WHEN 2 * ({v}) > size({hashes}) THEN {1 << b}L ELSE 0L END" for b, v in enumerate(votes_of)]
            return f"lower(lpad(hex({' + '.join(bits)}), {BITS // 4}, '0'))"

        return f"CASE WHEN size({hashes}) > 0 THEN {let(counted(hashes), of)} ELSE '' END"

    return let(votes, digits)
