"""DuckDB counterparts of the registered queries, where SQL can express them.

The other operators have no entry: trained models (op1, op2), HTML trees (op3), packing, tokenizers and
plane files (op5, op10), XXH64 and linking by steps (op6, op11), and windows of words or bytes over
whole texts, which are too slow in SQL on whole tables (op4, op8, op9). Tests compare those with
brute force, exact round trips or held-out labels.
"""

from __future__ import annotations

# Control strings of the instruction template, longest first.
_CONTROLS = ("<s><<SYS>>", "<</SYS>>", "[/INST]", "[/ROLE]", "[/TURN]", "[INST]", "[ROLE]", "[ANS]", "</s>")


def _escaped() -> str:
    out = r"replace(text, '\', '\\')"
    for c in _CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_CHATS = f"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, coalesce(lag(role) OVER w, 'start') || '>' || role AS step, length({_escaped()}) AS inside,
  CASE role WHEN 'system' THEN length('<s><<SYS>>' || '<</SYS>>') WHEN 'user' THEN length('[INST] ' || ' [/INST]')
    WHEN 'assistant' THEN length('[ANS] ' || '</s>') ELSE length('[ROLE]' || role || '[/ROLE]' || '[/TURN]') END AS around
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(inside + around)::BIGINT AS formatted_chars,
  bool_and(step IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
    AND last(role ORDER BY turn, role, text) = 'assistant' AS valid
FROM s GROUP BY conv_id"""

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

_FIM = rf"""WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS units, sha256('42:' || doc_id) AS digest FROM documents),
h AS (SELECT doc_id, t, units, len(units) AS n,
  CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
  CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS d FROM u),
f AS (SELECT doc_id, t, n,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 50 THEN 'plain' WHEN d < 80 THEN 'spm' ELSE 'psm' END AS form,
  array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
  array_to_string(units[greatest(a, b) + 1:n], '') AS suffix FROM h)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM f"""

_WORD = r"[^\x20\x09-\x0D]+"

_AUDIT = rf"""WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
m AS (SELECT part, CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
  + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) AS INT)
  + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY text) AS INT) AS mask,
  coalesce(quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic FROM t LEFT JOIN labels l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS earlier FROM o, range(1, 6) AS r(step)),
x AS (SELECT part, filter_order, step, mask, bit, n, good, toxic, mask & bit > 0 AS fails, mask & earlier > 0 AS before FROM c, s)
SELECT part, filter_order, step::INT AS step, coalesce(sum(n) FILTER (NOT fails AND NOT before), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (fails AND NOT before), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fails AND before), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (fails AND NOT before), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (fails AND NOT before), 0)::BIGINT AS toxic_lost,
  sum(coalesce(sum(n) FILTER (fails AND NOT before), 0)) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM x GROUP BY part, filter_order, step, bit"""

ORACLES: dict[str, str] = {"op7_chat_format": _CHATS, "op12_fim_frames": _FIM, "op13_filter_audit": _AUDIT}
