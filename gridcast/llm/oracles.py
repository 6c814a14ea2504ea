"""DuckDB SQL of the conversation, manifest and decontamination queries."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32(text: str) -> str:
    """CRC-32 of ASCII ``text``: eight shifts for each byte."""
    shift = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {shift}), 4294967295::BIGINT)"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _inserted(state: str, *roles: str) -> str:
    lines = ", ".join(f"'{r}:'" for r in roles)
    return f"{{'c': {state}.c + {2 * len(roles)}, 'a': '{'I' * len(roles)}' || {state}.a, 't': list_concat([{lines}], {state}.t)}}"


def _edits(q: int) -> str:
    """The cheapest way from a row in state ``q``: f0 to f3 are the ways after it."""
    step = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}][q]
    forced, role = [("u", "user"), ("u", "user"), ("a", "assistant"), ("u", "user")][q]
    options = [f"{{'c': f{q}.c + 3, 'a': 'D' || f{q}.a, 't': f{q}.t}}"]
    for initial, to in step.items():
        options.append(f"CASE WHEN NOT gone AND role[1] = '{initial}' THEN {{'c': f{to}.c + cut, 'a': 'K' || f{to}.a, 't': list_prepend(role || ':' || text, f{to}.t)}} END")
    to = step[forced]
    options.append(f"CASE WHEN NOT gone THEN {{'c': f{to}.c + 2 + cut, 'a': 'R' || f{to}.a, 't': list_prepend('{role}:' || text, f{to}.t)}} END")
    return _least(*options)


OP11 = rf"""
WITH RECURSIVE h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS harm
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE harm <> 0
), r AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, lag(role[1]) OVER w || role[1] AS pair,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)
), g AS (
  SELECT *, ending = '' OR again AS gone, CASE WHEN ending <> '' AND NOT again AND ending NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut FROM r
), s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (ending = '') AS blank,
         count(*) FILTER (ending <> '' AND again) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n
  FROM g GROUP BY conv_id
), p AS (
  SELECT conv_id, n AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS f0, {{'c': 4, 'a': 'II', 't': ['user:', 'assistant:']}} AS f1,
         {{'c': 2, 'a': 'I', 't': ['assistant:']}} AS f2, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS f3
  FROM s
  UNION ALL
  SELECT conv_id, i, {_least('g0', _inserted('g2', 'user'), _inserted('g3', 'user', 'assistant'))},
         {_least('g1', _inserted('g2', 'user'), _inserted('g3', 'user', 'assistant'))},
         {_least('g2', _inserted('g3', 'assistant'))}, {_least('g3', _inserted('g2', 'user'))}
  FROM (
    SELECT p.conv_id, p.i - 1 AS i, {_edits(0)} AS g0, {_edits(1)} AS g1, {_edits(2)} AS g2, {_edits(3)} AS g3
    FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.i = p.i
  )
), o AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
       coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, CAST(coalesce(p.f0.c, 0) AS BIGINT) AS cost,
       coalesce(p.f0.a, '') AS audit, sha256(coalesce(array_to_string(p.f0.t, chr(10)), '')) AS repaired_sha256
FROM o LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM o.conv_id AND p.i = 0
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP12 = f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT doc_id, lang, {_leaf('text')} AS leaf,
           {_leaf(f"(CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END)")} AS now
    FROM documents
  )
), t AS (
  SELECT lang, 0 AS lev, r, n, leaf AS h FROM d
  UNION ALL
  SELECT lang, lev + 1, r // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY r)) FROM t WHERE n > 1 GROUP BY lang, lev, n, r // 8
), s AS (
  SELECT lang, h AS subroot, lev AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM t WHERE n = 1
), u AS (
  SELECT 0 AS lev, r, n, subroot AS h FROM s
  UNION ALL
  SELECT lev + 1, r // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY r)) FROM u WHERE n > 1 GROUP BY lev, n, r // 8
), lower_steps AS (
  SELECT d.lang, d.r, t.lev AS step, coalesce(string_agg(h, '' ORDER BY t.r) FILTER (t.r < d.r // (8 ** t.lev)::BIGINT), '') AS l,
         coalesce(string_agg(h, '' ORDER BY t.r) FILTER (t.r > d.r // (8 ** t.lev)::BIGINT), '') AS g
  FROM d JOIN t ON t.lang IS NOT DISTINCT FROM d.lang AND t.n > 1 AND t.r // 8 = (d.r // (8 ** t.lev)::BIGINT) // 8
  GROUP BY d.lang, d.r, t.lev
), upper_steps AS (
  SELECT s.lang, s.height + u.lev AS step, coalesce(string_agg(h, '' ORDER BY u.r) FILTER (u.r < s.r // (8 ** u.lev)::BIGINT), '') AS l,
         coalesce(string_agg(h, '' ORDER BY u.r) FILTER (u.r > s.r // (8 ** u.lev)::BIGINT), '') AS g
  FROM s JOIN u ON u.n > 1 AND u.r // 8 = (s.r // (8 ** u.lev)::BIGINT) // 8
  GROUP BY s.lang, s.height, u.lev
), steps AS (
  SELECT lang, r, step, l, g FROM lower_steps
  UNION ALL SELECT d.lang, d.r, x.step, x.l, x.g FROM d JOIN upper_steps x ON x.lang IS NOT DISTINCT FROM d.lang
), f AS (
  SELECT lang, r, 0 AS step, now AS h FROM d
  UNION ALL
  SELECT f.lang, f.r, f.step + 1, sha256(x.l || f.h || x.g) FROM f JOIN steps x ON x.lang IS NOT DISTINCT FROM f.lang AND x.r = f.r AND x.step = f.step
), e AS (
  SELECT lang, r, arg_max(h, step) AS folded_root FROM f GROUP BY lang, r
), p AS (
  SELECT lang, r, string_agg(l || g, '' ORDER BY step) AS proof FROM steps GROUP BY lang, r
), z AS (SELECT h AS root FROM u WHERE n = 1)
SELECT d.doc_id, d.leaf, s.subroot, z.root, sha256(coalesce(p.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = z.root AS verified
FROM d CROSS JOIN z JOIN s ON s.lang IS NOT DISTINCT FROM d.lang JOIN e ON e.lang IS NOT DISTINCT FROM d.lang AND e.r = d.r
     LEFT JOIN p ON p.lang IS NOT DISTINCT FROM d.lang AND p.r = d.r
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP13 = f"""
WITH b AS (
  SELECT item_id, ws, least(len(ws), 10) AS n FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0
), w AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM b)
), d AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS ws FROM documents
), v AS (
  SELECT row, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
  FROM (SELECT row, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM w))
), m AS (
  SELECT v.row, v.i, v.n, w.item_id FROM v JOIN w USING (n, gram)
), x AS (
  SELECT row, count(*) AS n_hit FROM (SELECT DISTINCT row, unnest(range(i, i + n)) AS at FROM m) GROUP BY row
), y AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM m WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (row) LEFT JOIN y USING (row)
"""
