"""DuckDB statements for the training-data queries that SQL can express."""

from __future__ import annotations

from zonepace.llm.license_scan import COMMON, THRESHOLD
from zonepace.llm.license_templates import TEMPLATES
from zonepace.llm.quality_rules import BASE, STOP_WORDS, THRESHOLDS


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (
  SELECT *, (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') AS r1,
    (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') AS r2,
    (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') AS r3,
    (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') AS r4,
    (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') AS r5 FROM p),
r AS (
  SELECT *, CASE WHEN r3 THEN 'www.example.com/en/' WHEN r2 THEN 'example.com/en/' WHEN r1 THEN 'com/'
                 WHEN r4 THEN 'net/es/' WHEN r5 THEN 'net/fr/' END AS rule FROM f)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP7 = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (
  SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(t) AS text_sha256
FROM g
"""

_NORM = f"regexp_replace(translate(%s, '{UPPER}', '{LOWER}'), '[^0-9a-z\\n\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')"
_PAIRS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
_GRAMS = f"list_distinct({_PAIRS})"
_VALUES = ",\n    ".join(f"({i}, {_text(a)}, {_text(b)}, {_text(c)})" for i, (a, b, c) in enumerate(TEMPLATES))
OP9 = f"""
WITH t0(t_no, t_id, t_family, t_text) AS (VALUES
    {_VALUES}),
t AS (
  SELECT t_no, t_id, t_family, w, {_GRAMS} AS tg
  FROM (SELECT *, string_split(trim(replace({_NORM % 't_text'}, chr(10), ' ')), ' ') AS w FROM t0)),
n AS (SELECT doc_id, {_NORM % "coalesce(text, '')"} AS norm FROM documents),
l AS (
  SELECT doc_id, 0 AS kind, unnest(range(0, len(string_split(norm, chr(10))))) AS place, unnest(string_split(norm, chr(10))) AS line FROM n
  UNION ALL
  SELECT doc_id, 1, unnest(range(0, len(p))), unnest(p) FROM (SELECT doc_id, string_split_regex(norm, '\\n ?\\n[ \\n]*') AS p FROM n)
  UNION ALL
  SELECT doc_id, 2, 0, norm FROM n),
u AS (
  SELECT doc_id, kind, place, string_split(trim(regexp_replace(replace(line, chr(10), ' '), ' +', ' ', 'g')), ' ') AS w
  FROM l WHERE kind = 0 OR contains(line, chr(10))),
g AS (SELECT doc_id, kind, place, {_GRAMS} AS ug FROM u),
h AS (
  SELECT doc_id, kind, place, t_no, round(2.0 * len(list_intersect(ug, tg))::DOUBLE / (len(ug) + len(tg)), 9) AS dice
  FROM g, t WHERE len(ug) > 0 AND 2.0 * least(len(ug), len(tg)) / (len(ug) + len(tg)) >= {THRESHOLD} - 1e-9),
a AS (
  SELECT t_no, anchor FROM (
    SELECT t_no, anchor, row_number() OVER (PARTITION BY t_no ORDER BY list_has_any(string_split(anchor, ' '), {COMMON}), length(anchor) DESC, anchor) AS rn, count(*) OVER (PARTITION BY t_no) AS c
    FROM (SELECT t_no, unnest(tg) AS anchor FROM t))
  WHERE rn <= c - ceil(c * {THRESHOLD} / (2 - {THRESHOLD}) - 1e-9) + 1),
o AS (
  SELECT t_no, anchor, o FROM (SELECT t_no, o, w[o] || ' ' || w[o + 1] AS anchor FROM (SELECT t_no, w, unnest(range(1, len(w))) AS o FROM t))
  JOIN a USING (t_no, anchor)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
c AS (
  SELECT DISTINCT doc_id, t_no, p - o AS place
  FROM (SELECT doc_id, unnest(range(1, len(w))) AS p, unnest({_PAIRS}) AS anchor FROM d WHERE len(w) > 1) JOIN o USING (anchor)),
y AS (
  SELECT doc_id, t_no, place, {_GRAMS} AS ug
  FROM (SELECT c.*, list_slice(d.w, greatest(place, 0) + 1, place + len(t.w)) AS w FROM c JOIN d USING (doc_id) JOIN t USING (t_no))),
k AS (
  SELECT * FROM h WHERE dice >= {THRESHOLD}
  UNION ALL
  SELECT * FROM (SELECT doc_id, 3, place, t_no, round(2.0 * len(list_intersect(ug, tg))::DOUBLE / (len(ug) + len(tg)), 9) AS dice
                 FROM y JOIN t USING (t_no)) WHERE dice >= {THRESHOLD}),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, length(t_text) DESC, t_no, kind, place) AS rn FROM k JOIN t0 USING (t_no)),
s AS (SELECT doc_id, string_agg(DISTINCT t_id, ',' ORDER BY t_id) AS licenses, count(*) AS n_hits FROM k JOIN t USING (t_no) GROUP BY doc_id)
SELECT d.doc_id, t.t_id AS license, t.t_family AS family, b.dice AS dice,
       CASE b.kind WHEN 0 THEN 'line' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'text' WHEN 3 THEN 'window' END AS unit,
       CAST(b.place AS INTEGER) AS place, coalesce(s.licenses, '') AS licenses, CAST(coalesce(s.n_hits, 0) AS BIGINT) AS n_hits
FROM documents d LEFT JOIN b ON b.doc_id = d.doc_id AND b.rn = 1 LEFT JOIN t ON t.t_no = b.t_no LEFT JOIN s ON s.doc_id = d.doc_id
"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
OP8 = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM d, (SELECT DISTINCT size FROM iw) s WHERE len(w) >= size)),
m AS (SELECT doc_id, p, size, item_id FROM dw JOIN iw USING (size, gram)),
h AS (SELECT doc_id, count(DISTINCT word) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + size)) AS word FROM (SELECT DISTINCT doc_id, p, size FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

# ---- op11: damage by CRC-32 computed in SQL, then one recursive step per row over the four states ----

def _add(value: str, cost: str, letter: str) -> str:
    return f"{{'c': {value}.c + {cost}, 'a': {value}.a || '{letter}'}}"


_NONE = "{'c': 1000000000, 'a': ''}"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SAID = "CASE WHEN truncated THEN 5 ELSE 0 END"
_KEEP = lambda value, initial: f"CASE WHEN NOT forced AND initial = '{initial}' THEN {_add(value, _SAID, 'K')} ELSE {_NONE} END"
_STAY = lambda value: f"least({_add(value, '2', 'D')}, {_KEEP(value, '')})"
_NAME = lambda value: f"CASE WHEN NOT forced THEN {_add(value, f'1 + {_SAID}', 'R')} ELSE {_NONE} END"
OP11 = f"""
WITH RECURSIVE
tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
crc AS (
  SELECT src.*, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS UBIGINT))),
                                lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 20 AS kind FROM src, tab),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(0, CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM crc),
num AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn,
         substr(role, 1, 1) AS initial, rtrim(text, {_SPACES}) AS bare FROM hurt),
fault AS (
  SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
         right(bare, 1) NOT IN ('.', '!', '?') AS open_end, lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS pair FROM num),
seq AS (
  SELECT conv_id, turn, rn, role, text, initial, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND open_end AS truncated,
         blank OR again AS forced, pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au') AS illegal FROM fault),
step(conv_id, rn, v0, vs, vu, va) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {{'c': 0, 'a': ''}}, {_NONE}, {{'c': 5, 'a': 'I'}}, {{'c': 10, 'a': 'II'}} FROM conversations
  UNION ALL
  SELECT conv_id, rn, n0, ns, iu, least(na, {_add('iu', '5', 'I')}) FROM (
    SELECT *, least(nu, {_add('n0', '5', 'I')}, {_add('ns', '5', 'I')}, {_add('na', '5', 'I')}) AS iu FROM (
      SELECT q.conv_id, q.rn, {_STAY('v0')} AS n0, least({_STAY('vs')}, {_KEEP('v0', 's')}) AS ns,
             least({_STAY('vu')}, {_NAME('v0')}, {_NAME('vs')}, {_NAME('va')}, {_KEEP('v0', 'u')}, {_KEEP('vs', 'u')}, {_KEEP('va', 'u')}) AS nu,
             least({_STAY('va')}, {_NAME('vu')}, {_KEEP('vu', 'a')}) AS na
      FROM step s JOIN seq q ON q.conv_id IS NOT DISTINCT FROM s.conv_id AND q.rn = s.rn + 1))),
best AS (
  SELECT conv_id, best.c AS cost, best.a AS audit
  FROM (SELECT conv_id, arg_max(least(v0, va), rn) AS best FROM step GROUP BY conv_id)),
letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, len(audit) + 1)) AS pos FROM best WHERE audit <> ''),
placed AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS rn FROM letters),
said AS (
  SELECT p.conv_id, p.pos, p.letter, q.role, q.text, p.letter = 'K' AND q.initial IN ('s', '') AS opening
  FROM placed p LEFT JOIN seq q ON p.letter <> 'I' AND q.conv_id IS NOT DISTINCT FROM p.conv_id AND q.rn = p.rn WHERE p.letter <> 'D'),
roles AS (
  SELECT *, CASE WHEN letter = 'K' THEN role
                 WHEN count(*) FILTER (NOT opening) OVER (PARTITION BY conv_id ORDER BY pos) % 2 = 1 THEN 'user' ELSE 'assistant' END AS said_role FROM said),
whole AS (SELECT conv_id, string_agg(said_role || ':' || coalesce(text, ''), chr(10) ORDER BY pos) AS body FROM roles GROUP BY conv_id),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal FROM seq GROUP BY conv_id)
SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(b.cost AS BIGINT) AS cost, b.audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM best b LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM b.conv_id
"""

OP12 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM o
"""

_IN_TEXT = lambda chars: f"len(text) - len(regexp_replace(text, '[{chars}]', '', 'g'))"
_FAIL = "CASE WHEN {0} THEN '{1}' END"


def _fails(rules: list[tuple]) -> list[str]:
    out = []
    for name, count, per, least, most in rules:
        value, unit = (f"100 * {count}", per) if per else (count, "1")
        tests = ([f"{value} < {least} * {unit}"] if least is not None else []) + ([f"{value} > {most} * {unit}"] if most is not None else [])
        out.append(_FAIL.format(" OR ".join(tests), name))
    return out


OP13 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (
  SELECT doc_id, r, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS gram
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS p FROM w WHERE len(words) >= 3)),
t AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
v AS (SELECT r, count(DISTINCT word) AS c FROM (SELECT r, unnest([p, p + 1, p + 2]) AS word FROM t) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: len(x))), 0) AS word_chars,
         {_IN_TEXT('#*$%&|<>')} AS n_symbols, {_IN_TEXT('!')} AS n_exclaim,
         len(list_filter(words, lambda x: list_contains([{', '.join(_text(x) for x in sorted({f(x) for x in STOP_WORDS for f in (str.lower, str.capitalize)}))}], x))) AS n_stop_words,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣·]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines, coalesce(v.c, 0) AS n_repeat_words
  FROM w LEFT JOIN v USING (r)),
f AS (SELECT *, concat_ws(',', {', '.join(_fails(BASE))}) AS base, concat_ws(',', {', '.join(_fails(THRESHOLDS))}) AS rules FROM m)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_exclaim, n_stop_words, n_lines, n_dup_lines, n_bullet_lines,
       n_ellipsis_lines, n_repeat_words, base <> '' AS base_failed, base = '' AND rules = '' AS kept,
       concat_ws(',', nullif(base, ''), nullif(rules, '')) AS failed
FROM f
"""

ORACLE = {"op1_url_filter": OP1, "op7_exact_dedup": OP7, "op8_decontamination": OP8, "op9_license_scan": OP9,
          "op11_conversation_repair": OP11, "op12_fill_in_middle": OP12, "op13_quality_rules": OP13}
