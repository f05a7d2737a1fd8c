"""DuckDB SQL for the operators that SQL can express, on the given tables."""

from __future__ import annotations

from sluicebox.llm import decontamination, removal, repeats, rules, secrets

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ITEM_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, h, unnest(range(length(h) // 2 - {repeats.LENGTH - 1})) AS p FROM d),
named AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, {2 * repeats.LENGTH})) AS m FROM windows),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY m) AS n FROM named) WHERE n > 1),
steps AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM twice),
runs AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + {repeats.LENGTH} THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + {repeats.LENGTH} AS b FROM runs GROUP BY doc_id, run),
placed AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans),
cut AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed, max(b) AS last FROM spans GROUP BY doc_id),
pieces AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head FROM placed JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN pieces USING (doc_id)
"""

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, {_SPACE_WORDS.format("text")} AS ws FROM d),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {rules.WINDOW - 2})) AS i FROM w),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i+{rules.WINDOW - 1}]) AS n FROM places),
again AS (SELECT doc_id, CAST(count(DISTINCT k) AS BIGINT) AS n_repeat_words
          FROM (SELECT doc_id, unnest(range(i, i + {rules.WINDOW})) AS k FROM counted WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
each AS (SELECT doc_id, unnest(list_distinct(ls)) AS line FROM lines),
kept AS (SELECT doc_id, count(*) AS n, count(*) FILTER (right(rtrim(line, ' '), 1) IN ('.', '!', '?', '"', '”', '»', ')')) AS prose,
                CAST(sum(len({_SPACE_WORDS.format("line")})) AS BIGINT) AS words
         FROM each
         WHERE len(regexp_extract_all(line, '{rules.SEPARATORS}')) < 2 AND regexp_matches(line, '\p{{L}}')
           AND NOT (length(line) < {rules.MAX_FURNITURE_CHARS} AND regexp_matches(lower(line), '{rules.BOILERPLATE}'))
           AND 100 * len(regexp_extract_all(line, '{rules.SYMBOLS}')) <= {rules.MAX_SYMBOL_PERCENT} * length(line)
           AND 100 * len(regexp_extract_all(line, '[0-9]')) <= {rules.MAX_DIGIT_PERCENT} * length(line)
         GROUP BY doc_id),
figures AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(ws) < {rules.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {rules.MAX_REPEAT_PERCENT} * len(ws) AS base_failed,
         coalesce(n, 0) AS n, coalesce(prose, 0) AS prose, coalesce(words, 0) AS n_kept_words
  FROM d JOIN w USING (doc_id) JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN kept USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_kept_words,
       NOT base_failed AND 100 * (n_words - n_kept_words) <= {rules.MAX_LOST_PERCENT} * n_words
       AND (n < {rules.PROSE_LINES} OR 100 * prose >= {rules.MIN_PROSE_PERCENT} * n) AS kept
FROM figures
"""

OP3 = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS name, {_ITEM_WORDS.format(_LOWER)} AS ws FROM benchmark),
windows AS (SELECT name, least(len(ws), {decontamination.WINDOW}) AS k, ws, unnest(range(1, len(ws) - least(len(ws), {decontamination.WINDOW}) + 2)) AS p
            FROM i WHERE len(ws) > 0),
known AS (SELECT DISTINCT name, k, array_to_string(ws[p:p+k-1], ' ') AS s FROM windows),
d AS (SELECT doc_id, {_ITEM_WORDS.format(_LOWER)} AS ws FROM documents),
places AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM known)),
found AS (SELECT doc_id, p, k, name FROM (SELECT doc_id, p, k, array_to_string(ws[p:p+k-1], ' ') AS s FROM places) JOIN known USING (k, s)),
hits AS (SELECT doc_id, CAST(count(DISTINCT q) AS BIGINT) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {decontamination.SHARE} * n_hit >= len(ws) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACE_WORDS.format(_LOWER)} AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS i FROM w WHERE len(ws) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(x, y) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM w LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""


def _found(rule: secrets.Rule, place: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, size, judged,
       CAST(list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[:i-1], lambda x: length(x))), 0) AS BIGINT) AS a
FROM (SELECT doc_id, found, gaps, unnest(range(1, len(found) + 1)) AS i, unnest(list_transform(found, lambda x: length(x))) AS size,
             unnest(list_transform(regexp_extract_all(text, '{pattern}', {rule.group}), lambda x: length(x))) AS judged
      FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps
            FROM documents WHERE regexp_matches(text, '{pattern}')))
WHERE judged >= {rule.least}"""


_SPANS = "coalesce(string_agg(kind || ':' || a || ':' || (a + size), ',' ORDER BY a, place) FILTER ({}), '')"

OP11 = f"""
WITH found AS ({" UNION ALL ".join(_found(rule, k) for k, rule in enumerate(secrets.RULES))})
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in secrets.BASE)},
       sha256({_SPANS.format(f"place < {len(secrets.BASE)}")}) AS base_sha256, {_SPANS.format("place >= 0")} AS spans
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""

OP12 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_SPACE_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS bad FROM labels GROUP BY doc_id),
fails AS (SELECT part, len(ws) < {removal.MIN_WORDS} AS a, 100 * len(list_distinct(ws)) < {removal.MIN_DISTINCT_PERCENT} * len(ws) AS b,
                 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {removal.MAX_CAPITAL_PERCENT} * length(t) AS c,
                 regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS e,
                 coalesce(good, FALSE) AS good, coalesce(bad, FALSE) AS bad
          FROM d LEFT JOIN marks USING (doc_id)),
masks AS (SELECT part, good, bad, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
                 || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS mask, count(*) AS n FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT p.f || q.f || r.f || s.f || t.f AS o FROM letters p, letters q, letters r, letters s, letters t
           WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
leaves AS (SELECT m.*, o, CASE WHEN mask <> '' THEN list_min(list_transform(string_split(mask, ''), lambda f: instr(o, f))) END AS leave FROM masks m, orders),
table_ AS (SELECT part, o, CAST(step AS INTEGER) AS step, substr(o, step, 1) AS f,
                  CAST(sum(n) FILTER (leave IS NULL OR leave > step) AS BIGINT) AS kept, CAST(sum(n) FILTER (leave = step) AS BIGINT) AS removed,
                  CAST(sum(n) FILTER (leave < step AND contains(mask, substr(o, step, 1))) AS BIGINT) AS redundant,
                  CAST(sum(n) FILTER (mask = substr(o, step, 1)) AS BIGINT) AS alone,
                  CAST(sum(n) FILTER (leave = step AND good) AS BIGINT) AS good_lost, CAST(sum(n) FILTER (leave = step AND bad) AS BIGINT) AS toxic_lost
           FROM leaves, range(1, 6) AS r(step) GROUP BY ALL)
SELECT part, o AS filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
       coalesce(alone, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM table_
"""

_NONE = 1_000_000_000_000


def _longer(value: str, cost: str, letter: str, line: str) -> str:
    return f"{{'c': {value}.c + {cost}, 'a': {value}.a || '{letter}', 'r': {value}.r || {line}}}"


def _insert(value: str, role: str) -> str:
    return _longer(value, "5", "I", f"'{role}:' || chr(10)")


#: The best (cost, audit, repaired text) per state, with inserts in front of the next row.
_OPEN = f"""[v[1], v[2], list_min([v[3], {_insert("v[1]", "user")}, {_insert("v[2]", "user")}, {_insert("v[4]", "user")}]),
             list_min([v[4], {_insert("v[3]", "assistant")}, {_insert(_insert("v[1]", "user"), "assistant")}, {_insert(_insert("v[2]", "user"), "assistant")}])]"""


def _edit(value: str, kind: str) -> str:
    if kind == "D":
        return _longer(value, "2", "D", "''")
    own, role = ("role", f"CASE WHEN initial = '{kind[1]}' THEN stay ELSE {_NONE} END") if kind[0] == "K" else (f"'{kind[1:]}'", "stay + 1")
    return _longer(value, role, kind[0], f"{own} || ':' || text || chr(10)")


_READ = f"""[{_edit("w[1]", "D")}, list_min([{_edit("w[2]", "D")}, {_edit("w[1]", "Ks")}]),
  list_min([{_edit("w[3]", "D")}, {", ".join(_edit(f"w[{k}]", kind) for k in (1, 2, 4) for kind in ("Ku", "Ruser"))}]),
  list_min([{_edit("w[4]", "D")}, {_edit("w[3]", "Ka")}, {_edit("w[3]", "Rassistant")}])]"""

OP13 = rf"""
WITH RECURSIVE bits AS (SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
                        FROM range(256) AS r(i)),
known AS (SELECT list(t ORDER BY i) AS t FROM bits),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
drawn AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                 lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 20 AS harm FROM named, known),
harmed AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
                  CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                  unnest(range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn),
placed AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
                  lag(role) OVER w AS before, left(role, 1) AS initial, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS ending
           FROM harmed WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (SELECT *, ending = '' AS blank, ending <> '' AND again AS twice, ending NOT IN ('', '.', '!', '?') AND NOT again AS short FROM placed),
rows_ AS (SELECT *, CASE WHEN blank OR twice THEN {_NONE} WHEN short THEN 5 ELSE 0 END AS stay FROM judged),
counted AS (SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (blank) AS blank,
                   count(*) FILTER (twice) AS duplicate, count(*) FILTER (short) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND left(before, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id),
ways AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, [{{'c': CAST(0 AS BIGINT), 'a': '', 'r': ''}}, {", ".join([f"{{'c': CAST({_NONE} AS BIGINT), 'a': '', 'r': ''}}"] * 3)}] AS v FROM conversations
         UNION ALL
         SELECT conv_id, i, {_READ} FROM (SELECT s.conv_id, r.i, role, text, initial, stay, {_OPEN} AS w
                                          FROM ways s JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1)),
ends AS (SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
                coalesce(illegal, 0) AS illegal, list_min([w[1], w[4]]) AS best
         FROM (SELECT conv_id, i, {_OPEN} AS w FROM ways) w LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE i = coalesce(n, 0))
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, best.c AS cost, best.a AS audit, sha256(best.r[:-2]) AS repaired_sha256 FROM ends
"""

SQL = {
    "op1_suffix_dedup": OP1,
    "op2_quality_rules": OP2,
    "op3_decontamination": OP3,
    "op5_jaccard_join": OP5,
    "op11_secret_scan": OP11,
    "op12_filter_audit": OP12,
    "op13_conversation_repair": OP13,
}
