"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from apptlake.llm.licenses import TEMPLATES, THRESHOLD
from apptlake.llm.quality_rules import BLANK_PARTED, BOILERPLATE, SENTENCE_ENDS, SYMBOLS

_PHRASES = " OR ".join(f"contains(lower(x), '{phrase}')" for phrase in BOILERPLATE)
_SYMBOLS = "".join("\\" + c if c in "*$|" else c for c in SYMBOLS)
_SPACES = "[ \\t-\\r]"

_TEMPLATES = ", ".join(
    "('{}', '{}')".format(name, text.replace("'", "''"))
    for name, texts in TEMPLATES.items()
    for text in texts
)
_BIGRAMS = "list_distinct(list_transform(range(1, len({0})), lambda k: {0}[k] || ' ' || {0}[k + 1]))"
_WORDS = "list_transform(regexp_extract_all({}, '[A-Za-z0-9]+'), lambda w: lower(w))"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = {
    "op11_suffix_arrays": f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {_ITEM_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item, least(len(w), 10) AS size, s AS pos, w[s:s + least(len(w), 10) - 1] AS words
  FROM i, unnest(range(1, greatest(1, len(w) - 8))) AS r(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT doc_id, size, pos, w[pos:pos + size - 1] AS words
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS r(pos)),
met AS (SELECT DISTINCT doc_id, s.pos, s.size, item FROM spots s JOIN windows v USING (size, words)),
hit AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM met, unnest(range(size)) AS r(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id),
pairs AS (SELECT DISTINCT doc_id, item, s.pos, v.pos AS item_pos, s.size
          FROM spots s JOIN windows v USING (size, words)),
chains AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item, pos - item_pos ORDER BY pos) - pos AS chain FROM pairs),
lengths AS (SELECT doc_id, max(size) + count(*) - 1 AS words FROM chains GROUP BY doc_id, item, pos - item_pos, chain),
longest AS (SELECT doc_id, max(words) AS n FROM lengths GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
  coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AS contaminated, coalesce(longest.n, 0)::BIGINT AS longest
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)""",
    "op13_collocations": f"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, {_LOWERED} AS t FROM documents),
pieces AS (
  SELECT lang, doc_id, k, regexp_extract_all(p[k], '[^ \\t]+') AS w
  FROM (SELECT lang, doc_id, string_split_regex(t, '[.,;:!?\\x0A-\\x0D]') AS p FROM d),
    unnest(range(1, len(p) + 1)) AS r(k)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, w[s:s + size - 1] AS words, count(*) AS a
  FROM pieces, unnest([1, 2, 3, 4]) AS z(size), unnest(range(1, len(w) - size + 2)) AS r(s)
  GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.words, c.a, k, l.a AS l, r.a AS r, (2000000 * c.a::HUGEINT) // (l.a + r.a) AS score
  FROM (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM f WHERE len(words) > 1) c
  JOIN f l ON l.lang = c.lang AND l.words = c.words[:k]
  JOIN f r ON r.lang = c.lang AND r.words = c.words[k + 1:]),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
covered AS (
  SELECT DISTINCT c.lang, c.words
  FROM (SELECT lang, a, words[s:s + size - 1] AS part
        FROM f, unnest([2, 3]) AS z(size), unnest(range(1, len(words) - size + 2)) AS r(s)
        WHERE len(words) > size) b
  JOIN f c ON c.lang = b.lang AND c.words = b.part WHERE 100 * b.a >= 80 * c.a),
ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score::BIGINT AS score
  FROM lowest ANTI JOIN covered USING (lang, words)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, rank, phrase, a, l, r, n, score FROM numbered JOIN totals USING (lang) WHERE rank <= 2000""",
    "op10_license_scan": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT doc_id, k - 1 AS n, l[k] AS line, len(l) AS many
  FROM (SELECT doc_id, string_split(t, chr(10)) AS l FROM d), unnest(range(1, len(l) + 1)) AS r(k)),
sentences AS (
  SELECT doc_id, n, k, parts[k] AS s
  FROM (SELECT doc_id, n, line,
          string_split(regexp_replace(line, '([.!?]) +', '\\1' || chr(10), 'g'), chr(10)) AS parts
        FROM lines), unnest(range(1, len(parts) + 1)) AS r(k)
  WHERE len(parts) > 1),
blocks AS (
  SELECT doc_id, k - 1 AS n, b[k] AS block
  FROM (SELECT doc_id, string_split_regex(t, '\\n[ \\t\\r]*\\n') AS b FROM d),
    unnest(range(1, len(b) + 1)) AS r(k)
  WHERE len(b) > 1),
units AS (
  SELECT doc_id, 0 AS level, 'text' AS unit, 0 AS n, 0 AS k, t AS u FROM d
  UNION ALL SELECT doc_id, 1, 'block', n, 0, block FROM blocks
  UNION ALL SELECT doc_id, 2, 'line', n, 0, line FROM lines WHERE many > 1
  UNION ALL SELECT doc_id, 3, 'sentence', n, k, s FROM sentences),
words AS (SELECT * EXCLUDE (u), {_WORDS.format("u")} AS w FROM units),
pairs AS (SELECT * EXCLUDE (w), {_BIGRAMS.format("w")} AS b FROM words WHERE len(w) BETWEEN 2 AND 2000),
names AS (SELECT name AS license, {_WORDS.format("body")} AS w FROM (VALUES {_TEMPLATES}) v(name, body)),
templates AS (SELECT license, {_BIGRAMS.format("w")} AS b FROM names),
matched AS (
  SELECT doc_id, level, unit, n, k, license,
    2 * len(list_intersect(p.b, t.b)) / (len(p.b) + len(t.b)) AS dice,
    200 * len(list_intersect(p.b, t.b)) >= {THRESHOLD} * (len(p.b) + len(t.b)) AS enough
  FROM pairs p JOIN templates t
    ON len(p.b) * {THRESHOLD} <= len(t.b) * {200 - THRESHOLD}
    AND len(t.b) * {THRESHOLD} <= len(p.b) * {200 - THRESHOLD}),
best AS (
  SELECT * FROM matched WHERE enough
  QUALIFY row_number() OVER (PARTITION BY doc_id, level, n, k ORDER BY dice DESC, license) = 1)
SELECT doc_id, license, dice, unit, n::INTEGER AS position FROM best
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, level, n, k) = 1""",
    "op7_line_first": f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}+'), lambda x: x <> '') AS w,
    string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
f AS (
  SELECT *, list_filter(l, lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS filled,
    list_filter(l, lambda x: NOT regexp_matches(x, '[^ \\t-\\r]') OR (
      regexp_matches(x, '[.!?{SENTENCE_ENDS}{BLANK_PARTED}]')
      AND 100 * len(regexp_extract_all(x, '[{_SYMBOLS}]')) <= 10 * length(x)
      AND 200 * len(regexp_extract_all(x, '!!')) <= 30 * length(x)
      AND len(regexp_extract_all(x, '\\|')) <= 2
      AND NOT ({_PHRASES}))) AS good
  FROM d),
windows AS (SELECT doc_id, i, w[i:i + 4] AS words FROM d, unnest(range(1, len(w) - 3)) AS r(i)),
twice AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS s(k) GROUP BY doc_id),
m AS (
  SELECT f.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{_SPACES}', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[{_SYMBOLS}]'))::BIGINT AS n_symbols,
    (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines, len(good)::BIGINT AS n_lines_kept,
    length(t) AS chars, length(coalesce(array_to_string(good, chr(10)), '')) AS chars_left
  FROM f LEFT JOIN repeated USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_lines_kept,
  base_failed, NOT base_failed AND 100 * chars_left >= 50 * chars AS kept
FROM b""",
}
