"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP8_MIXING = r"""
WITH hashed AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 12))::BIGINT AS hash
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM hashed GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS room,
         [1.0, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sizes),
filled AS (
  SELECT *, row_number() OVER (ORDER BY room / weight, source NULLS LAST) AS place,
         sum(source_size) OVER () AS total,
         coalesce(sum(room) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_room,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM weighed),
levelled AS (
  SELECT *, arg_min((total - full_room)::DOUBLE / left_weight, place) FILTER (WHERE (total - full_room)::DOUBLE / left_weight * weight <= room) OVER () AS level
  FROM filled),
targets AS (
  SELECT source, source_size, least(room::DOUBLE, coalesce(level * weight, room::DOUBLE)) AS target,
         CASE WHEN source_size > 0 THEN floor(least(room::DOUBLE, coalesce(level * weight, room::DOUBLE)) / source_size) ELSE 0 END::BIGINT AS copies
  FROM levelled),
values_ AS (SELECT source, hash, sum(size)::BIGINT AS held FROM hashed GROUP BY source, hash),
upto AS (SELECT source, hash, held, sum(held) OVER (PARTITION BY source ORDER BY hash) AS upto FROM values_),
extra AS (
  SELECT u.source, u.hash, u.upto - u.held + u.upto > 2 * (t.target - t.copies * t.source_size) AS beyond
  FROM upto u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source),
ends AS (SELECT source, min(hash) AS threshold FROM extra WHERE beyond GROUP BY source)
SELECT h.doc_id, h.size, t.source_size, t.target,
       (h.size * least(t.copies + CASE WHEN e.threshold IS NULL OR h.hash < e.threshold THEN 1 ELSE 0 END, 3))::BIGINT AS taken
FROM hashed h JOIN targets t ON h.source IS NOT DISTINCT FROM t.source
LEFT JOIN ends e ON h.source IS NOT DISTINCT FROM e.source
"""

OP10_URL_FILTER = r"""
WITH split AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
canon AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
                      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|source)='))) AS params
  FROM split),
keyed AS (
  SELECT *, regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') ||
            regexp_replace(path, '(/|/?index\.html?|\.html?)$', '') ||
            CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical
  FROM canon),
listed AS (SELECT DISTINCT canonical FROM keyed WHERE host <> '' AND substr(md5(canonical), 1, 1) = '0'),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM keyed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP9_QUOTATION_LINKING = r"""
WITH RECURSIVE lines AS (
  SELECT conv_id, turn, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM (SELECT DISTINCT conv_id, turn, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL)),
marked AS (
  SELECT conv_id, turn, text, i, len(regexp_replace(regexp_extract(line, '^\s*((?:>\s?)+)', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^\s*((?:>\s?)+)', '') AS rest
  FROM lines),
stepped AS (
  SELECT *, regexp_matches(rest, '^\s*$') AS blank, lag(level) OVER (PARTITION BY conv_id, turn, text ORDER BY i) AS above FROM marked),
runs AS (
  SELECT conv_id, turn, text, i, level, blank, lower(rest) AS rest,
         count(*) FILTER (WHERE level IS DISTINCT FROM above) OVER w AS passage,
         CASE WHEN level = 0 THEN count(*) FILTER (WHERE blank OR level > 0) OVER w ELSE count(*) FILTER (WHERE blank) OVER w END AS paragraph
  FROM stepped WINDOW w AS (PARTITION BY conv_id, turn, text ORDER BY i)),
units AS (
  SELECT conv_id, turn, text, level, CASE WHEN level > 0 THEN passage ELSE -1 END AS passage, -1 AS paragraph, 3 AS size,
         string_agg(rest, ' ' ORDER BY i) AS words, count(*) AS n FROM runs WHERE NOT blank GROUP BY ALL
  UNION ALL
  SELECT conv_id, turn, text, level, passage, paragraph, 2, string_agg(rest, ' ' ORDER BY i), count(*) FROM runs WHERE NOT blank GROUP BY ALL
  UNION ALL
  SELECT conv_id, turn, text, level, passage, paragraph, 1, rest, 1 FROM runs WHERE NOT blank),
said AS (
  SELECT * REPLACE (trim(regexp_replace(words, '\s+', ' ', 'g')) AS words) FROM units),
owned AS (SELECT DISTINCT conv_id, turn, words FROM said WHERE level = 0),
found AS (
  SELECT q.conv_id, q.turn, q.text, q.level, q.passage, q.paragraph, q.size, q.words, q.n, max(o.turn) AS source
  FROM (SELECT conv_id, turn, text, level, passage, paragraph, size, words, sum(n) AS n FROM said WHERE level > 0 GROUP BY ALL) q
  JOIN owned o ON q.conv_id = o.conv_id AND q.words = o.words AND o.turn < q.turn GROUP BY ALL),
best AS (
  SELECT *, max(size) OVER (PARTITION BY conv_id, turn, text, passage) AS in_passage,
         max(size) OVER (PARTITION BY conv_id, turn, text, passage, paragraph) AS in_paragraph
  FROM found),
votes AS (
  SELECT conv_id, turn, level, source, sum(n) AS n FROM best
  WHERE size = CASE WHEN in_passage = 3 THEN 3 ELSE in_paragraph END GROUP BY ALL),
parents AS (SELECT conv_id, turn, arg_max(source, (-level, n, source)) AS reply_to FROM votes GROUP BY ALL),
walk AS (
  SELECT conv_id, turn, reply_to, reply_to AS thread_root, 1::BIGINT AS depth FROM parents
  UNION ALL
  SELECT w.conv_id, w.turn, w.reply_to, p.reply_to, w.depth + 1
  FROM walk w JOIN parents p ON w.conv_id = p.conv_id AND w.thread_root = p.turn),
placed AS (SELECT conv_id, turn, reply_to, arg_max(thread_root, depth) AS thread_root, max(depth) AS depth FROM walk GROUP BY ALL),
listed AS (
  SELECT *, string_split(text, chr(10)) AS ls FROM conversations),
cleaned AS (
  SELECT *, coalesce(len(list_filter(ls, lambda x: regexp_matches(x, '^\s*>'))), 0)::BIGINT AS quoted_lines,
         CASE WHEN len(list_filter(ls, lambda x: regexp_matches(x, '^\s*>'))) > 0 THEN
           trim(array_to_string(list_filter(ls, lambda x, i: NOT regexp_matches(x, '^\s*>') AND NOT (
             regexp_matches(x, '(?i)^(on|am|le|el)\b.*\b(wrote|schrieb|écrit|escribió)\b.*:\s*$') AND regexp_matches(coalesce(ls[i + 1], ''), '^\s*>'))), chr(10)))
         ELSE text END AS clean_text
  FROM listed),
rows_ AS (
  SELECT c.conv_id, c.turn, c.role, p.reply_to, coalesce(p.thread_root, c.turn) AS thread_root, coalesce(p.depth, 0)::BIGINT AS depth,
         c.quoted_lines, c.clean_text, '<|' || coalesce(c.role, 'unknown') || '|>' || chr(10) || coalesce(c.clean_text, '') || chr(10) || '<|end|>' AS chat
  FROM cleaned c LEFT JOIN placed p ON c.conv_id = p.conv_id AND c.turn = p.turn),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY thread_root, turn) - 1) // 1024 AS part
  FROM rows_ WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
assembled AS (
  SELECT conv_id, part::BIGINT AS part, arg_min(turn, (thread_root, turn)) AS first_turn, string_agg(chat, chr(10) ORDER BY thread_root, turn) AS conversation
  FROM numbered GROUP BY ALL)
SELECT 'message' AS kind, *, NULL::BIGINT AS part FROM rows_
UNION ALL SELECT 'conversation', conv_id, first_turn, NULL, NULL, NULL, NULL, NULL, NULL, conversation, part FROM assembled
"""


OP12_LEXICAL_SEARCH = r"""
WITH rows_ AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
tokens AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM rows_ WHERE text IS NOT NULL),
tfs AS (SELECT d, doc_id, term, count(*)::BIGINT AS tf FROM tokens GROUP BY ALL),
sizes AS (SELECT d, sum(tf)::BIGINT AS n FROM tfs GROUP BY d),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs CROSS JOIN totals GROUP BY term),
items AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
wanted AS (
  SELECT i, item_id, term, count(*)::BIGINT AS repeats
  FROM (SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items)
  GROUP BY ALL),
lengths AS (SELECT d, 100 - 25 + ((25 * n * docs) // terms) AS m FROM sizes CROSS JOIN totals),
scores AS (
  SELECT i, item_id, d, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (d) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {"op8_mixing": OP8_MIXING, "op9_quotation_linking": OP9_QUOTATION_LINKING, "op10_url_filter": OP10_URL_FILTER, "op12_lexical_search": OP12_LEXICAL_SEARCH}
