"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_distinct(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) END AS s
  FROM words
), classes AS (SELECT min(doc_id) AS doc, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), shingles AS (SELECT doc, len(s) AS n, unnest(s) AS x FROM classes
), pairs AS (
  SELECT a.doc AS a, b.doc AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc < b.doc
   AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc, b.doc, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
  UNION SELECT t.doc_id, c.doc FROM sets t JOIN classes c ON list_sort(t.s) = c.s
  UNION SELECT c.doc, t.doc_id FROM sets t JOIN classes c ON list_sort(t.s) = c.s
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
), least_of AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles, l.component_id, t.doc_id = l.component_id AS kept
FROM sets t JOIN least_of l ON l.doc_id = t.doc_id
"""

OP2 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM lines
), ended AS (
  SELECT *, coalesce(r < lag(r) OVER w AND r <= lead(r) OVER w, false) AS ends
  FROM (SELECT *, (7 * h + 3 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 1000003 AS r FROM hashed)
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM ended
), chunks AS (
  SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n FROM numbered GROUP BY doc_id, place
), ranked AS (
  SELECT *, n > 1 AND row_number() OVER (PARTITION BY chunk, n > 1 ORDER BY doc_id, place) > 1 AS removed FROM chunks
), kept AS (
  SELECT doc_id, count(*) AS n_chunks, sum(CAST(removed AS INT)) AS n_removed,
         coalesce(string_agg(chunk, chr(10) ORDER BY place) FILTER (WHERE NOT removed), '') AS text
  FROM ranked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(k.n_chunks, 0) AS BIGINT) AS n_chunks, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(length(k.text) AS BIGINT) AS n_kept_chars, md5(k.text) AS kept_md5
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

OP5 = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length('<s>' || replace(replace(replace(replace(role, '\', '\\'), '<', '<\'), '[', '[\'), chr(10), '[n') || chr(10)
         || replace(replace(replace(text, '\', '\\'), '<', '<\'), '[', '[\') || '</s>' || chr(10)) AS seg,
         len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\x09-\x0D\x20]')) + 4 AS tokens,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos
  FROM turns
), headed AS (
  SELECT *, pos = 1 AND role = 'system' AS is_head,
         max(CASE WHEN pos = 1 AND role = 'system' THEN seg END) OVER (PARTITION BY conv_id) AS head_seg,
         coalesce(max(CASE WHEN pos = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS head_tokens
  FROM sized
), lagged AS (
  SELECT *, CASE WHEN pos > 1 AND head_tokens + tokens <= 1024 THEN head_tokens ELSE 0 END AS b0,
         CASE WHEN NOT lag(is_head) OVER w THEN lag(seg) OVER w END AS seg_1, CASE WHEN NOT lag(is_head) OVER w THEN lag(tokens) OVER w END AS tokens_1,
         CASE WHEN NOT lag(is_head, 2) OVER w THEN lag(seg, 2) OVER w END AS seg_2, CASE WHEN NOT lag(is_head, 2) OVER w THEN lag(tokens, 2) OVER w END AS tokens_2
  FROM headed WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), one_back AS (SELECT *, coalesce(tokens_1 <= 256 AND b0 + tokens_1 + tokens <= 1024, false) AS use_1 FROM lagged
), two_back AS (SELECT *, use_1 AND coalesce(tokens_1 + tokens_2 <= 256 AND b0 + tokens_1 + tokens_2 + tokens <= 1024, false) AS use_2 FROM one_back
), based AS (
  SELECT conv_id, pos, seg, tokens, b0 + CASE WHEN use_1 THEN tokens_1 ELSE 0 END + CASE WHEN use_2 THEN tokens_2 ELSE 0 END AS base,
         CASE WHEN b0 > 0 THEN head_seg ELSE 0 END + CASE WHEN use_1 THEN seg_1 ELSE 0 END + CASE WHEN use_2 THEN seg_2 ELSE 0 END AS repeated
  FROM two_back
), walk AS (
  SELECT conv_id, pos, seg, tokens AS used, CAST(0 AS BIGINT) AS again FROM based WHERE pos = 1
  UNION ALL
  SELECT b.conv_id, b.pos, b.seg, CASE WHEN w.used + b.tokens <= 1024 THEN w.used + b.tokens ELSE b.base + b.tokens END,
         CASE WHEN w.used + b.tokens <= 1024 THEN 0 ELSE b.repeated END
  FROM walk w JOIN based b ON b.conv_id = w.conv_id AND b.pos = w.pos + 1
), chars AS (SELECT conv_id, sum(seg + again) AS formatted_chars FROM walk GROUP BY conv_id
), said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM turns GROUP BY conv_id
)
SELECT s.conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said s JOIN chars c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
"""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS (SELECT d, lang, source, unnest(w) AS term FROM docs
), vocab AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 10
), counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN vocab v ON v.lang = w.lang AND v.term = w.term GROUP BY ALL
), sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM vocab GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM docs
), totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM groups g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL
), shares AS (
  SELECT t.lang, t.source, v.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (t.n + 2 * s.v)::HUGEINT AS p,
         1 + (1000000000 * (v.n + 2)::HUGEINT) // (s.n + 2 * s.v)::HUGEINT AS q
  FROM totals t JOIN sizes s ON s.lang = t.lang JOIN vocab v ON v.lang = t.lang
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = v.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP12 = r"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES: dict[str, str] = {"op2_line_dedup": OP2, "op5_chat_formatting": OP5, "op6_near_duplicates": OP6, "op11_source_divergence": OP11, "op12_exact_dedup": OP12}
