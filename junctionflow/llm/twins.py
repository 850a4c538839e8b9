"""DuckDB SQL for the queries that SQL can express, written from the contracts."""

from __future__ import annotations

MIX = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM {docs}),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
s1 AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM s0),
s2 AS (SELECT *, source_size::DOUBLE * 2 AS most, source_size / w AS ratio FROM s1),
s3 AS (SELECT *, row_number() OVER o AS place,
         (sum(source_size) OVER ())::DOUBLE * 1.5
         - coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2 AS need,
         sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
       FROM s2 WINDOW o AS (ORDER BY ratio, source NULLS LAST)),
s4 AS (SELECT *, min(CASE WHEN w * need <= rest * most THEN place END) OVER () AS free FROM s3),
s5 AS (SELECT *, max(CASE WHEN place = free THEN need END) OVER () AS need_free,
         max(CASE WHEN place = free THEN rest END) OVER () AS rest_free FROM s4),
goal AS (SELECT source, source_size, CASE WHEN place >= free THEN w * need_free / rest_free ELSE most END AS target FROM s5),
r AS (SELECT b.*, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
        coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.k, b.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
      FROM base b JOIN goal g ON b.source IS NOT DISTINCT FROM g.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM r)
SELECT doc_id, source, size, source_size, target,
       (epochs * size + least(size, greatest(0, budget - epochs * source_size - ahead)))::BIGINT AS taken
FROM e
"""

LINES = r"""
WITH l AS (
  SELECT rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM (SELECT *, row_number() OVER () AS rid FROM {docs})),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
rep AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, (rep.key IS NOT NULL AND k.doc_id <> rep.holder) IS TRUE AS gone FROM k LEFT JOIN rep USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id
"""

GROUPS = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM {docs}),
g AS (
  SELECT DISTINCT rid, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                   WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram
  FROM d),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
pairs AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.rid < y.rid GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b)
SELECT x.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(y.doc_id) AS component_id
FROM d x JOIN reach r ON r.a = x.rid JOIN d y ON y.rid = r.b LEFT JOIN n ON n.rid = x.rid
GROUP BY x.rid, x.doc_id
"""

LEAKS = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM {docs}),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM {items}),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS width, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT rid, width, i, array_to_string(ws[i:i + width - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS i FROM d, (SELECT DISTINCT width FROM win))),
hit AS (SELECT DISTINCT rid, i, width, item_id FROM dw JOIN win USING (w, width)),
cover AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(width)) AS k FROM hit) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY rid)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(cover.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
       sha256(coalesce(found.ids, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN found USING (rid)
"""

UNITS = r"""
WITH l AS (
  SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs})),
o AS (
  SELECT *, (sum(length(line) + 1) OVER (PARTITION BY rid ORDER BY pos) - length(line) - 1)::BIGINT AS st,
         regexp_extract_all(line, '[^.!?。！？]*[.!?。！？]+|[^.!?。！？]+') AS parts
  FROM l),
p AS (SELECT rid, doc_id, pos, st AS line_st, unnest(parts) AS part, generate_subscripts(parts, 1) AS nth FROM o),
u AS (
  SELECT rid, doc_id, pos, 0 AS nth, line AS unit, st, 'line' AS kind FROM o
  UNION ALL
  SELECT rid, doc_id, pos, nth, part, (line_st + sum(length(part)) OVER (PARTITION BY rid, pos ORDER BY nth) - length(part))::BIGINT, 'sentence' FROM p),
k AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND length(key) >= CASE WHEN kind = 'line' THEN 1 ELSE 40 END THEN key END AS counted
  FROM (SELECT *, array_to_string(regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS key FROM u)),
f AS (SELECT kind, counted AS key, min((doc_id, st)) AS first FROM k WHERE counted IS NOT NULL GROUP BY kind, counted),
j AS (SELECT k.*, (f.first IS NOT NULL AND (k.doc_id, k.st) > f.first) IS TRUE AS repeated FROM k LEFT JOIN f ON f.kind = k.kind AND f.key = k.counted),
g AS (SELECT *, bool_or(repeated AND kind = 'line') OVER (PARTITION BY rid, pos) AS line_gone FROM j),
r AS (SELECT *, CASE WHEN kind = 'line' THEN repeated ELSE repeated AND NOT line_gone END AS gone FROM g),
kept AS (
  SELECT rid, pos, coalesce(string_agg(unit, '' ORDER BY nth) FILTER (kind = 'sentence' AND NOT gone), '') AS line
  FROM r WHERE NOT line_gone GROUP BY rid, pos),
texts AS (SELECT rid, string_agg(line, chr(10) ORDER BY pos) AS kept FROM kept GROUP BY rid)
SELECT doc_id, (count(*) FILTER (gone))::BIGINT AS n_removed, coalesce(sum(length(unit)) FILTER (gone), 0)::BIGINT AS removed_chars,
       coalesce(string_agg(st || '-' || (st + length(unit)), ',' ORDER BY st, st + length(unit)) FILTER (gone), '') AS removed,
       (count(*) FILTER (kind = 'line'))::BIGINT AS n_units, sha256(coalesce(any_value(kept), '')) AS kept_sha256
FROM r LEFT JOIN texts USING (rid) GROUP BY rid, doc_id
"""

NEGATIVES = r"""
WITH r AS (
  SELECT vec_id, label, min(x) AS x
  FROM (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
        FROM {vectors}
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)
  GROUP BY vec_id, label QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label) = 1),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

CHATS = r"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {turns}
  UNION ALL SELECT -7, n, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) q(n, r)),
l AS (
  SELECT *, md5(text) AS d,
         length(role) + length(text) + len(regexp_extract_all(role || text, '\\')) + len(regexp_extract_all(role, ':'))
         + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}') || regexp_extract_all(text, '#{3,}'), lambda h: length(h) - 2)), 0)
         + len(regexp_extract_all(role, '</turn>')) + len(regexp_extract_all(text, '</turn>'))
         + length('### ' || ': ' || '</turn>' || chr(10)) AS size
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, d)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, d) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
"""

SQL: dict[str, str] = {
    "op11_hard_negatives": NEGATIVES.replace("{vectors}", "embeddings"),
    "op12_chat_formatting": CHATS.replace("{turns}", "conversations"),
    "op9_line_hashing": UNITS.replace("{docs}", "documents"),
    "op6_decontamination": LEAKS.replace("{docs}", "documents").replace("{items}", "benchmark"),
    "op1_ngram_join": GROUPS.replace("{docs}", "documents"),
    "op2_mix_sources": MIX.replace("{docs}", "documents"),
    "op4_line_dedup": LINES.replace("{docs}", "documents"),
}
