"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 1 THEN [ws[1]] ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh
  FROM w WHERE len(ws) > 0
), n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT s.doc_id, n, unnest(sh) AS x FROM s JOIN n USING (doc_id)),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL
), l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
d AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, d.b FROM r JOIN d ON d.a = r.c)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id, r.doc_id = min(r.c) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""

OP6 = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (SELECT hex, payload_bytes, min(page_id) AS response FROM p GROUP BY ALL)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM p JOIN f USING (hex, payload_bytes)
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), l AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM i WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda p: array_to_string(ws[p : p + k - 1], ' '))) AS win FROM l),
ks AS (SELECT DISTINCT k FROM l),
dp AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d, ks WHERE len(ws) >= k),
dw AS (SELECT doc_id, k, p, array_to_string(ws[p : p + k - 1], ' ') AS win FROM dp),
h AS (SELECT doc_id, p, k, item_id FROM dw JOIN iw USING (k, win)),
n AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP11 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), r AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS role_before, lead(role) OVER w AS role_after,
    length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '</turn>|<turn>|<says>|<part>')) AS text_size,
    length(role) + length(role) - length(replace(role, '\', '')) + len(regexp_extract_all(role, '</turn>|<turn>|<says>|<part>')) AS role_size
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_size + CASE WHEN role_before IS DISTINCT FROM role THEN 12 + role_size ELSE 6 END
    + CASE WHEN role_after IS DISTINCT FROM role THEN 8 ELSE 0 END)::BIGINT AS formatted_chars,
  count(*) FILTER (role_before IS DISTINCT FROM role) AS n_blocks
FROM r GROUP BY conv_id
"""

OP12 = r"""
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id, row_number() OVER w::INT AS rank, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) QUALIFY row_number() OVER w <= 10
"""

OP13 = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t FROM range(256) r(n)
), r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), d AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) AS h
  FROM d, crc
), s AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h
), v AS (SELECT word, sum(n)::BIGINT AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
o AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM x),
p AS (
  SELECT o.word, o.n, q.word AS other, q.n AS other_n FROM o JOIN o q ON o.i = q.i AND o.a = q.a AND o.b = q.b AND o.word <> q.word
  UNION SELECT o.word, o.n, v.word, v.n FROM o JOIN v ON v.word = o.a || o.b
  UNION SELECT v.word, v.n, o.word, o.n FROM o JOIN v ON v.word = o.a || o.b
), g AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM p GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n
  FROM v LEFT JOIN g USING (word)
), w(word, top) AS (SELECT word, word FROM f UNION ALL SELECT w.word, f.form FROM w JOIN f ON f.word = w.top AND f.form IS NOT NULL)
SELECT f.word, f.form, e.top AS root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT w.word, w.top FROM w JOIN f ON f.word = w.top AND f.form IS NULL) e ON e.word = f.word
"""

ORACLE = {"op3_minhash": OP3, "op6_warc": OP6, "op10_decontamination": OP10, "op11_chat": OP11, "op12_negatives": OP12, "op13_spelling": OP13}
