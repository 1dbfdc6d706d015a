"""DuckDB SQL of the queries that SQL can express over whole tables.

The others (packing, spans with their offsets, alignment, token counts, language
scores, the pipeline) are tested against brute force in ``tests/llm``.
"""

SQL: dict[str, str] = {}

# all pairs that share a shingle; components by transitive closure
SQL["op3_minhash_neardup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) END)) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, b AS other FROM edges
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.other, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least l USING (doc_id)
"""

# all pairs
SQL["op4_pivot_topk"] = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# the derived calls and results by hand, levels by recursion
SQL["op5_chat_tool_links"] = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, role, text, coalesce(text, '') AS t,
         len(coalesce(text, '')) - len(replace(coalesce(text, ''), ' ', '')) + 1 AS w
  FROM conversations),
calls AS (
  SELECT conv_id, turn, t, w, 'call-' || conv_id || '-' || turn AS call_id,
         CASE WHEN w % 3 = 0 THEN turn - 2 WHEN w % 7 = 1 THEN turn + 2 END AS to_turn,
         CASE WHEN w % 11 = 5 THEN 'draw' WHEN w % 3 = 1 THEN 'rank' ELSE 'search' END AS tool
  FROM c WHERE role = 'assistant'),
results AS (
  SELECT conv_id, turn, t, 'call-' || conv_id || '-' || (turn - 1) AS call_id
  FROM c WHERE role = 'user' AND turn > 0),
levels AS (
  SELECT conv_id, turn, call_id, 0 AS level FROM calls WHERE to_turn IS NULL
  UNION ALL
  SELECT k.conv_id, k.turn, k.call_id, l.level + 1
  FROM calls k JOIN levels l ON k.conv_id = l.conv_id AND k.to_turn = l.turn)
SELECT k.conv_id, k.turn, 0 AS nth, 'call' AS kind, k.call_id,
       CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status, l.level,
       CASE WHEN tool = 'draw' THEN 'unknown tool draw' WHEN tool = 'rank' AND to_turn IS NULL THEN '$.after: missing'
            WHEN tool = 'search' AND w > 40 THEN '$.limit: above 40' ELSE '' END AS errors,
       '{"arguments":{' || CASE WHEN to_turn IS NULL THEN '' ELSE
         '"after":{"$ref":"call-' || k.conv_id || '-' || to_turn || '"},' END
         || '"limit":' || w || ',"query":' || to_json(k.t) || '},"id":"' || k.call_id
         || '","name":"' || tool || '"}' AS json
FROM calls k LEFT JOIN results r USING (call_id) LEFT JOIN levels l USING (call_id)
UNION ALL
SELECT r.conv_id, r.turn, 0, 'result', r.call_id,
       CASE WHEN k.call_id IS NULL THEN 'no_call' ELSE 'linked' END, l.level, '',
       '{"content":' || to_json(r.t) || ',"tool_call_id":"' || r.call_id || '"}'
FROM results r LEFT JOIN calls k USING (call_id) LEFT JOIN levels l USING (call_id)
UNION ALL
SELECT conv_id, turn, 0, 'message', NULL, NULL, NULL, '',
       '{"content":' || coalesce(to_json(text), 'null') || ',"role":' || coalesce(to_json(role), 'null') || '}'
FROM c WHERE role IS DISTINCT FROM 'assistant' AND NOT (role IS NOT DISTINCT FROM 'user' AND turn > 0)
"""

# the digests and the largest id of each payload
SQL["op8_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS n, sha1(payload) AS digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM m
"""

# the shortest runs of ten words from and up to every line, by their text
SQL["op9_line_dedup"] = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, place, line, w, sum(w) OVER (PARTITION BY doc_id ORDER BY place) AS upto
  FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{20000}-\x{3FFFF}]+'))
          + (len(regexp_extract_all(line, '[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{20000}-\x{3FFFF}]')) + 1) // 2 AS w
        FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM d))),
runs AS (
  SELECT a.doc_id, a.place AS s, min(b.place) + 1 AS e FROM lines a JOIN lines b
    ON a.doc_id = b.doc_id AND b.place >= a.place AND b.upto >= a.upto - a.w + 10 GROUP BY a.doc_id, a.place
  UNION
  SELECT b.doc_id, max(a.place), b.place + 1 FROM lines a JOIN lines b
    ON a.doc_id = b.doc_id AND b.place >= a.place AND b.upto >= a.upto - a.w + 10 GROUP BY b.doc_id, b.place),
told AS (
  SELECT doc_id, s, e, first_value(doc_id) OVER run AS source, row_number() OVER run AS nth
  FROM (SELECT r.*, array_to_string(l[s + 1:e], chr(10)) AS content FROM runs r JOIN d USING (doc_id))
  WINDOW run AS (PARTITION BY content ORDER BY doc_id, s)),
copies AS (SELECT * FROM told WHERE nth > 1),
gone AS (
  SELECT doc_id, place, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run
  FROM (SELECT DISTINCT doc_id, unnest(range(s, e)) AS place FROM copies)),
spans AS (
  SELECT doc_id, sum(n) AS n, string_agg(s || '-' || (s + n), ',' ORDER BY s) AS deleted
  FROM (SELECT doc_id, min(place) AS s, count(*) AS n FROM gone GROUP BY doc_id, run) GROUP BY doc_id),
named AS (SELECT doc_id, list(DISTINCT source ORDER BY source) AS sources FROM copies GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text
  FROM lines ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS INTEGER) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_deleted,
       coalesce(deleted, '') AS deleted, coalesce(sources, []) AS sources,
       CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# every term of every item against every document that holds it
SQL["op13_ranked_search"] = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
f AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS l FROM n),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * f.nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
      FROM tf, f GROUP BY term, f.nn),
m AS (SELECT doc_id, 100 - 75 + (75 * n * f.nn) // f.l AS m FROM n, f),
s AS (
  SELECT q.item_id, tf.doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY q.item_id, tf.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""

# as op3: all pairs that share a shingle (of three words), components by transitive closure
SQL["op11_token_group_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(len(w) - 2), lambda i: array_to_string(w[i + 1:i + 3], ' ')) END)) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, b AS other FROM edges
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least l USING (doc_id)
"""
