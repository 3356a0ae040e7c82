"""DuckDB SQL for the rows of the queries that SQL can express."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, coalesce({_WORDS.format('text')}, []) AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, unnest(range(0, greatest(len(w) - 9, 1))) AS p, w FROM b WHERE len(w) > 0),
win AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, p + 1, p + n), ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, n, unnest(range(0, len(w) - n + 1)) AS p, w FROM d, sizes WHERE len(w) >= n),
hits AS MATERIALIZED (SELECT x.r, x.p, x.n, win.item_id FROM
  (SELECT r, n, p, array_to_string(list_slice(w, p + 1, p + n), ' ') AS s FROM dw) x JOIN win ON win.n = x.n AND win.s = x.s),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""

TOPK = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""

MIXING = """
WITH RECURSIVE n AS (SELECT source AS s, count(*) AS c FROM documents GROUP BY source),
a AS MATERIALIZED (SELECT s, greatest(1, CAST(floor(sqrt(c) / (SELECT sum(sqrt(c)) FROM n) * 1000 + 0.5) AS BIGINT)) AS a FROM n),
st AS MATERIALIZED (SELECT list(s ORDER BY s NULLS FIRST) AS ss, list(a ORDER BY s NULLS FIRST) AS aa, CAST(sum(a) AS BIGINT) AS l,
  CAST(count(*) AS BIGINT) AS k FROM a),
edf(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(range(0, k), lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM st
  UNION ALL
  SELECT t + 1, list_transform(range(1, k + 1), lambda j: done[j] + CASE WHEN j = p THEN 1 ELSE 0 END), p FROM (
    SELECT t, done, k, list_sort(list_transform(list_filter(range(1, k + 1), lambda j: done[j] < aa[j] AND done[j] * l // aa[j] <= t + 1),
      lambda j: [((done[j] + 1) * l + aa[j] - 1) // aa[j], j]))[1][2] AS p FROM edf, st WHERE t + 1 < l)),
slots AS MATERIALIZED (SELECT ss[pick] AS s, t, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS i FROM edf, st WHERE t >= 0),
r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source
  ORDER BY md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST) - 1 AS n FROM documents),
b AS (SELECT doc_id, source, n, n // 16 AS block FROM r),
o AS (SELECT b.*, a.a, (b.block // a.a) * (SELECT l FROM st) + slots.t AS slot FROM b
  JOIN a ON b.source IS NOT DISTINCT FROM a.s JOIN slots ON slots.s IS NOT DISTINCT FROM a.s AND slots.i = b.block % a.a)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(slot AS BIGINT) AS slot, CAST(slot * 16 + n % 16 AS BIGINT) AS position FROM o"""

REPEATS = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(hex(encode(text)), '') AS x FROM documents),
s AS (SELECT r, unnest(range(0, len(x) // 2 - 199)) AS p, x FROM d WHERE len(x) >= 400),
h AS MATERIALIZED (SELECT r, p, md5(substr(x, 2 * p + 1, 400)) AS k FROM s),
rep AS MATERIALIZED (SELECT r, p FROM h JOIN (SELECT k FROM h GROUP BY k HAVING count(*) > 1) USING (k)),
g AS (SELECT r, p, CASE WHEN p > lag(p) OVER w + 200 OR lag(p) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM rep WINDOW w AS (PARTITION BY r ORDER BY p)),
i AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS grp FROM g),
spans AS MATERIALIZED (SELECT r, grp, min(p) AS a, max(p) + 200 AS z FROM i GROUP BY r, grp),
cuts AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS prev, lead(a) OVER (PARTITION BY r ORDER BY a) AS nxt FROM spans),
kept AS (SELECT r, string_agg(substr(d.x, 2 * prev + 1, 2 * (a - prev)) || CASE WHEN nxt IS NULL THEN substr(d.x, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS x,
  sum(z - a) AS n_removed, count(*) AS n_spans FROM cuts JOIN d USING (r) GROUP BY r)
SELECT d.doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""

PII = None

RANKED_SEARCH = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
t AS MATERIALIZED (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
q AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
qt AS MATERIALIZED (SELECT DISTINCT q, item_id, unnest({_WORDS.format('text')}) AS term FROM q),
p AS MATERIALIZED (SELECT r, doc_id, n, term, count(*) AS tf FROM
  (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, t GROUP BY term),
i AS (SELECT r, doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))) AS x FROM p JOIN wt USING (term), t),
s AS (SELECT q, item_id, r, doc_id, CAST(sum(x) AS BIGINT) AS score FROM i JOIN qt USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""

_BYTE = "(CASE WHEN k % 8 = 0 THEN xor(a, CAST(ascii(s[CAST(k // 8 + 1 AS BIGINT)]) AS UBIGINT)) ELSE a END)"
# CRC-32 of a decimal number, bit by bit
_CRC32 = f"""xor(4294967295::UBIGINT, list_reduce(range(0, 8 * length(s)), lambda a, k:
  CASE WHEN {_BYTE} & 1 = 1 THEN xor({_BYTE} >> 1, 3988292384::UBIGINT) ELSE {_BYTE} >> 1 END, 4294967295::UBIGINT))"""

PREFIX_TRIE = f"""
WITH t AS MATERIALIZED (SELECT conv_id, turn, coalesce(text, '') AS text,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d FROM conversations WHERE conv_id IS NOT NULL),
n AS MATERIALIZED (SELECT conv_id, d, length(text) AS len, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS rn FROM t),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 100 AS root, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM n)),
r AS (SELECT c.conv_id, n.rn, n.d, n.len FROM c JOIN n ON n.conv_id = c.root AND n.rn <= c.h
      UNION ALL SELECT c.conv_id, n.rn, n.d, n.len FROM c JOIN n ON n.conv_id = c.conv_id AND n.rn > c.h),
o AS MATERIALIZED (SELECT conv_id, rn, len, row_number() OVER w AS depth, string_agg(d, '') OVER (w ROWS UNBOUNDED PRECEDING) AS path
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY rn)),
p AS MATERIALIZED (SELECT conv_id, depth, md5(path) AS k, md5(left(path, length(path) - 32)) AS up, len FROM o
      UNION ALL SELECT conv_id, 0, md5(''), NULL, 0 FROM c),
e AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
v AS MATERIALIZED (SELECT k, p.depth, min(p.conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs, max(len) AS len,
      sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE e.depth = p.depth), '')) AS ends
      FROM p JOIN e USING (conv_id) GROUP BY k, p.depth),
ch AS MATERIALIZED (SELECT up AS k, depth - 1 AS depth, count(*) AS n FROM v WHERE depth > 0 GROUP BY ALL),
x AS MATERIALIZED (SELECT v.*, coalesce(ch.n, 0) AS n_children FROM v LEFT JOIN ch USING (k, depth)),
-- each node below each of its ancestors, by one member that passes through both
b AS (SELECT a.k, a.depth, sum((x.n_convs - 1) * x.len) AS saved, count(*) FILTER (WHERE x.n_children = 0) AS leaves
      FROM x JOIN p m ON m.conv_id = x.conv_id AND m.depth = x.depth JOIN p a ON a.conv_id = x.conv_id AND a.depth <= x.depth
      GROUP BY a.k, a.depth)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, CAST(x.n_children AS BIGINT) AS n_children,
  CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN b USING (k, depth) LEFT JOIN v u ON u.k = x.up AND u.depth = x.depth - 1"""
