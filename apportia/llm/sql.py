"""DuckDB SQL that the queries are compared with."""

from __future__ import annotations

TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

#: The apportionment as highest quotients, listed one by one up to what a source or shard can win.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('17:' || CAST(doc_id AS VARCHAR)) AS ord
  FROM documents
), s AS (
  SELECT key, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM d GROUP BY key
), w AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS full_size
  FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(full_size) OVER f, 0)) / (CAST(sum(weight) OVER () AS DOUBLE) - coalesce(CAST(sum(weight) OVER f AS DOUBLE), 0)) AS lev
  FROM w WINDOW f AS (ORDER BY full_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, least(full_size, coalesce(max(CASE WHEN lev <= full_size / weight THEN lev END) OVER () * weight, full_size)) AS target FROM l
), m AS (SELECT *, CAST(round(sum(target) OVER () / 16) AS BIGINT) AS seats FROM t
), q1 AS (
  SELECT key, target, seats, k, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, key) AS r
  FROM (SELECT key, target, seats, unnest(range(1, CAST(floor(target / 16) AS BIGINT) + 64)) AS k FROM m WHERE target > 0)
), g AS (
  SELECT m.key, source_size, target, CAST(ceil(sqrt(n_docs / 64)) AS BIGINT) AS n_shards, coalesce(won, 0) AS source_quota
  FROM m LEFT JOIN (SELECT key, count(*) AS won FROM q1 WHERE r <= seats GROUP BY key) x ON m.key = x.key
), e AS (
  SELECT d.*, source_size, target, n_shards, source_quota, CAST('0x' || substr(ord, 1, 8) AS BIGINT) % n_shards AS shard
  FROM d JOIN g ON d.key = g.key
), h AS (
  SELECT key, shard, source_quota, CAST(sum(size) AS BIGINT) AS shard_size, sum(sum(size)) OVER (PARTITION BY key) AS key_size
  FROM e GROUP BY key, shard, source_quota
), q2 AS (
  SELECT key, shard, source_quota, row_number() OVER (PARTITION BY key ORDER BY shard_size / (2 * k - 1) DESC, shard) AS r
  FROM (SELECT *, unnest(range(1, CAST(floor(source_quota * shard_size / key_size) AS BIGINT) + 64)) AS k FROM h WHERE shard_size > 0)
), u AS (
  SELECT h.key, h.shard, shard_size, 16 * coalesce(won, 0) AS quota
  FROM h LEFT JOIN (SELECT key, shard, count(*) AS won FROM q2 WHERE r <= source_quota GROUP BY key, shard) x
    ON h.key = x.key AND h.shard = x.shard
), o AS (
  SELECT e.*, shard_size, quota,
         sum(size) OVER (PARTITION BY e.key, e.shard ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS bef
  FROM e JOIN u ON e.key = u.key AND e.shard = u.shard
)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(least(size, greatest(quota - bef, 0)) + least(size, greatest(quota - shard_size - bef, 0)) AS BIGINT) AS taken
FROM o
"""

#: Trees node by node; crc32 bit by bit, as the id's digits have it.
MANIFEST_SQL = r"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) AS r,
    list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda b: (ascii(c)::BIGINT >> b) & 1)
    ))), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))) AS crc
  FROM documents
), f AS (
  SELECT *, CASE WHEN (crc & 1) = 1 THEN replace(text, chr(10), '') ELSE text END AS now,
    concat_ws('',
      coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
  FROM d
), l AS (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS now,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM f
), t AS (
  SELECT source, 0 AS level, idx, n, leaf AS digest FROM l
  UNION ALL
  SELECT source, level + 1, idx // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY idx))
  FROM t WHERE n > 1 GROUP BY source, level, idx // 3
), s AS (
  SELECT source, level AS top, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM t WHERE n = 1
), u AS (
  SELECT 0 AS level, idx, n, subroot AS digest FROM s
  UNION ALL
  SELECT level + 1, idx // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY idx)) FROM u WHERE n > 1 GROUP BY level, idx // 3
), runs AS (
  SELECT source, level, idx // 3 AS up, list(digest ORDER BY idx) AS digests FROM t WHERE n > 1 GROUP BY source, level, idx // 3
  UNION ALL
  SELECT s.source, s.top + u.level, -1, list(u.digest ORDER BY u.idx) FROM s, u
  WHERE u.n > 1 AND u.idx // 3 = s.idx // CAST(3 ** (u.level + 1) AS BIGINT) GROUP BY s.source, s.top, u.level
), w AS (
  SELECT l.r, l.source, 0 AS level, l.idx, s.idx AS place, s.top, '' AS proof, l.now AS cur FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT w.r, w.source, w.level + 1, w.idx // 3, CASE WHEN w.level >= w.top THEN w.place // 3 ELSE w.place END, w.top,
    w.proof || array_to_string(digests[1:k], '') || array_to_string(digests[k + 2:], ''),
    sha256(array_to_string(digests[1:k], '') || w.cur || array_to_string(digests[k + 2:], ''))
  FROM (SELECT *, CAST(CASE WHEN level >= top THEN place % 3 ELSE idx % 3 END AS BIGINT) AS k FROM w) w
  JOIN runs ON w.source IS NOT DISTINCT FROM runs.source AND w.level = runs.level AND CASE WHEN w.level >= w.top THEN -1 ELSE w.idx // 3 END = runs.up
)
SELECT l.doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM (SELECT r, arg_max(proof, level) AS proof, arg_max(cur, level) AS cur FROM w GROUP BY r) x
JOIN l USING (r) JOIN s ON l.source IS NOT DISTINCT FROM s.source, (SELECT digest AS root FROM u WHERE n = 1)
"""
