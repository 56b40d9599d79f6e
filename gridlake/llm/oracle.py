"""DuckDB SQL for the registered queries that SQL can express."""

ORACLE = {}

ORACLE["op7_sharding"] = """
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(256) r(i))
), crc AS (
  SELECT t, xor(list_reduce(
    list_transform(range(1, strlen(t) + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS c
  FROM (SELECT DISTINCT coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents), crc_table
), d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, coalesce(text, '') AS t,
         ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS key FROM documents
), a AS (
  SELECT key, doc_id, sum(size)::BIGINT AS b FROM d GROUP BY ALL
), p AS (
  SELECT key, doc_id, b, (sum(b) OVER (ORDER BY key, doc_id))::BIGINT - b AS s FROM a
), g AS (
  SELECT key, min(s) AS s, (min(s) + sum(b))::BIGINT AS e FROM p GROUP BY key
), t AS (
  SELECT k, (total * k) // 24 AS t, ((total * 5) // 1000) // 24 AS near
  FROM range(1, 24) r(k), (SELECT sum(size)::BIGINT AS total FROM d)
), c AS (
  SELECT t.k, CASE
    WHEN least(t.t - g.s, g.e - t.t) <= t.near THEN CASE WHEN t.t - g.s <= g.e - t.t THEN g.s ELSE g.e END
    WHEN t.t - p.s <= p.s + p.b - t.t THEN p.s ELSE p.s + p.b END AS at
  FROM t JOIN g ON g.s <= t.t AND t.t < g.e JOIN p ON p.s <= t.t AND t.t < p.s + p.b
), q AS (
  SELECT p.key, p.doc_id, CAST((SELECT count(*) FROM c WHERE c.at <= p.s) AS INTEGER) AS shard FROM p
)
SELECT d.doc_id, d.size, crc.c AS text_crc32, 'bytes' AS law, q.shard,
       row_number() OVER (PARTITION BY q.shard ORDER BY d.key, d.doc_id) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN q USING (key, doc_id) JOIN crc USING (t)
"""

ORACLE["op9_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
), k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, min(doc_id) AS first, count(DISTINCT doc_id) AS n FROM k WHERE length(key) >= 10 GROUP BY key
), j AS (
  SELECT k.doc_id, pos, line, coalesce(n >= 2 AND first <> k.doc_id, false) AS dropped FROM k LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

ORACLE["op6_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), ok AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / a.norm / b.norm >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links,
       (SELECT min(b) FROM reach WHERE reach.a = v.vec_id) AS component_id,
       v.vec_id = (SELECT min(b) FROM reach WHERE reach.a = v.vec_id) AS kept
FROM v
"""

# Matches are marked by two characters that no pattern matches, and the marked
# text is cut at the first of them.
_MARKED = r"""
  SELECT doc_id, owner, '{kind}' AS kind, parts, chr(57345) AS e FROM (
    SELECT doc_id, owner, string_split(regexp_replace(t, '({pattern})', chr(57344) || '\1' || chr(57345), 'g'), chr(57344)) AS parts
    FROM d) WHERE len(parts) > 1
"""
_PATTERNS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "token": "[A-Za-z0-9_-]+",
}

ORACLE["op13_secrets"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS owner,
         translate(coalesce(text, ''), chr(57344) || chr(57345), chr(57346) || chr(57346)) AS t FROM documents
), marked AS (""" + " UNION ALL ".join(_MARKED.format(kind=k, pattern=p) for k, p in _PATTERNS.items()) + r"""
), u AS (
  SELECT doc_id, owner, kind, e, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM marked
), placed AS (
  SELECT doc_id, owner, kind, i, split_part(part, e, 1) AS m,
         sum(length(part) - (i > 0)::INT) OVER (PARTITION BY doc_id, kind ORDER BY i) - length(part) + (i > 0)::INT AS s FROM u
), f AS (
  SELECT doc_id, owner, kind, s::BIGINT AS s, (s + length(m))::BIGINT AS e,
         CASE WHEN kind = 'assign' THEN regexp_extract(m, '""" + _PATTERNS["assign"] + r"""', 2) ELSE m END AS v
  FROM placed WHERE i > 0
), ok AS (
  SELECT * FROM f WHERE CASE kind
    WHEN 'assign' THEN length(v) >= 6 WHEN 'access' THEN length(v) >= 20 WHEN 'hex' THEN length(v) >= 24
    ELSE length(v) >= 20 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') END
), held AS (
  SELECT v, count(DISTINCT owner) AS owners FROM ok GROUP BY v
), judged AS (
  SELECT v, CASE WHEN owners >= 3 THEN 'example'
    WHEN owners = 1 AND len(list_distinct(string_split(v, ''))) >= 6 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
      AND NOT regexp_matches(lower(v), 'changeme|dummy|example|fake|insert|placeholder|redacted|sample|test|xxxx|your')
    THEN 'live' END AS verdict FROM held
), spans AS (
  SELECT doc_id, kind, s, e FROM ok WHERE kind <> 'token'
  UNION SELECT doc_id, verdict, e - length(v), e FROM ok JOIN judged USING (v) WHERE verdict IS NOT NULL
), a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k <= 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans
  FROM (SELECT *, list_position(['assign', 'access', 'hex', 'live', 'example'], kind) AS k FROM spans) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""

ORACLE["op11_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS MATERIALIZED (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), totals AS (
  SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0)
         + (SELECT count(*) FROM kept WHERE kept.lang = g.lang) AS total FROM g
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1)) // CAST(total AS HUGEINT) AS p
  FROM totals JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
), whole AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(n) + 1)) // CAST(sum(sum(n)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang) AS HUGEINT) AS q
  FROM shares GROUP BY lang, term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
  FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

# One block of SQL per round: the assignment to the centroids so far, then
# the centroids after it.
_ASSIGN = """
a{n} AS MATERIALIZED (
  SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT r, vec_id, x, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{n}) GROUP BY r, vec_id, x
)"""
_MOVE = """
m{n} AS (
  SELECT cluster, list(s ORDER BY i) AS c FROM (
    SELECT cluster, i, sum(x[i]) AS total, count(*) AS n,
           CAST((total - ((total % n) + n) % n) // n AS BIGINT) AS s
    FROM a{n}, range(1, 65) AS t(i) GROUP BY cluster, i) GROUP BY cluster
), c{m} AS MATERIALIZED (
  SELECT cluster, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (cluster)
)"""

ORACLE["op12_clustering"] = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS cluster, x AS c
  FROM v ORDER BY sha256('3:' || vec_id) LIMIT 8
),""" + ",".join(_ASSIGN.format(n=n) + "," + _MOVE.format(n=n, m=n + 1) for n in range(10)) + "," + _ASSIGN.format(n=10) + """
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda i: CAST(i AS VARCHAR)), ',')) AS centroid_sha256
FROM a10 JOIN c10 USING (cluster)
"""
