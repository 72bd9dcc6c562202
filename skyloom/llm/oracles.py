"""DuckDB SQL for the training-data queries that SQL can say."""

from __future__ import annotations

#: Words by place; every place of a document starts a window of each size that items have.
OP2 = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS MATERIALIZED (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS MATERIALIZED (
  SELECT DISTINCT item_id, size, array_to_string(w[p + 1 : p + size], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(len(w) - least(len(w), 10) + 1)) AS p
        FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT r, size, w, unnest(range(len(w) - size + 1)) AS p FROM docs, sizes WHERE len(w) >= size
), found AS MATERIALIZED (
  SELECT r, size, p, item_id
  FROM (SELECT r, size, p, array_to_string(w[p + 1 : p + size], ' ') AS phrase FROM places) AS placed
  JOIN windows USING (size, phrase)
), hit AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS place FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

#: All pairs of sound vectors, and whom links reach.
OP10 = r"""
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x
  FROM embeddings
), sound AS MATERIALIZED (
  SELECT r, vec_id, len(x) AS width, list_transform(x, lambda e: e / norm) AS u
  FROM (SELECT *, sqrt(list_sum(list_transform(x, lambda e: e * e))) AS norm FROM vectors
        WHERE len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0)
  WHERE norm > 0
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, a.vec_id AS va, b.vec_id AS vb
  FROM sound AS a JOIN sound AS b ON a.width = b.width AND a.r <> b.r
  WHERE list_dot_product(a.u, b.u) >= 0.9
), reached (a, b) AS (
  SELECT r, r FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (
  SELECT reached.a AS r, min(vec_id) AS component_id FROM reached JOIN vectors ON vectors.r = reached.b GROUP BY reached.a
), counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT CAST(vec_id AS BIGINT) AS vec_id, coalesce(n, 0) AS n_links, CAST(component_id AS BIGINT) AS component_id,
       coalesce(vec_id = component_id, false) AS kept
FROM vectors JOIN least USING (r) LEFT JOIN counted USING (r)
"""

#: Every line of a document with its key; a row of the table has a number of its own.
OP11 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS nr FROM texts
), keys AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS last FROM keys WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 5
), judged AS (
  SELECT r, k.doc_id, line, nr, repeated.key IS NOT NULL AND k.doc_id IS DISTINCT FROM last AS gone
  FROM keys AS k LEFT JOIN repeated ON k.key = repeated.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


def _op12(rounds: int = 10, k: int = 8) -> str:
    """Rounds written out one after the other."""
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster, x AS c
  FROM x ORDER BY sha256('3:' || vec_id) LIMIT {k}
)"""
    ]
    for n in range(rounds + 1):
        parts.append(f"""
, a{n} AS MATERIALIZED (
  SELECT r, vec_id, x, near['cluster'] AS cluster, near['distance'] AS distance
  FROM (SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x,
               min({{'distance': CAST({distance} AS BIGINT), 'cluster': cluster}}) AS near
        FROM x, c{n} GROUP BY r)
)""")
        if n < rounds:
            parts.append(f"""
, s{n} AS MATERIALIZED (
  SELECT cluster, nr, sum(v) AS total, count(*) AS n
  FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS nr FROM a{n}) GROUP BY cluster, nr
), c{n + 1} AS MATERIALIZED (
  SELECT c{n}.cluster, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY nr) AS c
    FROM s{n} GROUP BY cluster) AS m ON m.cluster = c{n}.cluster
)""")
    parts.append(f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
""")
    return "".join(parts)


OP12 = _op12()

#: Levels rise until a tree has one node. A leaf's path follows them, to its source's root and on to the top.
OP13 = r"""
WITH RECURSIVE rows_ AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
         list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [ascii(d), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, s: CASE WHEN s >= 0 THEN xor(CAST(c AS BIGINT), CAST(s AS BIGINT))
                             ELSE xor(CAST(c AS BIGINT) >> 1, 3988292384 * (CAST(c AS BIGINT) & 1)) END) AS crc
  FROM documents
), texts AS MATERIALIZED (
  SELECT *, CASE WHEN xor(CAST(crc AS BIGINT), 4294967295) % 5 = 0
                 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                 ELSE text END AS tampered
  FROM rows_
), heads AS MATERIALIZED (
  SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM texts
), leaves AS MATERIALIZED (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(tampered) || ':' || tampered, '-')) AS changed
  FROM heads
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), low (lvl, source, pos, digest, n) AS (
  SELECT 0, source, pos, leaf, count(*) OVER (PARTITION BY source) FROM placed
  UNION ALL
  SELECT any_value(lvl) + 1, source, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM low WHERE n > 1 GROUP BY source, pos // 16
), low_nodes AS MATERIALIZED (SELECT * FROM low
), subroots AS MATERIALIZED (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM low_nodes WHERE n = 1
), high (lvl, pos, digest, n) AS (
  SELECT 0, pos, digest, count(*) OVER () FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM high WHERE n > 1 GROUP BY pos // 16
), high_nodes AS MATERIALIZED (SELECT * FROM high
), low_runs AS MATERIALIZED (
  SELECT lvl, source, pos // 16 AS run, list(digest ORDER BY pos) AS d FROM low_nodes WHERE n > 1
  GROUP BY lvl, source, pos // 16
), high_runs AS MATERIALIZED (
  SELECT lvl, pos // 16 AS run, list(digest ORDER BY pos) AS d FROM high_nodes WHERE n > 1 GROUP BY lvl, pos // 16
), climb (r, source, lvl, pos, proof, folded) AS (
  SELECT r, source, 0, pos, '', changed FROM placed
  UNION ALL
  SELECT r, c.source, c.lvl + 1, c.pos // 16,
         proof || array_to_string(d[:c.pos % 16], '') || array_to_string(d[c.pos % 16 + 2:], ''),
         sha256(array_to_string(d[:c.pos % 16], '') || folded || array_to_string(d[c.pos % 16 + 2:], ''))
  FROM climb AS c JOIN low_runs AS l
    ON l.lvl = c.lvl AND l.run = c.pos // 16 AND l.source IS NOT DISTINCT FROM c.source
), climbed AS MATERIALIZED (
  SELECT r, source, arg_max(proof, lvl) AS proof, arg_max(folded, lvl) AS folded FROM climb GROUP BY r, source
), rise (r, lvl, pos, proof, folded) AS (
  SELECT r, 0, s.pos, proof, folded FROM climbed AS c JOIN subroots AS s ON s.source IS NOT DISTINCT FROM c.source
  UNION ALL
  SELECT r, e.lvl + 1, e.pos // 16,
         proof || array_to_string(d[:e.pos % 16], '') || array_to_string(d[e.pos % 16 + 2:], ''),
         sha256(array_to_string(d[:e.pos % 16], '') || folded || array_to_string(d[e.pos % 16 + 2:], ''))
  FROM rise AS e JOIN high_runs AS h ON h.lvl = e.lvl AND h.run = e.pos // 16
), risen AS MATERIALIZED (
  SELECT r, arg_max(proof, lvl) AS proof, arg_max(folded, lvl) AS folded FROM rise GROUP BY r
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = t.digest AS verified
FROM placed AS p JOIN risen USING (r)
JOIN subroots AS s ON s.source IS NOT DISTINCT FROM p.source
JOIN high_nodes AS t ON t.n = 1
"""
