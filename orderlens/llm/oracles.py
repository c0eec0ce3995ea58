"""DuckDB SQL for the corpus queries that plain SQL can express, by brute force."""

from __future__ import annotations

_VECTORS = """
fit AS (
  SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

_COMPONENTS = """
reach AS (
  SELECT id AS a, id AS b FROM everyone
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
named AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

OP1 = f"""
WITH RECURSIVE {_VECTORS},
unit AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM fit WHERE label IS NOT NULL AND list_dot_product(e, e) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM unit x JOIN unit y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.93),
everyone AS (SELECT DISTINCT vec_id AS id FROM embeddings),
degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a),
{_COMPONENTS}
SELECT t.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, t.vec_id = c.component_id AS kept
FROM embeddings t LEFT JOIN degree d ON t.vec_id = d.id LEFT JOIN named c ON t.vec_id = c.id"""

OP7 = f"""
WITH {_VECTORS},
whole AS (SELECT DISTINCT vec_id, list_transform(e, lambda x: floor(256 * x)) AS v FROM fit),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5"""

OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
c AS (SELECT w.doc_id, w.p FROM w JOIN f ON w.s = f.s WHERE f.m < w.doc_id),
g AS (SELECT doc_id, p, CASE WHEN lag(p) OVER (PARTITION BY doc_id ORDER BY p) >= p - 50 THEN 0 ELSE 1 END AS fresh FROM c),
k AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
r AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM k GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM r
  UNION ALL
  SELECT d.doc_id, coalesce(max(r.z), 0), d.n FROM d LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id, d.n),
joined AS (
  SELECT d.doc_id, string_agg(substr(d.h, 2 * kept.a + 1, 2 * (kept.z - kept.a)), '' ORDER BY kept.a) AS h
  FROM d JOIN kept ON d.doc_id = kept.doc_id WHERE kept.z > kept.a GROUP BY d.doc_id),
gone AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(gone.n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(gone.n_spans, 0) AS n_spans, sha256(unhex(coalesce(joined.h, ''))) AS kept_sha256
FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id LEFT JOIN joined ON d.doc_id = joined.doc_id"""

OP9 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT i.doc_id AS a, j.doc_id AS b
  FROM items i JOIN items j ON i.x = j.x AND i.doc_id <> j.doc_id AND 100 * i.n >= 85 * j.n AND 100 * j.n >= 85 * i.n
  GROUP BY i.doc_id, j.doc_id, i.n, j.n HAVING 100 * count(*) >= 85 * (i.n + j.n - count(*))),
everyone AS (SELECT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, named.component_id, sets.doc_id = named.component_id AS kept
FROM sets JOIN named ON sets.doc_id = named.id"""

OP11 = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
digits AS (SELECT conv_id, CAST(4294967295 AS BIGINT) AS c, CAST(conv_id AS VARCHAR) AS rest, 0 AS bit FROM (SELECT DISTINCT conv_id FROM turns)
  UNION ALL
  SELECT conv_id, CASE WHEN bit = 0 THEN xor(c, ascii(rest)) ELSE CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END END,
         CASE WHEN bit = 8 THEN substr(rest, 2) ELSE rest END, CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END
  FROM digits WHERE rest <> ''),
heads AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM digits WHERE rest = ''),
rebuilt AS (
  SELECT heads.conv_id, 0 AS part, pos, role, text FROM heads JOIN turns ON turns.conv_id = heads.conv_id - heads.conv_id % 20 AND pos <= h
  UNION ALL
  SELECT heads.conv_id, 1, pos, role, text FROM heads JOIN turns ON turns.conv_id = heads.conv_id AND pos > h),
numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth,
         sha256(length(role) || ':' || role || text) AS turn,
         len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
  FROM rebuilt),
paths AS (
  SELECT conv_id, depth, words, string_agg(turn, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM (SELECT * FROM numbered ORDER BY conv_id, depth)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM heads),
lengths AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, any_value(depth) AS depth, min(paths.conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(paths.conv_id AS VARCHAR), ',' ORDER BY paths.conv_id) FILTER (WHERE depth = n), '')) AS ends_sha256
  FROM paths JOIN lengths ON paths.conv_id = lengths.conv_id GROUP BY path),
children AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
values_ AS (SELECT nodes.path, nodes.depth, (n_convs - 1) * words AS saved, CASE WHEN children.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes LEFT JOIN children ON nodes.path = children.path),
sums AS (SELECT left(path, 64 * up) AS path, sum(saved) AS saved, sum(leaf) AS leaves
  FROM (SELECT path, saved, leaf, unnest(range(0, depth + 1)) AS up FROM values_) GROUP BY 1)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, parents.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(children.n, 0) AS n_children, CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums ON nodes.path = sums.path LEFT JOIN children ON nodes.path = children.path
LEFT JOIN nodes parents ON nodes.depth > 0 AND parents.path = left(nodes.path, length(nodes.path) - 64)"""

OP13 = """
WITH fit AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM fit q JOIN fit c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
  FROM scores WHERE same),
ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS r
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same AND p.r <= 5
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 10"""

ORACLE = {
    "op1_embedding_dedup": OP1, "op7_top_k": OP7, "op8_suffix_dedup": OP8, "op9_minhash_dedup": OP9,
    "op11_prefix_trie": OP11, "op13_hard_negatives": OP13,
}
