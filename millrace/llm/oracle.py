"""SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op3_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, source, source IS NULL AS no_source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS place
  FROM documents),
sums AS (SELECT no_source, source, sum(size)::BIGINT AS total FROM docs GROUP BY no_source, source),
sources AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY no_source, source) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sums),
levels AS (
  SELECT *, 3.0::DOUBLE * total AS bound,
         ((SELECT sum(total) FROM sources)::DOUBLE
           - coalesce(sum(3.0::DOUBLE * total) OVER (ORDER BY total / weight, no_source, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY total / weight, no_source, source
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
chosen AS (SELECT min_by(level, total / weight) AS level FROM levels WHERE bound > weight * level),
targets AS (
  SELECT l.no_source, l.source, l.total,
         CASE WHEN c.level IS NULL THEN l.bound ELSE least(l.bound, l.weight * c.level) END AS target
  FROM levels l, chosen c),
passed AS (
  SELECT d.doc_id, d.size, t.total, t.target,
         CASE WHEN t.total > 0 THEN floor(t.target / t.total) ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.no_source, d.source ORDER BY place, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM docs d JOIN targets t ON d.no_source = t.no_source AND d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total AS source_size, target,
       (size * times)::BIGINT AS taken, times
FROM (SELECT *, (whole + CASE WHEN 2 * earlier + size <= 2 * (target - whole * total) THEN 1 ELSE 0 END)::BIGINT
        AS times FROM passed)
"""

ORACLE["op2_block_neighbours"] = """
WITH rows AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
queries AS (SELECT vec_id, min(v) AS v FROM rows WHERE vec_id % 20 = 0 GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v) AS score
  FROM queries q JOIN rows r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20
"""

ORACLE["op10_kd_top_k"] = """
WITH rows AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
queries AS (SELECT vec_id, min(v) AS v FROM rows WHERE vec_id % 50 = 0 GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM queries q JOIN rows r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""

# The given pages hold no canonical links or redirects (a test has them), so no alias inherits a block here.
ORACLE["op9_url_filter"] = r"""
WITH pages_at AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT p.page_id, p.host, p.path, max_by(r.host || r.path, len(r.host || r.path)) AS rule,
         max_by(r.verdict, len(r.host || r.path)) AS verdict
  FROM pages_at p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
"""

# The CRC runs over the bytes of the decimal id: -1 stands for a shift by one bit.
ORACLE["op13_manifest"] = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text IS NOT NULL AND doc_id IS NOT NULL AND (4294967295 - list_reduce(
           [4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: [ord(c)::BIGINT] || list_transform(range(8), lambda i: -1::BIGINT))),
           lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) % 5 = 0 AS changed,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS body,
         coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || body) AS leaf, sha256(head || CASE WHEN changed THEN low ELSE body END) AS other FROM fields),
leaves AS (
  SELECT *, coalesce('x' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS many FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), ceil(any_value(many) / 16)::BIGINT
  FROM nodes WHERE many > 1 GROUP BY tree, level, pos // 16),
subroots AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE many = 1),
tops AS (
  SELECT 0 AS level, place AS pos, subroot AS node, count(*) OVER () AS many FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), ceil(any_value(many) / 16)::BIGINT
  FROM tops WHERE many > 1 GROUP BY level, pos // 16),
every AS (
  SELECT tree, level, pos, node, many FROM nodes WHERE many > 1
  UNION ALL
  SELECT 'top', level, pos, node, many FROM tops WHERE many > 1),
kids AS (SELECT tree, level, pos // 16 AS run, string_agg(node, '' ORDER BY pos) AS kids FROM every GROUP BY tree, level, pos // 16),
roots AS (SELECT node AS root FROM tops WHERE many = 1),
steps AS (
  SELECT l.tree, l.doc_id, l.pos, l.leaf, k.level, k.kids, (l.pos // (16 ** k.level)::BIGINT % 16) AS slot
  FROM leaves l JOIN kids k ON k.tree = l.tree AND k.run = l.pos // (16 ** (k.level + 1))::BIGINT
  UNION ALL
  SELECT l.tree, l.doc_id, l.pos, l.leaf, 1000 + k.level, k.kids, (s.place // (16 ** k.level)::BIGINT % 16)
  FROM leaves l JOIN subroots s USING (tree) JOIN kids k ON k.tree = 'top' AND k.run = s.place // (16 ** (k.level + 1))::BIGINT),
proofs AS (
  SELECT tree, pos, list({'b': kids[1:slot * 64], 'a': kids[slot * 64 + 65:]} ORDER BY level) AS path FROM steps GROUP BY tree, pos),
proved AS (
  SELECT l.*, s.subroot, r.root, coalesce(p.path, []) AS path
  FROM leaves l JOIN subroots s USING (tree) CROSS JOIN roots r LEFT JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos),
folded AS (
  SELECT *, list_reduce([{'b': '', 'a': '', 'd': other}] || list_transform(path, lambda p: {'b': p.b, 'a': p.a, 'd': ''}),
              lambda x, y: {'b': '', 'a': '', 'd': sha256(y.b || x.d || y.a)}).d AS folded_root FROM proved)
SELECT doc_id, source, leaf, subroot, root,
       sha256(coalesce(array_to_string(list_transform(path, lambda p: p.b || p.a), ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
