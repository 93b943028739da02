"""SQL check of near-duplicate vectors: all pairs, and the least vector that links reach."""

ORACLE = """
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), normed AS (
  SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS norm FROM usable
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM normed a JOIN normed b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.9
), reached AS (
  SELECT vec_id, vec_id AS seen FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.seen
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT r.vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(seen) AS component_id, r.vec_id = min(seen) AS kept
FROM reached r LEFT JOIN counted c ON c.a = r.vec_id GROUP BY r.vec_id
"""
