"""SQL checks of the shingle join and of substring de-duplication."""

SIMILAR_GROUPS = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM cut WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION
  SELECT r.doc_id, w.b FROM reached r JOIN ways w ON w.a = r.seen
)
SELECT r.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(seen) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

SUBSTRINGS = r"""
WITH cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM cut WHERE len(words) >= 50)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY w) < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeated
), kept AS (
  SELECT c.doc_id, c.i, c.word FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM cut) c
  ANTI JOIN gone g ON g.doc_id = c.doc_id AND g.i = c.i
), joined AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM kept GROUP BY doc_id
)
SELECT c.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM cut c LEFT JOIN joined j ON j.doc_id = c.doc_id
"""
