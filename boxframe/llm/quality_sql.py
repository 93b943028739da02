"""SQL check of the quality rules."""

ORACLE = r"""
WITH cut AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM cut WHERE len(words) >= 8)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8)))::BIGINT AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice) GROUP BY doc_id
), base AS (
  SELECT c.doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM cut c LEFT JOIN covered v ON c.doc_id = v.doc_id
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN 100 * word_chars // n_words END AS length_x100,
    CASE WHEN n_words > 0 THEN 100 * n_symbols // n_words END AS symbols_per_100,
    CASE WHEN n_lines > 0 THEN 100 * n_dup_lines // n_lines END AS dup_line_percent,
    CASE WHEN n_words > 0 THEN 100 * n_repeat_words // n_words END AS repeat_percent
  FROM base
), tall AS (
  SELECT lang, source, measure, CASE WHEN v < 128 THEN v ELSE v - v % (1::BIGINT << (length(bin(v)) - 7)) END AS b
  FROM (UNPIVOT (SELECT lang, source, length_x100, symbols_per_100, dup_line_percent, repeat_percent
                 FROM judged WHERE NOT base_failed)
        ON length_x100, symbols_per_100, dup_line_percent, repeat_percent INTO NAME measure VALUE v)
), quartiles AS (
  SELECT level, lang, source, measure, n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3
  FROM (SELECT 0 AS level, lang, source, measure, b, count(*) OVER (PARTITION BY lang, source, measure) AS n FROM tall
        UNION ALL SELECT 1, lang, NULL, measure, b, count(*) OVER (PARTITION BY lang, measure) FROM tall
        UNION ALL SELECT 2, NULL, NULL, measure, b, count(*) OVER (PARTITION BY measure) FROM tall)
  GROUP BY ALL
), fences AS (
  SELECT level, lang, source, max(n) AS n,
    max(CASE measure WHEN 'length_x100' THEN q1 - 3 * greatest(q3 - q1, 50) END) AS length_min,
    max(CASE measure WHEN 'length_x100' THEN q3 + 3 * greatest(q3 - q1, 50) END) AS length_max,
    max(CASE measure WHEN 'symbols_per_100' THEN q3 + 3 * greatest(q3 - q1, 2) END) AS symbols_max,
    max(CASE measure WHEN 'dup_line_percent' THEN q3 + 3 * greatest(q3 - q1, 15) END) AS dup_max,
    max(CASE measure WHEN 'repeat_percent' THEN q3 + 3 * greatest(q3 - q1, 7) END) AS repeat_max
  FROM quartiles GROUP BY level, lang, source
), chosen AS (
  SELECT j.*, f.length_min, f.length_max, f.symbols_max, f.dup_max, f.repeat_max
  FROM judged j LEFT JOIN fences f0 ON f0.level = 0 AND f0.lang IS NOT DISTINCT FROM j.lang
      AND f0.source IS NOT DISTINCT FROM j.source
    LEFT JOIN fences f1 ON f1.level = 1 AND f1.lang IS NOT DISTINCT FROM j.lang
    LEFT JOIN fences f ON f.level = CASE WHEN f0.n >= 100 THEN 0 WHEN f1.n >= 100 THEN 1 ELSE 2 END
      AND (f.level = 2 OR f.lang IS NOT DISTINCT FROM j.lang)
      AND (f.level > 0 OR f.source IS NOT DISTINCT FROM j.source)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(length_x100 BETWEEN length_min AND length_max AND symbols_per_100 <= symbols_max
    AND dup_line_percent <= dup_max AND repeat_percent <= repeat_max, false) AS kept
FROM chosen
"""
