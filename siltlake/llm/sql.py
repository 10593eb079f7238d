"""The operators that SQL can express, in SQL over the same tables."""

from __future__ import annotations

SQL = {
    # Shares of the sources with closed bounds, then the order of random odds by
    # inclusion odds, filled with whole documents and one that closes the gap.
    "op2_pareto_mix": r"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS words,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(1000 * size // (size + 100) * size)::DOUBLE AS favours FROM docs GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         sum(source_size) OVER () * 1.5::DOUBLE AS total
  FROM sources
), levels AS (
  SELECT *, (total - coalesce(sum(source_size * 2.0::DOUBLE) OVER (
               ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (
               ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), chosen AS (
  SELECT arg_min(level, source_size / weight) AS level FROM levels WHERE level * weight <= source_size * 2.0::DOUBLE
), planned AS (
  SELECT source, source_size, favours,
         coalesce(least(weight * (SELECT level FROM chosen), source_size * 2.0::DOUBLE), source_size * 2.0::DOUBLE)::DOUBLE AS target
  FROM levels
), parted AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0.0 END AS part
  FROM planned
), ranked AS (
  SELECT d.doc_id, d.size, p.*, p.target - p.whole * p.source_size AS wanted,
         md5(concat_ws(':', 'mix', coalesce(d.doc_id::VARCHAR, ''), d.size::VARCHAR, d.words)) AS digest,
         least(p.part * ((1000 * d.size // (d.size + 100))::DOUBLE * p.source_size::DOUBLE / p.favours), 0.999::DOUBLE) AS chance
  FROM docs d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source
), random AS (
  SELECT *, ('0x' || substr(digest, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM ranked
), placed AS (
  SELECT *, CASE WHEN part > 0 AND size > 0 THEN (u / (1 - u)) / (chance / (1 - chance)) END AS odds FROM random
), run AS (
  SELECT *, sum(CASE WHEN odds IS NOT NULL THEN size END) OVER in_order AS through, row_number() OVER in_order AS place
  FROM placed WINDOW in_order AS (PARTITION BY source ORDER BY odds NULLS LAST, digest ROWS UNBOUNDED PRECEDING)
), cut AS (
  SELECT source AS cut_source, max(wanted) - coalesce(max(through) FILTER (through <= wanted), 0) AS gap
  FROM run WHERE odds IS NOT NULL GROUP BY source
), closing AS (
  SELECT source AS closing_source, min({'gap': abs(gap - size), 'odds': odds, 'digest': digest, 'place': place}) AS best
  FROM run JOIN cut ON source IS NOT DISTINCT FROM cut_source
  WHERE odds IS NOT NULL AND through > wanted AND abs(gap - size) < gap GROUP BY source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN odds IS NOT NULL AND (through <= wanted OR place = best.place)
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run LEFT JOIN closing ON source IS NOT DISTINCT FROM closing_source
""",
    # Without filters: every rule against every url.
    "op5_bloom_cascade": r"""
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), urls AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT u.page_id, u.host, u.path, r.verdict, r.host || r.path AS rule
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM fits GROUP BY page_id, host, path
""",
    # Every phrase of up to three words, counted by grouping.
    "op12_phrase_automata": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), split AS (
  SELECT lang, row_number() OVER () AS place, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
  SELECT lang, place, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split
), runs AS (
  SELECT lang, word AS w1, lead(word, 1) OVER onward AS w2, lead(word, 2) OVER onward AS w3
  FROM words WINDOW onward AS (PARTITION BY place ORDER BY i)
), grams AS (
  SELECT lang, w1 AS phrase, 1 AS size FROM runs
  UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM runs WHERE w3 IS NOT NULL
), f AS (
  SELECT lang, phrase, size, string_split(phrase, ' ') AS w, count(*)::BIGINT AS f FROM grams GROUP BY lang, phrase, size
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, w, size, f AS a FROM f WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT *, array_to_string(w[1:k], ' ') AS front, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.front JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covering AS (
  SELECT lang, part, max(a) AS longer
  FROM (SELECT lang, array_to_string(w[1:2], ' ') AS part, a FROM candidates WHERE size = 3
        UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE size = 3)
  GROUP BY lang, part
), ranked AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
         row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM weakest s LEFT JOIN covering c ON c.lang = s.lang AND c.part = s.phrase
  WHERE c.longer IS NULL OR 100 * c.longer < 50 * s.a
)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
