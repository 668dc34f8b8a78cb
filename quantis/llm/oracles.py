"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

OP4 = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 13)
              AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CAST(1 + (row_number() OVER (ORDER BY (source IS NULL), encode(source)) - 1) % 3 AS DOUBLE) AS weight,
         CAST(3 * source_size AS DOUBLE) AS most
  FROM per),
filled AS (  -- level when the sources before this one (by most / weight) are capped and the others are not
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0)) / sum(weight) OVER rest AS level
  FROM ranked
  WINDOW before AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
fill AS (SELECT coalesce(arg_min(level, most / weight) FILTER (WHERE weight * level < most), 0) AS level FROM filled),
plan AS (
  SELECT source, source_size, least(weight * level, most) AS target,
         CASE WHEN source_size > 0 THEN least(weight * level, most) / source_size ELSE 0 END AS rate
  FROM ranked, fill)
SELECT s.doc_id, s.size, p.source_size, p.target,
       CASE WHEN s.size > 0 THEN CAST(floor(p.rate) AS BIGINT) + CAST(s.draw < p.rate - floor(p.rate) AS BIGINT) ELSE 0 END
         AS copies,
       s.size * CASE WHEN s.size > 0 THEN CAST(floor(p.rate) AS BIGINT) + CAST(s.draw < p.rate - floor(p.rate) AS BIGINT)
         ELSE 0 END AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
"""

OP1 = r"""
WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT r, unnest(range(1, len(words) - 33)) AS s, words FROM worded WHERE len(words) >= 35),
named AS (SELECT r, s, md5(array_to_string(words[s:s + 34], ' ')) AS w FROM windows),
repeated AS (SELECT r, s FROM named QUALIFY count(*) OVER (PARTITION BY w) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM repeated),
placed AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM worded),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM placed ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (r)
"""

OP2 = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT r, md5(array_to_string(words[s:s + 3], ' ')) AS w
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 2, 2))) AS s FROM worded WHERE len(words) > 0) GROUP BY ALL),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.w = b.w AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r, r AS other FROM worded UNION SELECT reach.r, b FROM reach JOIN both_ways ON a = other),
named AS (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN worded o ON o.r = other GROUP BY reach.r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM worded JOIN named USING (r) LEFT JOIN sizes USING (r)
"""

OP6 = r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id != c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

OP13 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda x: x <> '') AS ws FROM pieces
), totals AS (
    SELECT lang, sum(len(ws)) AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
    FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k
), counts AS (
    SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 100
), parts AS (
    SELECT *, string_split(phrase, ' ') AS ws FROM counts
), covered AS (
    SELECT lang, array_to_string(ws[1:k - 1], ' ') AS phrase, n FROM parts WHERE k > 2
    UNION ALL SELECT lang, array_to_string(ws[2:k], ' '), n FROM parts WHERE k > 2
), most AS (
    SELECT lang, phrase, max(n) AS n FROM covered GROUP BY ALL
), cuts AS (
    SELECT p.lang, p.phrase, p.n AS a, c.j, l.n AS l, r.n AS r, t.n AS n,
           (1000::HUGEINT * p.n * t.n) // (l.n::HUGEINT * r.n) AS score
    FROM parts p, (SELECT unnest(range(1, 5)) AS j) c, counts l, counts r, totals t
    WHERE c.j < p.k AND l.lang = p.lang AND l.phrase = array_to_string(p.ws[1:c.j], ' ')
      AND r.lang = p.lang AND r.phrase = array_to_string(p.ws[c.j + 1:p.k], ' ') AND t.lang = p.lang
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
    SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
    FROM best b LEFT JOIN most m ON m.lang = b.lang AND m.phrase = b.phrase
    WHERE m.n IS NULL OR m.n < b.a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op6_mtree_top_k": OP6, "op2_minhash_near_dedup": OP2, "op1_substring_dedup": OP1, "op4_mix_sources": OP4, "op13_collocations": OP13,
}
