"""DuckDB SQL for the operators that SQL can express."""

TOPK = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e),
              lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r
  WHERE q.vec_id % 100 = 0
), k AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 10
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest
  FROM documents
), n AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rnk
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][((rnk - 1) % 3) + 1] AS DOUBLE) AS weight FROM n
), r AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size) / weight AS ratio,
         CAST(sum(source_size) OVER () AS BIGINT) AS budget
  FROM w
), lv AS (
  SELECT *,
    (budget - coalesce(sum(cap) OVER (ORDER BY ratio, rnk
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      AS level
  FROM r
), lv2 AS (SELECT *, row_number() OVER (ORDER BY ratio, rnk) AS pos FROM lv
), fr AS (SELECT pos, level FROM lv2 WHERE level * weight <= cap ORDER BY pos LIMIT 1
), t AS (
  SELECT lv2.*, CASE WHEN fr.pos IS NULL OR lv2.pos < fr.pos THEN CAST(cap AS DOUBLE)
                     ELSE fr.level * weight END AS target
  FROM lv2 LEFT JOIN fr ON true
), q AS (
  SELECT d.doc_id, d.size, d.digest, t.*,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY digest, d.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS within,
    row_number() OVER (PARTITION BY d.source ORDER BY digest, d.size) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), i AS (
  SELECT *, (turn * source_size + within) / weight AS finish
  FROM q CROSS JOIN (VALUES (0), (1), (2)) AS p(turn)
), c AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY finish, rnk, digest, size, place, turn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM i
)
SELECT doc_id, size, source_size, target,
       CAST(sum(greatest(0, least(size, budget - ahead))) AS BIGINT) AS taken
FROM c GROUP BY rnk, place, doc_id, digest, size, source_size, target
"""

# CRC-32 in SQL: the table of the reflected polynomial 0xEDB88320, then one step per byte.
_CRC = """
WITH RECURSIVE step AS (
  SELECT i AS b, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8)
"""

SPELLING = (
    _CRC
    + r"""
, run AS (
  SELECT doc_id, r, CAST(sum(m) AS BIGINT) AS m FROM (
    SELECT doc_id, text, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[A-Za-z\x{C0}-\x{FF}]+')) AS r, 1 AS m FROM documents)
  WHERE length(r) >= 5 GROUP BY doc_id, r
), hexed AS (
  SELECT r, m, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r)) AS e FROM run
), hashed AS (
  SELECT r, m, xor(4294967295, list_reduce(
      list_transform(range(1, length(e), 2), lambda p: CAST('0x' || substr(e, p, 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h
  FROM hexed, crc
), word AS (
  SELECT w AS word, CAST(sum(m) AS BIGINT) AS n FROM (
    SELECT m, CASE WHEN h % 97 = 0 THEN left(r, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2)
                   ELSE r END AS w FROM hashed)
  WHERE length(w) >= 5 GROUP BY w HAVING sum(m) >= 3
), shorter AS (
  SELECT word, n, p, left(word, p) || substr(word, p + 2) AS v
  FROM (SELECT word, n, unnest(range(length(word)))::INT AS p FROM word)
), near AS (
  SELECT DISTINCT s.word AS a, s.n AS an, w.word AS b, w.n AS bn FROM shorter s JOIN word w ON s.v = w.word
), pair AS (
  SELECT a AS word, b AS other, bn AS other_n FROM near
  UNION ALL SELECT b, a, an FROM near
  UNION ALL SELECT x.word, y.word, y.n FROM shorter x JOIN shorter y ON x.v = y.v AND x.p = y.p AND x.word <> y.word
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(minus := -other_n, other := other)) AS best
  FROM pair GROUP BY word
), form AS (
  SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN -best.minus >= 2 * n THEN best.other END AS form,
         CASE WHEN -best.minus >= 2 * n THEN CAST(-best.minus AS BIGINT) END AS form_n
  FROM word LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS here, 0 AS depth FROM form
  UNION ALL SELECT path.word, form.form, depth + 1 FROM path JOIN form ON form.word = path.here WHERE form.form IS NOT NULL
), root AS (
  SELECT word, max_by(here, depth) AS root FROM path GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM form JOIN root USING (word)
"""
)

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, row_number() OVER () AS row FROM pages
), d AS (
  SELECT page_id, row, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest
  FROM p
), f AS (
  SELECT *, row_number() OVER w AS nth, first_value(page_id) OVER w AS first
  FROM d WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, row)
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN first END AS refers_to
FROM f
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), n AS (
  SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang
), gram AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
           lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
  FROM w CROSS JOIN range(1, 6) t(k)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100
), s AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE k >= 2
), inner_phrase AS (
  SELECT lang, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2),
           lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))))) AS phrase, f
  FROM s WHERE k >= 3
), held AS (
  SELECT lang, phrase, max(f) AS held FROM inner_phrase GROUP BY ALL
), kept AS (
  SELECT s.* FROM s LEFT JOIN held USING (lang, phrase) WHERE held IS NULL OR 100 * held < 100 * f
), cut AS (
  SELECT lang, phrase, f AS a, c, array_to_string(list_slice(w, 1, c), ' ') AS x,
         array_to_string(list_slice(w, c + 1, k), ' ') AS y
  FROM kept, range(1, 5) t(c) WHERE c < k
), scored AS (
  SELECT cut.lang, cut.phrase, a, c, lf.f AS l, rf.f AS r, n.n AS n,
         (1000::HUGEINT * a * n.n) // (lf.f::HUGEINT * rf.f) AS score
  FROM cut JOIN f lf ON lf.lang = cut.lang AND lf.phrase = x
           JOIN f rf ON rf.lang = cut.lang AND rf.phrase = y
           JOIN n ON n.lang = cut.lang
), low AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS nth FROM scored)
  WHERE nth = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
