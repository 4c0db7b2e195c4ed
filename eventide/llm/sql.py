"""DuckDB forms of the queries that SQL can express."""

LINE_WINDOWS = r"""
WITH ls AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL
), full_lines AS (
  SELECT doc_id, text, pos, trim(line, ' ' || chr(9) || chr(13)) AS l FROM ls
  WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
), win AS (
  SELECT doc_id, text, pos AS a, lead(pos, 2) OVER d AS b,
         l || chr(10) || lead(l, 1) OVER d || chr(10) || lead(l, 2) OVER d AS w
  FROM full_lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), firsts AS (
  SELECT w, min(doc_id * 1000000 + a) AS place FROM win WHERE w IS NOT NULL GROUP BY w HAVING count(*) > 1
), cut AS (
  SELECT DISTINCT win.doc_id, unnest(range(a, b + 1)) AS pos
  FROM win JOIN firsts USING (w) WHERE win.doc_id * 1000000 + a <> place
), kept AS (
  SELECT ls.doc_id, string_agg(line, chr(10) ORDER BY ls.pos) FILTER (WHERE cut.pos IS NULL) AS text,
         count(*) AS n_lines, count(cut.pos) AS n_removed
  FROM ls LEFT JOIN cut ON ls.doc_id = cut.doc_id AND ls.pos = cut.pos GROUP BY ls.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

_STRIPPED = "regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^https?://', '', 'i')"
_HOST = ("regexp_replace(regexp_replace(lower(regexp_extract(s, '^[^/?]*')), '^(?:www|m)\\.', ''), "
         "':(?:80|443)$', '')")
_PATH = "regexp_replace(regexp_replace(regexp_extract(s, '^[^/?]*([^?]*)', 1), '\\.html?$', ''), '/+$', '')"
_QUERY = ("regexp_replace(regexp_replace(regexp_extract(s, '\\?(.*)$', 1), "
          "'(?:^|&)(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*', '', 'g'), '^&', '')")

REVISITS = f"""
WITH made AS (
  SELECT page_id * 5 + k AS record_id, k, md5(html) AS tag, strlen(html) AS size,
         (page_id * 997 + k * 7919) % 100000 AS minute,
         CASE k WHEN 1 THEN url || '#top' WHEN 2 THEN regexp_replace(url, '^https?://', 'HTTPS://www.') ELSE url END AS url
  FROM pages CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k)
), stripped AS (SELECT *, {_STRIPPED} AS s FROM made),
canon AS (
  SELECT *, {_HOST} || {_PATH} || CASE WHEN {_QUERY} <> '' THEN '?' || {_QUERY} ELSE '' END AS u FROM stripped
), met AS (
  SELECT v.record_id, v.u, v.k, v.tag AS vtag, v.minute AS vmin, r.record_id AS response_id, r.tag AS rtag, r.size, r.minute AS rmin
  FROM (SELECT * FROM canon WHERE k > 0) v
  LEFT JOIN (SELECT * FROM canon WHERE k = 0) r ON v.u = r.u AND r.minute < v.minute
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.minute DESC NULLS LAST, r.record_id DESC NULLS LAST) = 1
), judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'orphan'
                 WHEN k IN (1, 2, 4) AND vtag = rtag THEN 'resolved' ELSE 'mismatch' END AS outcome FROM met
)
SELECT record_id, u AS url, response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'age=' || k || ';content-length=' || size || ';date=' || vmin || ';etag=' || vtag
            || ';server=origin' END AS merged
FROM judged
"""

HARD_NEGATIVES = """
WITH base AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM base a JOIN base b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM pos JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
