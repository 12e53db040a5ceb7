"""SQL for the queries of this folder whose results SQL can express.

The models (4, 6, 8, 9), the packing (1), the codecs (2, 12), XXH64 fingerprints (3)
and SimHash line groups (7) have none; tests compare them with brute force,
exact round trips or held-out rows.
"""

QUALITY_RULES = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT r, doc_id, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM docs),
windows AS (
  SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM parts WHERE len(ws) >= 5)),
again AS (
  SELECT r, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
measures AS (
  SELECT doc_id, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines,
         length(regexp_replace(t, '[^A-ZÄÖÜÀÂÇÈÉÊËÎÏÔÙÛÁÍÓÚÑ]', '', 'g')) AS n_capitals
  FROM parts LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         100 * n_symbols > 8 * word_chars
         OR word_chars > 15 * n_words OR 2 * word_chars < 3 * n_words
         OR (n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines)
         OR 2 * n_capitals > word_chars AS rejected
  FROM measures)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND NOT rejected AS kept
FROM judged
"""

EMBEDDING_NEARDUP = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x)) AS bad
  FROM embeddings),
usable AS (
  SELECT vec_id, label, e FROM vectors
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(bad) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM vectors
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM vectors v JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)
"""

_KMEANS_START = """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM kept),
seeds AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS c, e
  FROM kept ORDER BY c LIMIT 16),
cents0 AS (SELECT c, unnest(e) AS y, generate_subscripts(e, 1) AS i FROM seeds),
"""

_KMEANS_ROUND = """
near{n} AS (
  SELECT r, c, d FROM (
    SELECT r, c, sum((x - y) * (x - y)) AS d FROM parts JOIN cents{n} USING (i) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1),
"""

_KMEANS_MOVE = """
means{n} AS (
  SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS y
  FROM near{m} JOIN parts USING (r) GROUP BY c, i),
cents{n} AS (
  SELECT c, i, coalesce(m.y, old.y)::BIGINT AS y FROM cents{m} old LEFT JOIN means{n} m USING (c, i)),
"""

KMEANS = (
    _KMEANS_START
    + "".join(_KMEANS_ROUND.format(n=n) + _KMEANS_MOVE.format(n=n + 1, m=n) for n in range(3))
    + _KMEANS_ROUND.format(n=3)
    + """
digests AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM cents3 GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       centroid_sha256
FROM near3 JOIN kept USING (r) JOIN digests USING (c)
"""
)

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
worded AS (
  SELECT p, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, n AS k, array_to_string(ws[i:i + n - 1], ' ') AS phrase, ws[i:i + n - 1] AS g
  FROM (SELECT lang, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM worded, (VALUES (1), (2), (3)) t(n) WHERE len(ws) >= n)),
counted AS (SELECT lang, k, g, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= 10),
candidates AS (SELECT * FROM frequent WHERE k >= 2),
inside AS (
  SELECT lang, g[i:i + 1] AS g, max(f) AS longer
  FROM (SELECT lang, g, f, unnest([1, 2]) AS i FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside s ON c.k = 2 AND c.lang = s.lang AND c.g = s.g
  WHERE s.longer IS NULL OR 100 * s.longer < 50 * c.f),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k1, x.f AS l, y.f AS r, (1000000 * c.f * c.f) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS k1 FROM kept) c
  JOIN frequent x ON x.lang = c.lang AND x.g = c.g[1:k1]
  JOIN frequent y ON y.lang = c.lang AND y.g = c.g[k1 + 1:c.k]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k1) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op5_quality_rules": QUALITY_RULES,
    "op10_embedding_neardup": EMBEDDING_NEARDUP,
    "op11_shallot_clusters": KMEANS,
    "op13_collocations": COLLOCATIONS,
}
