"""The queries of this folder in SQL, where SQL can express them on whole tables."""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) AS number,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         2.0::DOUBLE * source_size AS most
  FROM sizes
), running AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (ORDER BY most / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM weighed
), marked AS (
  SELECT *, (total - 2.0::DOUBLE * before) * weight > most * after AS capped FROM running
), levels AS (
  SELECT *, (total - 2.0::DOUBLE * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ())
            / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0) AS level
  FROM marked
), targets AS (
  SELECT source, source_size,
         coalesce(CASE WHEN capped THEN most ELSE least(most, weight * level) END, 0) AS target
  FROM levels
), rated AS (
  SELECT doc_id, size, source_size, target,
         least(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END, 2.0::DOUBLE) AS rate,
         ('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || digest || ':' || number), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS draw
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
), counted AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM rated
)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(copies AS BIGINT) AS copies, CAST(copies * size AS BIGINT) AS taken
FROM counted
"""

TOKEN_COUNTS = r"""
SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
FROM documents
"""

LM_SCORING = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\S+') AS w FROM documents
), places AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words
), grams AS (
  SELECT doc_id, word, lag(word) OVER byplace AS prior, lag(word, 2) OVER byplace AS first
  FROM places WINDOW byplace AS (PARTITION BY doc_id ORDER BY place)
), corpus AS (SELECT count(*) AS n FROM places),
one AS (SELECT word, count(*) AS c FROM places GROUP BY word),
own_one AS (SELECT doc_id, word, count(*) AS c FROM places GROUP BY doc_id, word),
two AS (SELECT prior, word, count(*) AS c FROM grams WHERE prior IS NOT NULL GROUP BY ALL),
own_two AS (SELECT doc_id, prior, word, count(*) AS c FROM grams WHERE prior IS NOT NULL GROUP BY ALL),
three AS (SELECT first, prior, word, count(*) AS c FROM grams WHERE first IS NOT NULL GROUP BY ALL),
own_three AS (SELECT doc_id, first, prior, word, count(*) AS c FROM grams WHERE first IS NOT NULL GROUP BY ALL),
sizes AS (SELECT doc_id, len(w) AS m FROM words),
looked AS (
  SELECT p.doc_id, p.prior, p.first,
         coalesce(three.c - own_three.c, 0) AS triple, ctx2.c - own_ctx2.c AS pair_context,
         coalesce(two.c - own_two.c, 0) AS pair, ctx.c - own_ctx.c AS context, one.c - own_one.c AS single,
         greatest(n - m, 1) AS others
  FROM grams p JOIN sizes ON p.doc_id = sizes.doc_id CROSS JOIN corpus
  JOIN one ON p.word = one.word
  JOIN own_one ON p.doc_id = own_one.doc_id AND p.word = own_one.word
  LEFT JOIN one ctx ON p.prior = ctx.word
  LEFT JOIN own_one own_ctx ON p.doc_id = own_ctx.doc_id AND p.prior = own_ctx.word
  LEFT JOIN two ON p.prior = two.prior AND p.word = two.word
  LEFT JOIN own_two ON p.doc_id = own_two.doc_id AND p.prior = own_two.prior AND p.word = own_two.word
  LEFT JOIN two ctx2 ON p.first = ctx2.prior AND p.prior = ctx2.word
  LEFT JOIN own_two own_ctx2 ON p.doc_id = own_ctx2.doc_id AND p.first = own_ctx2.prior AND p.prior = own_ctx2.word
  LEFT JOIN three ON p.first = three.first AND p.prior = three.prior AND p.word = three.word
  LEFT JOIN own_three ON p.doc_id = own_three.doc_id AND p.first = own_three.first AND p.prior = own_three.prior
    AND p.word = own_three.word
), summed AS (
  SELECT doc_id, sum(CASE
    WHEN triple > 0 THEN log10(triple / pair_context::DOUBLE)
    WHEN pair > 0 THEN CASE WHEN first IS NULL THEN 0 ELSE log10(0.4::DOUBLE) END + log10(pair / context::DOUBLE)
    ELSE (CASE WHEN first IS NULL THEN 0 ELSE 1 END + CASE WHEN prior IS NULL THEN 0 ELSE 1 END) * log10(0.4::DOUBLE)
         + log10(greatest(single, 1) / others::DOUBLE) END) AS score
  FROM looked GROUP BY doc_id
)
SELECT sizes.doc_id, CAST(m AS BIGINT) AS n_words, round(coalesce(score, 0), 3) AS log10_score,
       CASE WHEN m > 0 THEN round(score / m, 5) END AS log10_per_word
FROM sizes LEFT JOIN summed ON sizes.doc_id = summed.doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND list_max(list_transform(embedding, lambda c: abs(c))) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.a LEFT JOIN counted ON e.vec_id = counted.a
"""

NGRAM_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\S+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links
FROM documents d JOIN least ON d.doc_id = least.a LEFT JOIN counted ON d.doc_id = counted.a
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)
), sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), phrases AS (
  SELECT lang, w[i:i + k - 1] AS words, k, count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT p.lang, p.words, p.f AS a, c AS cut, x.f AS l, y.f AS r, n,
         CAST((1000::HUGEINT * p.f * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM phrases p JOIN (SELECT unnest([1, 2, 3, 4]) AS c) ON c < k JOIN sizes ON p.lang = sizes.lang
  JOIN phrases x ON x.lang = p.lang AND x.words = p.words[:c]
  JOIN phrases y ON y.lang = p.lang AND y.words = p.words[c + 1:]
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1
), parts AS (
  SELECT DISTINCT lang, words[s:s + m - 1] AS words, f
  FROM phrases, (SELECT unnest([2, 3, 4]) AS m), (SELECT unnest([1, 2, 3, 4]) AS s)
  WHERE m < k AND s + m - 1 <= k
), kept AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score FROM weakest
  WHERE NOT EXISTS (SELECT 1 FROM parts WHERE parts.lang = weakest.lang AND parts.words = weakest.words AND 100 * parts.f >= 100 * a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def vector_codes(rounds: int = 4) -> str:
    """The codebooks in SQL: a round after the other, every part against every entry."""
    steps = [r"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS i
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), width AS (SELECT CAST(ceil(max(len(v)) / 4.0) AS BIGINT) AS d FROM kept),
cells AS MATERIALIZED (
  SELECT i, p, q, coalesce(v[p * d + q + 1], 0) AS x
  FROM kept, width, (SELECT unnest(range(4)) AS p), LATERAL (SELECT unnest(range(d)) AS q)
), book0 AS MATERIALIZED (SELECT p, CAST(i - 1 AS BIGINT) AS e, q, x AS y FROM cells WHERE i <= 256)"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT i, p, arg_min(e, d2 * 256 + e) AS e, min(d2) AS d2
  FROM (SELECT i, cells.p, e, sum((x - y) * (x - y)) AS d2 FROM cells JOIN book{k} b ON cells.p = b.p AND cells.q = b.q GROUP BY ALL)
  GROUP BY i, p
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.q, CASE WHEN c IS NULL THEN y ELSE CAST((s - ((s % c) + c) % c) // c AS BIGINT) END AS y
  FROM book{k} b LEFT JOIN (
    SELECT cells.p, e, q, CAST(sum(x) AS BIGINT) AS s, count(*) AS c
    FROM cells JOIN near{k} n ON cells.i = n.i AND cells.p = n.p GROUP BY ALL
  ) m ON b.p = m.p AND b.e = m.e AND b.q = m.q
)""")
    return ",\n".join(steps) + f""", coded AS (
  SELECT i, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d2) AS BIGINT) AS error FROM near{rounds} GROUP BY i
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, q)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded ON kept.i = coded.i
"""


ORACLES = {
    "op2_lm_scoring": LM_SCORING,
    "op3_embeddings": EMBEDDINGS,
    "op4_ngram_join": NGRAM_JOIN,
    "op6_token_counts": TOKEN_COUNTS,
    "op7_mixing": MIXING,
    "op11_collocations": COLLOCATIONS,
    "op12_vector_codes": vector_codes(),
}
