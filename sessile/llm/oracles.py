"""SQL that gives the rows of the operators that SQL can express, over the same tables."""

LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, n AS line_no, s FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS s, unnest(range(len(string_split(text, chr(10))))) AS n FROM documents)
  WHERE regexp_matches(s, '[^\x20\x09-\x0D]')
), t AS (
  SELECT doc_id, line_no, array_to_string(regexp_extract_all(s, '[^\x20\x09-\x0D]+'), ' ') AS exact,
    regexp_extract_all(regexp_replace(s, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[^\x20\x09-\x0D]+') AS tokens FROM l
), k AS (
  SELECT doc_id, line_no, exact, tokens, array_to_string(tokens, ' ') AS body, CAST(len(tokens) AS VARCHAR) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf,
    len(tokens) AS size, len(list_filter(tokens, lambda x: x <> '<*>')) AS words FROM t
), reached AS (
  SELECT leaf, count(DISTINCT doc_id) >= 5 AS deep FROM k GROUP BY leaf
  HAVING count(DISTINCT doc_id) >= 5 OR (any_value(size) >= 50 AND count(DISTINCT doc_id) >= 2)
), bodies AS (
  SELECT leaf, body, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS docs FROM k JOIN reached USING (leaf) WHERE deep GROUP BY leaf, body
), tok AS (
  SELECT leaf, body, docs, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM bodies
), common AS (
  SELECT leaf, pos, token FROM tok WHERE token <> '<*>' GROUP BY ALL HAVING sum(docs) >= 5
), shape AS (
  SELECT tok.leaf, tok.body, string_agg(CASE WHEN common.token IS NULL THEN '<*>' ELSE tok.token END, ' ' ORDER BY tok.pos) AS shape,
    count(common.token) AS constants
  FROM tok LEFT JOIN common USING (leaf, pos, token) GROUP BY tok.leaf, tok.body
), placed AS (
  SELECT k.leaf, doc_id, line_no, size, CASE WHEN words * 2 < size THEN 'exact ' || exact
    WHEN size >= 6 AND constants >= 0.75 * size THEN 'general ' || shape ELSE 'as it is ' || k.body END AS template
  FROM k JOIN reached ON k.leaf = reached.leaf LEFT JOIN shape ON k.leaf = shape.leaf AND k.body = shape.body
), ranked AS (
  SELECT *, count(DISTINCT doc_id) OVER (PARTITION BY leaf, template) AS docs, row_number() OVER (PARTITION BY leaf, template ORDER BY doc_id, line_no) AS rn FROM placed
), gone AS (
  SELECT doc_id, list(line_no ORDER BY line_no) AS dropped FROM ranked WHERE (docs >= 5 OR (size >= 50 AND docs >= 2)) AND rn > 1 GROUP BY doc_id
), left_over AS (
  SELECT d.doc_id, len(string_split(text, chr(10))) AS n_lines, coalesce(dropped, []) AS dropped,
    array_to_string(list_transform(list_filter(range(len(string_split(text, chr(10)))), lambda i: NOT list_contains(coalesce(dropped, []), i)), lambda i: string_split(text, chr(10))[i + 1]), chr(10)) AS kept
  FROM documents d LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(len(dropped) AS BIGINT) AS n_dropped, array_to_string(dropped, ',') AS dropped,
  CAST(length(coalesce(kept, '')) AS BIGINT) AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM left_over
"""

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.vector) + 1), lambda i: q.vector[i] * c.vector[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vector) = len(c.vector)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.vector) + 1), lambda i: a.vector[i] * c.vector[i])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.vector) = len(c.vector)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), tokens AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM tokens, range(1, 6) AS lengths(k)
), f AS MATERIALIZED (
  SELECT lang, phrase, count(*) AS n, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL HAVING count(*) >= 100
), total AS (
  SELECT lang, sum(len(w)) AS n FROM tokens GROUP BY lang
), inner_ones AS (
  SELECT DISTINCT lang, n, unnest([array_to_string(w[i:j], ' ')]) AS phrase
  FROM f, range(1, 6) AS starts(i), range(1, 6) AS ends(j)
  WHERE i <= j AND j <= len(w) AND j - i + 1 < len(w)
), kept AS (
  SELECT f.* FROM f ANTI JOIN inner_ones USING (lang, phrase, n) WHERE len(w) > 1
), cuts AS (
  SELECT kept.lang, kept.phrase, kept.n AS a, k, a.n AS l, b.n AS r, total.n AS n,
    (1000::HUGEINT * kept.n * total.n) // (a.n::HUGEINT * b.n) AS score
  FROM kept JOIN range(1, 5) AS places(k) ON k < len(kept.w)
  JOIN f AS a ON a.lang = kept.lang AND a.phrase = array_to_string(kept.w[1:k], ' ')
  JOIN f AS b ON b.lang = kept.lang AND b.phrase = array_to_string(kept.w[k + 1:], ' ')
  JOIN total ON total.lang = kept.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

#: Rules of op9 in their order.
_RULES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")


def _each(text: str, between: str) -> str:
    return between.join(text.replace("{r}", r) for r in _RULES)


HOST_RULES = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words) AS n FROM win) WHERE n > 1
), cover AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice) GROUP BY doc_id
), f AS (
  SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM d LEFT JOIN cover USING (doc_id)
), b AS (
  SELECT *, n_words < 20 AS few_words, 100 * n_repeat_words > 30 * n_words AS repeats, 100 * n_symbols > 10 * n_words AS symbols,
    100 * n_dup_lines > 30 * n_lines AS dup_lines, word_chars < 3 * n_words OR word_chars > 10 * n_words AS word_length
  FROM f
), h AS (
  SELECT source, count(*) AS docs, {_each("CAST(sum({r}::INT) AS DOUBLE) AS {r}", ", ")} FROM b GROUP BY source
), o AS (
  SELECT avg(1.0::DOUBLE / docs) AS noise, {_each("sum({r}) / sum(docs) AS m_{r}, avg({r} / docs * {r} / docs) AS square_{r}, avg({r} / docs) AS first_{r}", ", ")} FROM h
), s AS (
  SELECT *, {_each("m_{r} * (1 - m_{r}) AS spread_{r}, square_{r} - first_{r} * first_{r} - m_{r} * (1 - m_{r}) * noise AS signal_{r}", ", ")} FROM o
), p AS (
  SELECT *, {_each("CASE WHEN signal_{r} > 0 AND spread_{r} > 0 THEN least(1000.0::DOUBLE, greatest(1.0::DOUBLE, spread_{r} / signal_{r} - 1)) ELSE 1000.0::DOUBLE END AS strength_{r}", ", ")} FROM s
), q AS (
  SELECT source, docs, {_each("m_{r}, strength_{r}, ({r} + m_{r} * strength_{r}) / (docs + strength_{r}) AS rate_{r}", ", ")} FROM h, p
), z AS (
  SELECT *, {_each("sqrt(rate_{r} * (1 - rate_{r}) / (docs + strength_{r} + 1)) AS sd_{r}", ", ")} FROM q
), v AS (
  SELECT source, docs AS host_docs, greatest({_each("rate_{r}", ", ")}) AS rate, {_each("rate_{r} - 2 * sd_{r} > 3 * m_{r} AND rate_{r} > 0.2", " OR ")} AS host_failed,
    list_filter([{_each("CASE WHEN rate_{r} - m_{r} > sd_{r} THEN '{r}' END", ", ")}], lambda x: x IS NOT NULL) AS stands_out
  FROM z
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed, host_docs, round(rate, 6) AS host_rate, host_failed,
  array_to_string(list_filter([{_each("CASE WHEN {r} THEN '{r}' END", ", ")}], lambda x: x IS NOT NULL), ',') AS failed_rules, array_to_string(stands_out, ',') AS host_stands_out,
  NOT (few_words OR repeats OR host_failed OR {_each("({r} AND list_contains(stands_out, '{r}'))", " OR ")}) AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""

NEAR_DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL) c
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 75 * (na.n + nb.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(b) AS component_id, min(b) = d.doc_id AS kept
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
