"""DuckDB SQL of the queries that SQL can express."""

SQL = {}

SQL["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), judged AS (
  SELECT doc_id, line, pos,
         length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone
  FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SQL["op4_rule_cascade"] = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM split WHERE len(words) >= 8
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM places
), repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM windows WHERE n > 1) GROUP BY doc_id
), counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_upper
  FROM split LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 8 * word_chars
            OR n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines OR 100 * n_upper > 40 * word_chars) AS kept
FROM counted
"""

SQL["op7_chat_masks"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|turn|>') + length(replace(replace(replace(role, '\', '\\'), '<|', '\<|'), chr(10), '\n'))
             + 1 + length(replace(replace(text, '\', '\\'), '<|', '\<|')) + length('<|over|>') + 1) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""

# Components: the smallest node that links reach, by a recursion over all nodes reached.
REACHED = """reached AS (
  SELECT a AS node, b AS other FROM links
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
)"""

SQL["op8_minhash_hamming"] = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM split WHERE len(words) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle, least(len(words), 5) AS span FROM places
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.span = y.span AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.n + q.n - common)
), {REACHED}
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(least_other, doc_id)) AS component_id,
       doc_id <= coalesce(least_other, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT node AS doc_id, min(other) AS least_other FROM reached GROUP BY node) USING (doc_id)
"""

SQL["op10_flat_graph"] = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS size
  FROM embeddings
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id
  WHERE list_dot_product(x.v, y.v) >= 0.95 * x.size * y.size
), {REACHED}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
       least(vec_id, coalesce(least_other, vec_id)) AS component_id, vec_id <= coalesce(least_other, vec_id) AS kept,
       true AS recall_reached
FROM embeddings LEFT JOIN (SELECT node AS vec_id, min(other) AS least_other FROM reached GROUP BY node) USING (vec_id)
"""


_TERMS = r"""unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

SQL["op12_bitsliced_search"] = f"""
WITH held AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY doc_id, term
), sizes AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id
), sums AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, sums GROUP BY term
), wanted AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY item_id, term
), scored AS (
  SELECT item_id, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), sums GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

# Rounds of assignment and update, one after the other; distance and number in one integer, ties to the smaller number.
_ROUND = """
), a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(k.v) AS v,
         min(16 * CAST(list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) AS BIGINT) + c.c) AS best
  FROM kept k, c{i} c GROUP BY vec_id
), m{i} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT best % 16 AS c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{i}) GROUP BY c, i
), c{j} AS MATERIALIZED (
  SELECT c.c, coalesce(n.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM m{i} GROUP BY c
  ) n ON n.c = c.c
"""

SQL["op13_laesa_clusters"] = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT 16)
{"".join(_ROUND.format(i=i, j=i + 1) for i in range(4))}
), done AS (
  SELECT vec_id, CAST(best % 16 AS INT) AS cluster, best // 16 AS distance FROM a3
)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM done JOIN c3 ON c3.c = cluster
"""
