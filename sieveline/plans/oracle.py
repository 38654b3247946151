"""SQL over the given tables that each registered query must agree with."""

from sieveline.plans.catalog import CELLS, CLUSTERS, COMMON, CUT, KEEP, POOL_CUT, PRUNED_BLOCK, SINCE, TARGET, TARGET_RECALL, TEXT_DEPTH
from sieveline.plans.standins import DEPTH, DIM, EXCLUDED
from sieveline.settings import MAX_TOKENS, RERANK_SEED, VECTOR_DIM

PREFIX = "https://openalex.org/"

WORKS = """works AS (
  SELECT doc_id, 'W' || doc_id AS id, 'https://doi.org/10.' || source || '/' || doc_id AS doi,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS abstract
  FROM documents)"""

DATES = """dates AS (
  SELECT 'W' || o_orderkey AS id, CAST(o_orderdate AS DATE) AS publication_date,
         CAST(year(o_orderdate) AS INTEGER) AS publication_year
  FROM orders)"""

MATCH = " OR ".join(f"contains(lower(doi), '{doi.lower()}')" for doi in EXCLUDED)

REVIEW = f"""review AS (
  SELECT doc_id, '{PREFIX}' || id AS id, doi, title, abstract, toxic AS label_included, quality,
         ({MATCH}) AS extra_excluded
  FROM labels JOIN works USING (doc_id))"""

SEEDS = f"""seeds AS (
  SELECT vec_id AS query_pos, '{PREFIX}W' || vec_id AS query_id, embedding::DOUBLE[] AS qv
  FROM review JOIN embeddings ON vec_id = doc_id
  WHERE label_included = 1 AND NOT extra_excluded)"""

CRITERIA = f"""criteria AS (
  SELECT '{PREFIX}W' || vec_id AS query_id, embedding::DOUBLE[] AS qv
  FROM embeddings WHERE vec_id = (SELECT max(vec_id) FROM embeddings))"""

HITS = f"""hits AS (
  SELECT query_pos, query_id, CAST(n - 1 AS INTEGER) AS rank, id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) AS n FROM (
      SELECT query_pos, query_id, 'W' || vec_id AS id, list_distance(qv, embedding::DOUBLE[]) AS distance
      FROM seeds, embeddings))
  WHERE n <= {DEPTH})"""

NEAR = f"""near AS (
  SELECT CAST(n - 1 AS INTEGER) AS rank, id, distance FROM (
    SELECT *, row_number() OVER (ORDER BY distance, id) AS n FROM (
      SELECT 'W' || vec_id AS id, list_distance(qv, embedding::DOUBLE[]) AS distance FROM criteria, embeddings))
  WHERE n <= {DEPTH})"""

POOL = f"""pool AS (
  SELECT id, rank FROM (
    SELECT id, rank, row_number() OVER (PARTITION BY id ORDER BY query_pos, rank) AS n FROM hits WHERE rank < {CUT})
  WHERE n = 1)"""

LOWEST = "lowest AS (SELECT id, min(rank) AS rank FROM hits GROUP BY id)"

CURVE = f"""curve AS (
  SELECT CAST(r AS INTEGER) AS rank, count(id) AS n, CAST(sum(count(id)) OVER (ORDER BY r) AS BIGINT) AS n_ids
  FROM range({DEPTH}) AS t(r) LEFT JOIN lowest ON rank = r GROUP BY r)"""

EDGES = "edges AS (SELECT DISTINCT 'W' || l_orderkey AS citing, 'W' || l_partkey AS cited FROM lineitem)"

SEED_IDS = "seed_ids AS (SELECT 'W' || doc_id AS id FROM review WHERE label_included = 1 AND NOT extra_excluded)"

SNOWBALL = """first_hop AS (SELECT DISTINCT citing AS id FROM edges WHERE cited IN (SELECT id FROM seed_ids)),
second_hop AS (SELECT DISTINCT citing AS id FROM edges WHERE cited IN (SELECT id FROM first_hop)),
snowball AS (
  SELECT id, CASE WHEN id IN (SELECT id FROM first_hop) THEN 'primary' ELSE 'secondary' END AS level
  FROM (SELECT id FROM first_hop UNION SELECT id FROM second_hop)
  WHERE id NOT IN (SELECT 'W' || doc_id FROM labels))"""

MASTER = """master AS (
  SELECT 'M' || doc_id AS MID, CASE WHEN quality = 1 THEN id END AS openalex_id,
         CASE WHEN quality = 1 THEN doi END AS doi, CASE WHEN label_included = 0 THEN title END AS title, abstract,
         label_included AS Data_0_Synergy, CASE WHEN quality = 1 THEN label_included END AS Data_3b_old
  FROM review)"""

BASE = [WORKS, REVIEW, SEEDS]
RESPONSES = [*BASE, HITS]

CHECKSUM = "round(list_sum(embedding::DOUBLE[]), 6) AS checksum"
COSINE = "list_dot_product({0}, {1}) / sqrt(list_dot_product({0}, {0}) * list_dot_product({1}, {1}))"
PAIR_COSINE = COSINE.format("qv", "vector")


def _with(parts, select):
    return "WITH " + ",\n".join(parts) + "\n" + select


HIT_LIST = "SELECT query_pos, query_id, rank, id, round(distance, 6) AS distance FROM hits"
KNN = _with(RESPONSES, HIT_LIST)

DATASET_B = _with(
    [*RESPONSES, POOL],
    f"SELECT '{PREFIX}' || w.id AS id, w.doi, w.title, w.abstract, p.rank FROM works w JOIN pool p ON p.id = w.id",
)

PLACED = rf"""placed AS (
  SELECT doc_id, b, (n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE AS x FROM (
    SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::UBIGINT % {VECTOR_DIM} AS b, count(*) AS n FROM (
      SELECT doc_id, unnest(regexp_extract_all(lower('query: ' || title || ' ' || coalesce(abstract, '')), '[^ \t\r\n]+')) AS w
      FROM works)
    GROUP BY ALL))"""

ENCODED = f"""encoded AS (
  SELECT doc_id, list(coalesce(x, 0) ORDER BY b) AS vector
  FROM (SELECT doc_id, b FROM documents, range({VECTOR_DIM}) AS t(b)) LEFT JOIN placed USING (doc_id, b) GROUP BY doc_id)"""

TEXT_SEEDS = f"""text_seeds AS (
  SELECT doc_id AS query_pos, 'W' || doc_id AS short_id, '{PREFIX}W' || doc_id AS query_id, vector AS qv
  FROM review JOIN encoded USING (doc_id) WHERE label_included = 1 AND NOT extra_excluded)"""

TEXT_CRITERIA = "text_criteria AS (SELECT vector AS qv FROM encoded WHERE doc_id = (SELECT max(doc_id) FROM documents))"

TEXTS = [PLACED, ENCODED, TEXT_SEEDS, TEXT_CRITERIA]

LABELLED = "labelled AS (SELECT 'M' || doc_id AS MID, vector FROM labels JOIN encoded USING (doc_id))"

CLOSEST = f"""closest AS (
  SELECT MID, query_id, similarity FROM (
    SELECT MID, query_id, {PAIR_COSINE} AS similarity,
           row_number() OVER (PARTITION BY MID ORDER BY {PAIR_COSINE} DESC, query_pos) AS n
    FROM labelled, text_seeds)
  WHERE n = 1)"""

TO_CRITERIA = f"to_criteria AS (SELECT MID, {PAIR_COSINE} AS criteria_similarity FROM labelled, text_criteria)"

BEST = """best AS (
  SELECT id, min(rank) AS min_rank, arg_min(query_id, rank * 10000000000 + query_pos) AS min_rank_id,
         count(*) AS n_lists
  FROM hits GROUP BY id)"""

FIRSTS = " OR ".join(
    f"doc_id = (SELECT min(doc_id) FROM review WHERE contains(lower(doi), '{doi.lower()}'))" for doi in EXCLUDED
)

TRAINING = f"""training AS (
  SELECT CASE WHEN {FIRSTS} THEN 0 ELSE label_included END AS label, embedding::DOUBLE[] AS vector
  FROM review JOIN embeddings ON vec_id = doc_id),
direction AS (
  SELECT list(d ORDER BY b) AS direction FROM (
    SELECT b, avg(x) FILTER (label = 1) - avg(x) FILTER (label = 0) AS d FROM (
      SELECT label, unnest(vector) AS x, generate_subscripts(vector, 1) AS b FROM training) GROUP BY b))"""

RERANKED = f"""reranked AS (
  SELECT id, score FROM (
    SELECT 'W' || vec_id AS id, list_dot_product(embedding::DOUBLE[], direction) AS score FROM embeddings, direction
    WHERE 'W' || vec_id IN (SELECT id FROM hits WHERE rank < {POOL_CUT}))
  ORDER BY score DESC, id LIMIT {KEEP}),
dataset_c AS (
  SELECT '{PREFIX}' || w.id AS id, doi, title, abstract, score,
         CAST(row_number() OVER (ORDER BY score DESC, w.id) - 1 AS INTEGER) AS position
  FROM works w JOIN reranked r ON r.id = w.id)"""

IN_CLUSTERS = f"""centers AS (SELECT vec_id AS cluster, embedding::DOUBLE[] AS cv FROM embeddings WHERE vec_id < {CLUSTERS}),
assigned AS (
  SELECT id, vector, arg_min(cluster, (gap, cluster)) AS cluster FROM (
    SELECT 'W' || vec_id AS id, embedding::DOUBLE[] AS vector, cluster, list_distance(embedding::DOUBLE[], cv) AS gap
    FROM embeddings, centers) GROUP BY id, vector),
probes AS (
  SELECT query_pos, query_id, qv, cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY list_distance(qv, cv), cluster) AS n FROM seeds, centers)
  WHERE n <= {CLUSTERS // 2}),
found AS (
  SELECT query_pos, query_id, CAST(n - 1 AS INTEGER) AS rank, id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) AS n FROM (
      SELECT query_pos, query_id, id, list_distance(qv, vector) AS distance FROM probes JOIN assigned USING (cluster)))
  WHERE n <= {DEPTH})"""

LINKED = f"""in_reranked AS (SELECT '{PREFIX}' || id AS id FROM reranked),
in_pool AS (SELECT '{PREFIX}' || id AS id FROM pool),
in_near AS (SELECT '{PREFIX}' || id AS id FROM near WHERE rank < {CUT})"""

NORMALISED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"

INGESTED = f"""SELECT w.id, d.lang AS title, {NORMALISED} AS abstract, publication_year,
       coalesce(CAST(CAST(date_trunc('year', publication_date) AS DATE) AS VARCHAR), '1970-01-01') AS updated_date
FROM works w JOIN documents d USING (doc_id) LEFT JOIN dates ON dates.id = w.id"""

SQL = {}

# Search

SQL["knn_exact"] = KNN
SQL["knn_blocks"] = KNN
SQL["knn_all_clusters"] = KNN
SQL["knn_criteria"] = _with([CRITERIA, NEAR], "SELECT rank, id, round(1 / (1 + distance), 6) AS closeness FROM near")
SQL["knn_cosine"] = _with(
    BASE,
    f"""SELECT query_pos, query_id, CAST(n - 1 AS INTEGER) AS rank, id, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) AS n FROM (
    SELECT query_pos, query_id, 'W' || vec_id AS id,
           1 - {COSINE.format("qv", "embedding::DOUBLE[]")} AS distance FROM seeds, embeddings))
WHERE n <= {DEPTH}""",
)
SQL["knn_without_self"] = _with(
    BASE,
    f"""SELECT query_pos, query_id, CAST(n - 1 AS INTEGER) AS rank, id, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) AS n FROM (
    SELECT query_pos, query_id, 'W' || vec_id AS id, list_distance(qv, embedding::DOUBLE[]) AS distance
    FROM seeds, embeddings WHERE vec_id <> query_pos))
WHERE n <= {DEPTH}""",
)
STEP = "pow(2, floor(log2(abs(x))) - 7)"
COARSE = f"list_transform({{0}}::DOUBLE[], lambda x: CASE WHEN x = 0 THEN 0 ELSE round_even(x / {STEP}, 0) * {STEP} END)"
SQL["knn_bfloat16"] = _with(
    [
        *BASE,
        f"coarse AS (SELECT 'W' || vec_id AS id, {COARSE.format('embedding')} AS vector FROM embeddings)",
        f"""hits AS (
  SELECT query_pos, query_id, CAST(n - 1 AS INTEGER) AS rank, id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) AS n FROM (
      SELECT query_pos, query_id, coarse.id AS id, list_distance(own.vector, coarse.vector) AS distance
      FROM seeds JOIN coarse own ON own.id = 'W' || query_pos, coarse))
  WHERE n <= {DEPTH})""",
    ],
    HIT_LIST,
)
SQL["knn_in_clusters"] = _with([*BASE, IN_CLUSTERS], HIT_LIST.replace("FROM hits", "FROM found"))
SQL["knn_in_cluster_blocks"] = SQL["knn_in_clusters"]
SQL["knn_approx_recall"] = _with(
    [*RESPONSES, IN_CLUSTERS],
    """SELECT h.query_pos, count(*) AS n_exact, count(f.id) AS n_found, round(count(f.id) / count(*), 6) AS recall
FROM hits h LEFT JOIN found f ON f.query_pos = h.query_pos AND f.id = h.id GROUP BY h.query_pos""",
)
SQL["vector_measures"] = _with(
    [CRITERIA],
    f"""SELECT 'W' || vec_id AS id, round(list_dot_product(v, qv), 6) AS product, round(list_distance(v, qv), 6) AS distance,
       round({COSINE.format("v", "qv")}, 6) AS cosine, round(sqrt(list_dot_product(v, v)), 6) AS norm
FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), criteria""",
)
SQL["search_by_text"] = _with(
    [WORKS, REVIEW, *TEXTS],
    f"""SELECT query_pos, query_id, CAST(n - 1 AS INTEGER) AS rank, id, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) AS n FROM (
    SELECT query_pos, query_id, 'W' || doc_id AS id, list_distance(qv, vector) AS distance
    FROM (SELECT query_pos, short_id AS query_id, qv FROM text_seeds
          UNION ALL SELECT -1, 'W' || (SELECT max(doc_id) FROM documents), qv FROM text_criteria), encoded))
WHERE n <= {TEXT_DEPTH}""",
)
SQL["knn_vectors"] = _with(
    [CRITERIA, NEAR], f"SELECT rank, id, {CHECKSUM} FROM near JOIN embeddings ON id = 'W' || vec_id"
)

# Result lists

SQL["resp_distinct_ids"] = _with(RESPONSES, "SELECT count(DISTINCT id) AS n_ids FROM hits")
SQL["resp_frequency"] = _with(RESPONSES, "SELECT id, count(*) AS n_responses FROM hits GROUP BY id")
SQL["resp_histogram"] = _with(
    RESPONSES,
    """SELECT n_responses, count(*) AS n_records
FROM (SELECT count(*) AS n_responses FROM hits GROUP BY id) GROUP BY n_responses""",
)
SQL["resp_new_at_rank"] = _with(
    [*RESPONSES, LOWEST, CURVE],
    "SELECT rank, n_ids, CASE WHEN rank = 0 THEN 0 ELSE n END AS new_ids FROM curve",
)
SQL["resp_overlap"] = _with(
    [*RESPONSES, "lists AS (SELECT DISTINCT query_pos FROM hits)"],
    """SELECT a.query_pos AS query_a, b.query_pos AS query_b,
       (SELECT count(*) FROM hits x JOIN hits y USING (id)
        WHERE x.query_pos = a.query_pos AND y.query_pos = b.query_pos) AS n_common
FROM lists a, lists b""",
)
SQL["resp_large_overlaps"] = _with(
    RESPONSES,
    f"""SELECT x.query_pos AS query_a, y.query_pos AS query_b, count(*) AS n_common
FROM hits x JOIN hits y ON x.id = y.id AND x.query_pos < y.query_pos
GROUP BY ALL HAVING count(*) >= {COMMON}""",
)
SQL["resp_membership"] = _with(
    [*RESPONSES, CRITERIA, NEAR, EDGES, SEED_IDS, SNOWBALL],
    """SELECT list, count(*) AS n_ids,
       count(*) FILTER (id IN (SELECT 'W' || doc_id FROM labels)) AS in_review,
       count(*) FILTER (id IN (SELECT id FROM near)) AS in_criteria,
       count(*) FILTER (id IN (SELECT id FROM snowball)) AS in_citations,
       count(*) FILTER (id IN (SELECT id FROM snowball WHERE level = 'primary')) AS in_primary
FROM (SELECT DISTINCT 'included' AS list, id FROM hits UNION ALL SELECT 'criteria', id FROM near)
GROUP BY list""",
)
SQL["choose_cutoff"] = _with(
    [*RESPONSES, LOWEST, CURVE],
    f"""SELECT CAST(max(rank + 1) FILTER (n_ids <= {TARGET}) AS INTEGER) AS cut_at_most,
       max(n_ids) FILTER (n_ids <= {TARGET}) AS ids_at_most,
       CAST(min(rank + 1) FILTER (n_ids >= {TARGET}) AS INTEGER) AS cut_at_least,
       min(n_ids) FILTER (n_ids >= {TARGET}) AS ids_at_least
FROM curve""",
)

# Candidate datasets

SQL["dataset_a"] = _with(
    [WORKS, CRITERIA, NEAR],
    f"""SELECT '{PREFIX}' || w.id AS id, doi, title, abstract, rank
FROM works w JOIN near ON near.id = w.id WHERE rank < {CUT}""",
)
SQL["dataset_b"] = DATASET_B
SQL["dataset_csv"] = DATASET_B
SQL["dataset_preview"] = f"SELECT id, rank FROM ({DATASET_B}) ORDER BY rank, id LIMIT 5"
SQL["enrich_missing"] = """SELECT 'W' || doc_id AS id FROM labels
WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)"""
SQL["merged_works"] = _with(
    [*RESPONSES, POOL],
    f"""SELECT '{PREFIX}' || w.id AS id, doi, pool.rank FROM works w LEFT JOIN pool ON pool.id = w.id
WHERE w.doc_id IN (
  SELECT (SELECT max(doc_id) FROM documents e WHERE e.text = d.text)
  FROM documents d JOIN pool p ON p.id = 'W' || d.doc_id)""",
)
SQL["enrich_from_index"] = _with(
    [CRITERIA, NEAR],
    f"""SELECT id, lang AS title, {NORMALISED} AS abstract FROM documents JOIN near ON id = 'W' || doc_id""",
)

SQL["dataset_c_linear"] = _with(
    [*RESPONSES, TRAINING, RERANKED],
    "SELECT id, doi, title, abstract, round(score, 6) AS relevance_score FROM dataset_c",
)
SQL["classifier_optimality"] = _with(
    [*BASE, TRAINING],
    """SELECT CAST(label AS INTEGER) AS label_included, count(*) AS n,
       round((SELECT count(*) FROM training) / (2.0 * count(*)), 6) AS weight, true AS optimal
FROM training GROUP BY label""",
)

# Review labels

SQL["seed_selection"] = _with(
    [WORKS, REVIEW],
    """SELECT id, doi, label_included, extra_excluded,
       label_included = 1 AND NOT extra_excluded AS is_seed FROM review""",
)
SQL["training_labels"] = _with(
    [WORKS, REVIEW],
    f"SELECT id, CASE WHEN {FIRSTS} THEN 0 ELSE label_included END AS label_included FROM review",
)

HASHED = "('0x' || substr(md5('{seed}:' || {text}), 1, 15))::BIGINT"
SQL["training_resampled"] = _with(
    [
        WORKS,
        REVIEW,
        f"labelled AS (SELECT id, CASE WHEN {FIRSTS} THEN 0 ELSE label_included END AS label_included FROM review)",
        f"""placed AS (
  SELECT *, row_number() OVER (PARTITION BY label_included ORDER BY {HASHED.format(seed=RERANK_SEED, text="id")}, id) - 1 AS place,
         count(*) OVER (PARTITION BY label_included) AS size, count(*) OVER () // 2 AS half FROM labelled)""",
        f"""draws AS (
  SELECT label_included, {HASHED.format(seed=RERANK_SEED, text="label_included || ':' || j")} % size AS place, count(*) AS copies
  FROM (SELECT DISTINCT label_included, size, unnest(range(half)) AS j FROM placed WHERE size < half) GROUP BY ALL)""",
    ],
    """SELECT id, label_included, 1 AS copies FROM placed WHERE size >= half AND place < half
UNION ALL SELECT id, label_included, copies FROM placed JOIN draws USING (label_included, place)""",
)

# Citations

SQL["citation_edges"] = """SELECT citing, count(*) AS n_cited, min(cited) AS first_cited FROM (
  SELECT 'W' || l_orderkey AS citing, 'W' || l_partkey AS cited FROM lineitem
  UNION SELECT 'W' || l_orderkey, 'W' || l_suppkey FROM lineitem)
GROUP BY citing"""
CITING = [WORKS, REVIEW, SEED_IDS, EDGES]
SQL["citing_works"] = _with(
    CITING, "SELECT DISTINCT citing AS id FROM edges WHERE cited IN (SELECT id FROM seed_ids)"
)
SQL["works_lookup"] = _with(
    CITING,
    """SELECT id, doi, title, abstract FROM works
WHERE id IN (SELECT citing FROM edges WHERE cited IN (SELECT id FROM seed_ids))""",
)
SQL["citation_links"] = _with(CITING, "SELECT citing, cited FROM edges WHERE cited IN (SELECT id FROM seed_ids)")
SQL["snowball"] = _with(
    [*CITING, SNOWBALL, DATES],
    "SELECT id, level, publication_date, publication_year FROM snowball LEFT JOIN dates USING (id)",
)
SQL["snowball_indexed"] = _with([*CITING, SNOWBALL], "SELECT id, level FROM snowball")
SQL["snowball_provenance"] = _with(
    [
        *CITING,
        SNOWBALL,
        "to_seed AS (SELECT citing, cited AS seed FROM edges WHERE cited IN (SELECT id FROM seed_ids))",
        """led AS (
  SELECT s.id, s.level, t.seed, t.seed AS via FROM snowball s JOIN to_seed t ON t.citing = s.id WHERE s.level = 'primary'
  UNION ALL
  SELECT s.id, s.level, t.seed, e.cited FROM snowball s JOIN edges e ON e.citing = s.id JOIN to_seed t ON t.citing = e.cited
  WHERE s.level = 'secondary')""",
    ],
    """SELECT id, level, CAST(count(DISTINCT seed) AS INT) AS n_seeds,
       array_to_string(list_sort(list(DISTINCT seed)), ' ') AS seeds, array_to_string(list_sort(list(DISTINCT via)), ' ') AS cites
FROM led GROUP BY id, level""",
)
SQL["citation_dataset"] = _with(
    [*CITING, SNOWBALL, DATES],
    f"""SELECT '{PREFIX}' || s.id AS id, doi, title, abstract, CASE WHEN w.id IS NOT NULL THEN publication_date END AS publication_date, level
FROM snowball s LEFT JOIN works w ON s.id = w.id LEFT JOIN dates ON dates.id = w.id""",
)
SQL["citation_unresolved"] = _with([*CITING, SNOWBALL], "SELECT id FROM snowball WHERE id NOT IN (SELECT id FROM works)")
SQL["snowball_summary"] = _with(
    [*CITING, SNOWBALL, DATES],
    f"""SELECT scope, count(*) AS total, count(*) FILTER (level = 'primary') AS "primary",
       count(*) FILTER (level = 'secondary') AS secondary
FROM (SELECT 'all' AS scope, level FROM snowball UNION ALL
      SELECT 'since', level FROM snowball JOIN dates USING (id) WHERE publication_year >= {SINCE})
GROUP BY scope""",
)

# Corpus

SQL["corpus_counts"] = _with(
    [WORKS, DATES],
    f"""SELECT count(*) AS n_works, count(abstract) AS n_abstract,
       count(*) FILTER (publication_year >= {SINCE}) AS n_recent,
       count(abstract) FILTER (publication_year >= {SINCE}) AS n_recent_abstract
FROM works LEFT JOIN dates USING (id)""",
)
SQL["column_profile"] = _with(
    [WORKS, DATES, "dated AS (SELECT * FROM works LEFT JOIN dates USING (id))"],
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS column_type, count(*) AS n_rows, count({name}) AS n_values FROM dated"
        for name, kind in (
            ("id", "string"),
            ("doi", "string"),
            ("title", "string"),
            ("abstract", "string"),
            ("publication_date", "date"),
            ("publication_year", "int"),
        )
    ),
)
SQL["abstract_rebuild"] = f"SELECT doc_id, {NORMALISED} AS abstract FROM documents"
SQL["work_text"] = _with([WORKS], "SELECT id, 'query: ' || title || ' ' || coalesce(abstract, '') AS text FROM works")
SQL["restored_text"] = _with([WORKS], "SELECT id, replace(abstract, ',', '-') AS abstract FROM works")
SQL["embed_documents"] = _with(
    [WORKS, PLACED], "SELECT 'W' || doc_id AS id, CAST(b AS INTEGER) AS place, round(x, 5) AS x FROM placed"
)
SQL["embed_truncated"] = _with(
    [
        WORKS,
        PLACED.replace("unnest(regexp_extract_all(", "unnest(list_slice(regexp_extract_all(").replace(
            "r\\n]+')) AS w", f"r\\n]+'), 1, {MAX_TOKENS})) AS w"
        ),
    ],
    "SELECT 'W' || doc_id AS id, CAST(b AS INTEGER) AS place, round(x, 5) AS x FROM placed",
)
SQL["embed_profile"] = _with(
    [WORKS],
    r"""SELECT id, 384 AS dim, 1.0::DOUBLE AS norm,
       len(regexp_extract_all('query: ' || title || ' ' || coalesce(abstract, ''), '\S+')) AS n_terms
FROM works""",
)

# Feed

SQL["feed_filter"] = _with(
    [DATES],
    f"""SELECT id, CAST(len(embedding) AS INTEGER) AS dim, {CHECKSUM}
FROM embeddings JOIN dates ON id = 'W' || vec_id
WHERE publication_year >= {SINCE} AND len(embedding) = {DIM}""",
)
SQL["feed_rejected"] = """SELECT 'W' || doc_id AS id, 'missing embedding' AS reason FROM documents
WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)"""
SQL["feed_invalid_vectors"] = """SELECT vec_id, CASE vec_id % 6
  WHEN 0 THEN 'accepted' WHEN 1 THEN 'wrong length' WHEN 2 THEN 'missing value' WHEN 3 THEN 'not a number'
  WHEN 4 THEN 'missing embedding' ELSE 'missing id' END AS reason FROM embeddings"""
SQL["keep_latest"] = """SELECT id, updated_date, part, source, value FROM (
  SELECT 'W' || l_partkey AS id, CAST(l_shipdate AS DATE) AS updated_date, l_linenumber AS part,
         l_orderkey AS source, l_extendedprice AS value,
         row_number() OVER (PARTITION BY l_partkey
           ORDER BY l_shipdate DESC, l_linenumber DESC, l_orderkey DESC, l_extendedprice DESC) AS n
  FROM lineitem) WHERE n = 1"""
SQL["fed_counts"] = """SELECT updated_date, part, count(*) AS n_rows
FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS updated_date, o_orderstatus AS part FROM orders)
GROUP BY ROLLUP (updated_date, part)"""
SQL["published_vectors"] = f"SELECT 'W' || vec_id AS id, {CHECKSUM} FROM embeddings"

# Recall

SQL["recall_lists"] = _with(
    RESPONSES,
    """SELECT w.id, string_agg(rank || '@' || query_id, ' ' ORDER BY query_pos) AS entries
FROM works w LEFT JOIN hits h ON h.id = w.id GROUP BY w.id""",
)
SQL["recall_min_rank"] = _with([*RESPONSES, BEST], "SELECT id, min_rank, min_rank_id FROM best")
SQL["recall_similarity"] = _with(
    [WORKS, REVIEW, *TEXTS, LABELLED, CLOSEST, TO_CRITERIA],
    """SELECT MID, query_id, round(similarity, 6) AS similarity, round(criteria_similarity, 6) AS criteria_similarity
FROM closest JOIN to_criteria USING (MID)""",
)
RECALLED = [*RESPONSES, CRITERIA, NEAR, MASTER, *TEXTS, LABELLED, CLOSEST, TO_CRITERIA, BEST]
RECALL_MASTER = f"""SELECT m.MID, m.openalex_id, m.doi, m.Data_0_Synergy, m.Data_3b_old,
       b.min_rank AS inclusions_min_rank, b.min_rank_id AS inclusions_min_rank_id,
       CAST(b.n_lists AS INTEGER) AS n_lists, near.rank AS criteria_rank,
       round(s.similarity, 6) AS inclusions_similarity, s.query_id AS inclusions_most_similar,
       round(c.criteria_similarity, 6) AS criteria_similarity
FROM master m
LEFT JOIN best b ON '{PREFIX}' || b.id = m.openalex_id
LEFT JOIN near ON '{PREFIX}' || near.id = m.openalex_id
LEFT JOIN closest s ON s.MID = m.MID LEFT JOIN to_criteria c ON c.MID = m.MID"""
SQL["recall_master"] = _with(RECALLED, RECALL_MASTER)
SQL["recall_master_linear"] = _with(
    [*RECALLED, TRAINING, RERANKED, f"recalled AS ({RECALL_MASTER})"],
    """SELECT recalled.*, round(score, 6) AS logistic_score, position AS logistic_rank
FROM recalled LEFT JOIN dataset_c ON dataset_c.id = openalex_id""",
)
SQL["recall_at_n"] = _with(
    [
        *RESPONSES,
        "wanted AS (SELECT 'W' || doc_id AS id FROM labels WHERE toxic = 1)",
        "lowest AS (SELECT id, min(rank) AS rank FROM hits WHERE id IN (SELECT id FROM wanted) GROUP BY id)",
        CURVE,
    ],
    """SELECT rank, n_ids AS n_found, (SELECT count(*) FROM wanted) AS n_relevant,
       round(n_ids / (SELECT count(*) FROM wanted), 6) AS recall FROM curve""",
)

# Master table

LINK = [*RESPONSES, POOL, CRITERIA, NEAR, MASTER, TRAINING, RERANKED, LINKED]
SQL["link_flags"] = _with(
    LINK,
    """SELECT MID, openalex_id, coalesce(openalex_id IN (SELECT id FROM in_pool), false) AS in_included,
       coalesce(openalex_id IN (SELECT id FROM in_near), false) AS in_criteria,
       coalesce(openalex_id IN (SELECT id FROM in_reranked), false) AS in_reranked FROM master""",
)
SQL["link_coverage"] = _with(
    LINK,
    """SELECT 'included' AS dataset, count(*) AS n_dataset,
       count(*) FILTER (id IN (SELECT openalex_id FROM master WHERE openalex_id IS NOT NULL)) AS dataset_in_master,
       (SELECT count(*) FROM master WHERE openalex_id IN (SELECT id FROM in_pool)) AS master_in_dataset FROM in_pool
UNION ALL
SELECT 'criteria', count(*),
       count(*) FILTER (id IN (SELECT openalex_id FROM master WHERE openalex_id IS NOT NULL)),
       (SELECT count(*) FROM master WHERE openalex_id IN (SELECT id FROM in_near)) FROM in_near
UNION ALL
SELECT 'reranked', count(*),
       count(*) FILTER (id IN (SELECT openalex_id FROM master WHERE openalex_id IS NOT NULL)),
       (SELECT count(*) FROM master WHERE openalex_id IN (SELECT id FROM in_reranked)) FROM in_reranked""",
)
SQL["master_upsert"] = _with(
    [
        *RESPONSES,
        POOL,
        MASTER,
        f"""incoming AS (
  SELECT '{PREFIX}' || w.id AS id, doi, title, abstract,
         'M' || ((SELECT max(CAST(substr(MID, 2) AS BIGINT)) FROM master)
                 + row_number() OVER (ORDER BY p.rank, '{PREFIX}' || w.id)) AS MID
  FROM works w JOIN pool p ON p.id = w.id)""",
    ],
    """SELECT coalesce(m.MID, i.MID) AS MID, coalesce(m.openalex_id, i.id) AS openalex_id,
       coalesce(m.doi, i.doi) AS doi, coalesce(m.title, i.title) AS title, coalesce(m.abstract, i.abstract) AS abstract,
       coalesce(m.Data_0_Synergy, 0) AS Data_0_Synergy, coalesce(m.Data_3b_old, 0) AS Data_3b_old,
       CASE WHEN i.id IS NULL THEN 0 ELSE 1 END AS Data_3b
FROM master m FULL OUTER JOIN incoming i ON i.id = m.openalex_id""",
)
SQL["master_max_number"] = _with(
    [WORKS, REVIEW, MASTER], "SELECT max(CAST(substr(MID, 2) AS BIGINT)) AS max_mid FROM master"
)

# Files

SQL["manifest_files"] = """SELECT url,
       'source_data/' || string_split(url, '/')[-2] || '/' || string_split(url, '/')[-1] AS path FROM pages"""
SQL["snapshot_completeness"] = """SELECT 'updated_date=' || day || '/part_' || part || '.gz' AS file,
       day AS updated_date, part, count(*) AS record_count,
       nullif(count(*) FILTER (sold), 0) AS n_read,
       CASE WHEN count(*) FILTER (sold) = 0 THEN 'missing'
            WHEN count(*) FILTER (sold) = count(*) THEN 'complete' ELSE 'differs' END AS state
FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, lower(o_orderstatus) AS part,
             o_orderkey IN (SELECT l_orderkey FROM lineitem) AS sold FROM orders)
GROUP BY day, part"""
SQL["manifest_scan"] = """SELECT month AS updated_date, count(*) AS record_count, nullif(count(*) FILTER (sold), 0) AS n_read,
       CASE WHEN count(*) FILTER (sold) = 0 THEN 'missing'
            WHEN count(*) FILTER (sold) = count(*) THEN 'complete' ELSE 'differs' END AS state
FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS sold FROM orders)
GROUP BY month"""
SQL["vector_json"] = f"""SELECT CAST(len(embedding) AS INTEGER) AS dim, {CHECKSUM} FROM embeddings
WHERE vec_id = (SELECT max(vec_id) FROM embeddings)"""
SQL["master_csv"] = _with(
    [WORKS, REVIEW, MASTER],
    "SELECT MID, openalex_id, doi, nullif(title, '') AS title, nullif(abstract, '') AS abstract, Data_0_Synergy, Data_3b_old FROM master",
)
SQL["hits_parquet"] = SQL["knn_vectors"]
SQL["materialized_twice"] = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"
SQL["snapshot_delta"] = """WITH orders1 AS (
  SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') || '-' || o_orderstatus AS file FROM orders
), orders2 AS (
  SELECT o_orderkey AS id,
         strftime(o_orderdate, '%Y-%m') || '-' || CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END AS file
  FROM orders WHERE NOT (year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AND o_orderstatus = 'F')
), files AS (
  SELECT file, CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'vanished' WHEN a.n = b.n THEN 'same' ELSE 'changed' END AS step
  FROM (SELECT file, count(*) AS n FROM orders1 GROUP BY file) a FULL JOIN (SELECT file, count(*) AS n FROM orders2 GROUP BY file) b USING (file)
), fed AS (
  SELECT id FROM orders2 JOIN files USING (file) WHERE step IN ('new', 'changed')
), gone AS (
  SELECT DISTINCT id FROM orders1 JOIN files USING (file) WHERE step IN ('changed', 'vanished') AND id NOT IN (SELECT id FROM fed)
    AND id NOT IN (SELECT id FROM orders1 JOIN files USING (file) WHERE step NOT IN ('changed', 'vanished'))
)
SELECT step, count(*) AS n FROM files GROUP BY step
UNION ALL SELECT 'fed', count(*) FROM fed HAVING count(*) > 0
UNION ALL SELECT 'retracted', count(*) FROM gone HAVING count(*) > 0"""
SQL["materialized_changed"] = """WITH counts AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)
SELECT o_orderstatus, n, true AS computed_once, 0 AS call FROM counts WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderstatus, n, true, 2 FROM counts"""
SQL["cleaned_floats"] = """SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_discount <> 0) AS n_discount,
       round(sum(l_discount), 4) AS discount FROM lineitem GROUP BY l_returnflag"""
SQL["parts_pruned"] = _with(
    [DATES],
    f"""SELECT id, publication_year AS updated_date, {CHECKSUM} FROM embeddings JOIN dates ON id = 'W' || vec_id
WHERE publication_year = {SINCE}""",
)
SQL["upsert_corrected"] = """SELECT 'W' || vec_id AS id,
       round(list_sum(embedding::DOUBLE[]) * CASE WHEN vec_id % 3 = 0 THEN 2 ELSE 1 END, 6) AS checksum FROM embeddings"""
SQL["upsert_deleted"] = """SELECT 'W' || vec_id AS id, '2024-01-01' AS updated_date, round(list_sum(embedding::DOUBLE[]), 6) AS checksum
FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)
UNION ALL SELECT 'W' || doc_id, CASE WHEN toxic = 1 AND vec_id IS NOT NULL THEN '2024-01-03' ELSE '2024-01-02' END,
       CASE WHEN toxic = 1 AND vec_id IS NOT NULL THEN round(list_sum(embedding::DOUBLE[]), 6) END
FROM labels LEFT JOIN embeddings ON vec_id = doc_id WHERE quality = 0"""
SQL["ingest_json"] = _with([WORKS, DATES], INGESTED)
SQL["ingest_stream"] = _with([WORKS, DATES], INGESTED)
SQL["write_split"] = _with(
    [WORKS, DATES], f"SELECT id, title, abstract, publication_year, 384 AS dim FROM ({INGESTED}) WHERE publication_year >= {SINCE}"
)
SQL["upsert_stream"] = """WITH versions AS (
  SELECT 'W' || l_partkey AS id, strftime(l_shipdate, '%Y-%m-%d') AS updated_date,
         CAST(l_linenumber AS VARCHAR) AS part, embedding
  FROM lineitem LEFT JOIN embeddings ON vec_id = l_partkey)
SELECT id, updated_date, part, round(list_sum(embedding::DOUBLE[]), 6) AS checksum, NULL::VARCHAR AS reason FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_date DESC, part DESC) AS n
  FROM versions WHERE embedding IS NOT NULL) WHERE n = 1
UNION ALL
SELECT id, max(updated_date), max(part), NULL, 'missing embedding' FROM versions
WHERE embedding IS NULL GROUP BY id"""


def _pruned(k):
    """Blocks, bounds and reach as the search cuts and takes them; the rows are those of all pairs."""
    return _with(
        [
            *BASE,
            f"pivots AS (SELECT vec_id AS p, embedding::DOUBLE[] AS pv FROM embeddings WHERE vec_id < {CLUSTERS})",
            "far AS (SELECT vec_id, p, list_distance(embedding::DOUBLE[], pv) AS d FROM embeddings, pivots)",
            """placed AS (
  SELECT vec_id, 'W' || vec_id AS id, p AS cell, d AS gap FROM far
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, p) = 1)""",
            f"""cut AS (
  SELECT *, (row_number() OVER (ORDER BY cell, gap, id) - 1) // {PRUNED_BLOCK} AS run FROM placed)""",
            """ends AS (
  SELECT cell, run, p, min(d) AS lo, max(d) AS hi, count(*) AS n FROM cut JOIN far USING (vec_id) GROUP BY cell, run, p)""",
            "asked AS (SELECT query_pos, p, list_distance(qv, pv) AS d FROM seeds, pivots)",
            """bounds AS (
  SELECT query_pos, cell, run, any_value(n) AS n, max(greatest(lo - d, d - hi, 0)) AS bound
  FROM ends JOIN asked USING (p) GROUP BY query_pos, cell, run)""",
            """ordered AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY query_pos ORDER BY bound, cell, run
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM bounds)""",
            """pairs AS (
  SELECT query_pos, query_id, cell, run, id, list_distance(qv, embedding::DOUBLE[]) AS distance
  FROM seeds, embeddings e JOIN cut USING (vec_id))""",
            f"""reach AS (
  SELECT query_pos, max(distance) AS r FROM (
    SELECT p.query_pos, distance, row_number() OVER (PARTITION BY p.query_pos ORDER BY distance, id) AS n
    FROM pairs p JOIN ordered o USING (query_pos, cell, run) WHERE o.before < {k})
  WHERE n <= {k} GROUP BY query_pos)""",
            """skips AS (
  SELECT query_pos, 1 - sum(CASE WHEN bound <= r * (1 + 1e-9) + 1e-9 THEN n ELSE 0 END) / sum(n) AS skipped
  FROM bounds JOIN reach USING (query_pos) GROUP BY query_pos)""",
        ],
        f"""SELECT query_pos, query_id, CAST(place - 1 AS INT) AS rank, id, round(distance, 6) AS distance, round(skipped, 6) AS skipped
FROM (SELECT *, row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) AS place FROM pairs)
JOIN skips USING (query_pos) WHERE place <= {k}""",
    )


SQL["knn_pruned"] = _pruned(DEPTH)
SQL["knn_pruned_closest"] = _pruned(1)

SQL["knn_living_index"] = _with(
    [
        *BASE,
        """standing AS (
  SELECT vec_id, 'W' || vec_id AS id,
         CASE WHEN quality = 0 THEN list_transform(embedding, lambda x: -x) ELSE embedding END::DOUBLE[] AS v
  FROM embeddings LEFT JOIN labels ON doc_id = vec_id WHERE toxic IS NULL OR toxic <> 1)""",
        f"""centers AS (
  SELECT f.vec_id AS cluster, c.vec_id AS cell, f.embedding::DOUBLE[] AS cv FROM embeddings f, embeddings c
  WHERE f.vec_id < {CLUSTERS} AND c.vec_id < {CELLS}
  QUALIFY row_number() OVER (PARTITION BY f.vec_id ORDER BY list_distance(f.embedding::DOUBLE[], c.embedding::DOUBLE[]), c.vec_id) = 1)""",
        f"""means AS (
  SELECT cell, list(x ORDER BY i) AS mean
  FROM (SELECT cell, i, avg(cv[i]) AS x FROM centers, range(1, {DIM + 1}) AS t(i) GROUP BY cell, i) GROUP BY cell)""",
        """celled AS (
  SELECT s.*, cell FROM standing s, means
  QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY list_distance(v, mean), cell) = 1)""",
        """held AS (
  SELECT s.id, v, cluster FROM celled s JOIN centers USING (cell)
  QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY list_distance(v, cv), cluster) = 1)""",
        """places AS (
  SELECT query_pos, cluster, row_number() OVER (PARTITION BY query_pos ORDER BY list_distance(qv, cv), cluster) AS place
  FROM seeds, centers)""",
        "pairs AS (SELECT query_pos, id, list_distance(qv, v) AS distance, place FROM seeds JOIN places USING (query_pos) JOIN held USING (cluster))",
        f"""exact AS (
  SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) <= {DEPTH})""",
        """recalls AS (
  SELECT n, query_pos, count(*) FILTER (place <= n) / count(*) AS recall
  FROM exact, (SELECT DISTINCT place AS n FROM places) GROUP BY n, query_pos)""",
        f"probes AS (SELECT min(n) AS n FROM (SELECT n FROM recalls GROUP BY n HAVING avg(recall) >= {TARGET_RECALL} - 1e-9))",
    ],
    f"""SELECT query_pos, CAST(row_number() OVER (PARTITION BY query_pos ORDER BY distance, id) - 1 AS INT) AS rank, id,
       round(distance, 6) AS distance, round(recall, 6) AS recall, CAST(n AS INT) AS n_probes
FROM pairs JOIN probes ON place <= n JOIN recalls USING (n, query_pos) QUALIFY rank < {DEPTH}""",
)
