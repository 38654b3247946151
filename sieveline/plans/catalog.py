"""Registered queries over the given tables."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions import text
from sieveline.functions.vectors import closeness, cosine, dot, euclidean, norm
from sieveline.operators import (
    candidates,
    citation_index,
    citations,
    clusters,
    embedding,
    feed,
    master,
    neighbors,
    profile,
    provenance,
    pruned,
    recall,
    rerank,
    resample,
    responses,
    seeds,
    similarity,
    vector_index,
    work_index,
)
from sieveline.plans import corpus, screening, standins
from sieveline.settings import MAX_TOKENS, RERANK_SEED
from sieveline.sources import manifest, readers, writers
from sieveline.staging import materialize, materialize_known, run_folder, small, stage, staged_path
from sieveline.streaming import ingest, upsert

QUERIES = {}

CUT = 40
TARGET = 250
SINCE = 1998
POOL_CUT = 80
KEEP = 200
CLUSTERS = 16
CELLS = 4
TARGET_RECALL = 0.9
PRUNED_BLOCK = 8
BUCKETS = 16
# More ids than this are joined with the buckets, fewer are broadcast.
INDEXED_KEYS = 100
TEXT_DEPTH = 20
COMMON = 30


def query(function):
    QUERIES[function.__name__] = function
    return function


def _rounded(hits):
    return hits.withColumn("distance", F.round("distance", 6))


# Search


@query
def knn_exact(spark, sf_dir):
    return _rounded(standins.hits(spark, sf_dir))


@query
def knn_blocks(spark, sf_dir):
    """The same search along the way taken by query sets too large to broadcast."""
    return _rounded(standins.hits(spark, sf_dir, max_bytes=0))


@query
def knn_criteria(spark, sf_dir):
    found = neighbors.check_depth(stage(standins.criteria_hits(spark, sf_dir), "criteria"), standins.DEPTH)
    return found.select("rank", "id", F.round(closeness(F.col("distance")), 6).alias("closeness"))


@query
def knn_cosine(spark, sf_dir):
    return _rounded(standins.hits(spark, sf_dir, metric="cosine"))


@query
def knn_without_self(spark, sf_dir):
    return _rounded(standins.hits(spark, sf_dir, exclude_self=True))


@query
def knn_bfloat16(spark, sf_dir):
    """The search as an index with 16-bit vectors answers it."""
    return _rounded(standins.hits(spark, sf_dir, element="bfloat16"))


@query
def knn_vectors(spark, sf_dir):
    """Hits with their vectors, as saved by a search."""
    vectors = standins.corpus(spark, sf_dir)
    found = stage(standins.criteria_hits(spark, sf_dir), "criteria")
    full = neighbors.with_vectors(found, vectors, standins.DEPTH)
    return full.select("rank", "id", _checksum("embedding"))


def _checksum(col):
    total = F.aggregate(col, F.lit(0.0), lambda total, x: total + x.cast("double"))
    return F.round(total, 6).alias("checksum")


@query
def knn_all_clusters(spark, sf_dir):
    vectors = standins.corpus(spark, sf_dir)
    centers = stage(clusters.fit_centers(vectors, CLUSTERS), "centers")
    table = clusters.write_clusters(vectors, centers, staged_path(spark, "clusters"))
    queries = standins.seeds(spark, sf_dir)
    return _rounded(clusters.nearest_in_clusters(table, centers, queries, standins.DEPTH, CLUSTERS))


def _clustered(spark, sf_dir):
    """The corpus by its closest one of a few given vectors."""
    centers = standins.table(spark, sf_dir, "embeddings").filter(F.col("vec_id") < CLUSTERS)
    centers = centers.select(F.col("vec_id").cast("int").alias("cluster"), "embedding")
    table = clusters.write_clusters(standins.corpus(spark, sf_dir), centers, staged_path(spark, "clusters"))
    return centers, table


@query
def knn_in_clusters(spark, sf_dir):
    centers, table = _clustered(spark, sf_dir)
    queries = standins.seeds(spark, sf_dir)
    return _rounded(clusters.nearest_in_clusters(table, centers, queries, standins.DEPTH, CLUSTERS // 2))


@query
def knn_in_cluster_blocks(spark, sf_dir):
    """The same search along the way taken by query sets too large to broadcast."""
    centers, table = _clustered(spark, sf_dir)
    queries = standins.seeds(spark, sf_dir)
    return _rounded(clusters.nearest_in_clusters(table, centers, queries, standins.DEPTH, CLUSTERS // 2, max_bytes=0))


@query
def knn_approx_recall(spark, sf_dir):
    centers, table = _clustered(spark, sf_dir)
    queries = standins.seeds(spark, sf_dir)
    found = clusters.nearest_in_clusters(table, centers, queries, standins.DEPTH, CLUSTERS // 2)
    report = clusters.recall_report(found, standins.hits(spark, sf_dir))
    return report.withColumn("recall", F.round("recall", 6))


def _pruned(spark, sf_dir, k):
    """The search through small blocks around a few given vectors, and the share of vectors each query skipped."""
    centers = standins.table(spark, sf_dir, "embeddings").filter(F.col("vec_id") < CLUSTERS)
    centers = centers.select(F.col("vec_id").cast("int").alias("cluster"), "embedding")
    blocks = pruned.write_blocks(standins.corpus(spark, sf_dir), centers, staged_path(spark, "blocks"), PRUNED_BLOCK)
    found = _rounded(pruned.nearest_pruned(blocks, standins.seeds(spark, sf_dir), k))
    return found.withColumn("skipped", F.round("skipped", 6))


@query
def knn_pruned(spark, sf_dir):
    return _pruned(spark, sf_dir, standins.DEPTH)


@query
def knn_pruned_closest(spark, sf_dir):
    """The one closest vector of each seed, for which most blocks are out."""
    return _pruned(spark, sf_dir, 1)


@query
def knn_living_index(spark, sf_dir):
    """Search of an index after a corrected delivery and deletes, with as many probes as recall needs.

    Corrected are the vectors of works of quality 0 (turned around), deleted the included works.
    """
    vectors, labels = standins.corpus(spark, sf_dir), standins.table(spark, sf_dir, "labels")
    given = standins.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("cluster"), "embedding")
    cells = given.where(F.col("cluster") < CELLS)
    fine = clusters.assign(given.where(F.col("cluster") < CLUSTERS).withColumnRenamed("cluster", "number"), cells)
    centers = stage(fine.select(F.col("cluster").alias("coarse"), F.col("number").alias("cluster"), "embedding"), "centers")
    index = vector_index.create_vector_index(vectors, centers, staged_path(spark, "index"))
    poor = labels.where("quality = 0").select(standins.work_id("doc_id").alias("id"))
    turned = vectors.join(poor, "id").withColumn("embedding", F.transform("embedding", lambda x: -x))
    index.insert(turned, version=1)
    index.delete(labels.where("toxic = 1").select(standins.work_id("doc_id").alias("id")), version=2)
    queries = stage(standins.seeds(spark, sf_dir), "seeds")
    probes, _ = index.probes_for(standins.DEPTH, TARGET_RECALL, queries)
    found = stage(index.search(queries, standins.DEPTH, probes), "found")
    report = clusters.recall_report(found, neighbors.nearest(index.vectors(), queries, standins.DEPTH))
    report = report.select("query_pos", F.round("recall", 6).alias("recall"), F.lit(probes).alias("n_probes"))
    return _rounded(found).drop("query_id").join(F.broadcast(report), "query_pos")


@query
def vector_measures(spark, sf_dir):
    """Every vector against that of the criteria, by column expressions."""
    other = standins.criteria(spark, sf_dir).select("embedding").scalar()
    both = standins.corpus(spark, sf_dir).withColumn("other", other)
    return both.select(
        "id",
        F.round(dot(F.col("embedding"), F.col("other")), 6).alias("product"),
        F.round(euclidean(F.col("embedding"), F.col("other")), 6).alias("distance"),
        F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"),
        F.round(norm(F.col("embedding")), 6).alias("norm"),
    )


@query
def search_by_text(spark, sf_dir):
    """Seeds and the newest record searched for by their texts among the texts of all works."""
    vectors = stage(_encoded(standins.works(spark, sf_dir)), "encoded")
    seeds_of = standins.seed_ids(spark, sf_dir)
    newest = standins.table(spark, sf_dir, "documents").agg(F.max("doc_id").alias("doc_id"))
    newest = newest.select(standins.work_id("doc_id").alias("id"), F.lit(-1).cast("long").alias("query_pos"))
    # Ids are counted and broadcast, so that the texts of all works stay in place.
    asked = standins.works(spark, sf_dir).join(small(stage(seeds_of.unionByName(newest), "asked_ids")), "id")
    asked = stage(_encoded(asked.withColumnRenamed("id", "query_id"), "query_pos", "query_id"), "asked")
    return _rounded(neighbors.nearest(vectors, asked, TEXT_DEPTH))


def _encoded(works, *keys):
    """The works' vectors by the hashed encoder."""
    keys = keys or ("id",)
    return embedding.embed(works.select(*keys, text.document_text().alias("text"))).select(*keys, "embedding")


# Result lists


@query
def resp_distinct_ids(spark, sf_dir):
    return responses.distinct_ids(standins.hits(spark, sf_dir))


@query
def resp_frequency(spark, sf_dir):
    return responses.frequency(standins.hits(spark, sf_dir))


@query
def resp_histogram(spark, sf_dir):
    return responses.frequency_histogram(standins.hits(spark, sf_dir))


@query
def resp_new_at_rank(spark, sf_dir):
    return responses.discovery_curve(standins.hits(spark, sf_dir), standins.DEPTH)


@query
def resp_overlap(spark, sf_dir):
    found = stage(standins.hits(spark, sf_dir), "hits")
    return responses.common_ids(found, found)


@query
def resp_large_overlaps(spark, sf_dir):
    """The pairs of result lists that have many ids in common, without a grid of all pairs."""
    return responses.large_overlaps(standins.hits(spark, sf_dir), COMMON)


@query
def resp_membership(spark, sf_dir):
    hits, near = standins.both_hits(spark, sf_dir)
    cited = stage(_snowball(spark, sf_dir), "citations")
    review = standins.table(spark, sf_dir, "labels").select(standins.work_id("doc_id").alias("id"))
    list_name = F.when(F.col("query_pos") >= 0, "included").otherwise("criteria")
    lists = hits.unionByName(near).select("id", list_name.alias("list"))
    others = {
        "in_review": review,
        "in_criteria": near,
        "in_citations": cited,
        "in_primary": cited.filter(F.col("level") == "primary"),
    }
    return responses.membership(lists, others, "list")


@query
def choose_cutoff(spark, sf_dir):
    return responses.choose_cutoff(standins.hits(spark, sf_dir), TARGET, standins.DEPTH)


# Candidate datasets


@query
def dataset_a(spark, sf_dir):
    return screening.criteria_dataset(standins.criteria_hits(spark, sf_dir), standins.works(spark, sf_dir), CUT)


@query
def dataset_b(spark, sf_dir):
    return screening.included_dataset(standins.hits(spark, sf_dir), standins.works(spark, sf_dir), CUT)


def _training(spark, sf_dir):
    """Labels and vectors of all labelled works; a work without a given vector cannot train a scorer of them."""
    review = standins.review(spark, sf_dir).select("id", "doi", "position", "label_included")
    labelled = seeds.relabel_excluded(review, standins.EXCLUDED, order="position")
    vectors = standins.corpus(spark, sf_dir)
    return labelled.withColumn("id", text.short_id("id")).join(vectors, "id").select("embedding", "label_included")


def _reranked(spark, sf_dir, fit=None):
    training = stage(_training(spark, sf_dir), "training")
    return screening.reranked_pool(standins.hits(spark, sf_dir), standins.corpus(spark, sf_dir), training, POOL_CUT, KEEP, fit)


@query
def dataset_c(spark, sf_dir):
    found = screening.reranked_dataset(_reranked(spark, sf_dir), standins.works(spark, sf_dir))
    return found.withColumn("relevance_score", F.round("relevance_score", 6))


@query
def dataset_c_linear(spark, sf_dir):
    """Dataset C by the difference of the class means instead of a fitted model."""
    found = screening.reranked_dataset(_reranked(spark, sf_dir, rerank.linear), standins.works(spark, sf_dir))
    return found.withColumn("relevance_score", F.round("relevance_score", 6))


@query
def classifier_optimality(spark, sf_dir):
    """Class sizes and weights of the training set, and whether the fit is at the optimum of its loss."""
    training = stage(_training(spark, sf_dir), "training")
    model = rerank.fit_classifier(training, tol=1e-9)
    optimal = rerank.largest_gradient(model, training) < 1e-4
    weights = rerank.balance(training, rerank.class_sizes(training)).groupBy("label_included")
    return weights.agg(F.count("*").alias("n"), F.round(F.avg("weight"), 6).alias("weight")).withColumn("optimal", F.lit(optimal))


@query
def training_resampled(spark, sf_dir):
    """The training labels, half of all draws from either class, with the number of draws of each row."""
    review = standins.review(spark, sf_dir).select("id", "doi", "position", "label_included")
    labelled = seeds.relabel_excluded(review, standins.EXCLUDED, order="position")
    return resample.balanced(labelled.select("id", "label_included"), seed=RERANK_SEED)


@query
def dataset_csv(spark, sf_dir):
    """Dataset B written as CSV and read back, with its multi-line texts."""
    path = staged_path(spark, "csv")
    writers.write_csv(dataset_b(spark, sf_dir), path)
    schema = T.StructType([*readers.REVIEW.fields[:4], T.StructField("rank", T.IntegerType())])
    return readers.read_csv(spark, path, schema)


@query
def dataset_preview(spark, sf_dir):
    return candidates.preview(dataset_b(spark, sf_dir).select("id", "rank"), "rank", "id")


@query
def enrich_missing(spark, sf_dir):
    """Labelled works without a vector."""
    labelled = standins.table(spark, sf_dir, "labels").select(standins.work_id("doc_id").alias("id"))
    return candidates.unresolved(labelled, standins.corpus(spark, sf_dir))


@query
def merged_works(spark, sf_dir):
    """Enrichment where works with one text were merged into the newest."""
    hits = stage(candidates.cut(standins.hits(spark, sf_dir), CUT), "hits")
    copies = standins.table(spark, sf_dir, "documents").select(
        standins.work_id("doc_id").alias("id"), "doc_id", F.md5(F.col("text")).alias("digest")
    )
    pooled = stage(copies.join(small(hits.select("id").distinct()), "id", "left_semi"), "pooled")
    same = copies.join(small(pooled.select("digest").distinct()), "digest", "left_semi")
    newest = same.groupBy("digest").agg(F.max("doc_id").alias("new_doc"))
    merged = pooled.join(newest, "digest").filter(F.col("doc_id") != F.col("new_doc"))
    merged = merged.select(F.col("id").alias("old_id"), standins.work_id("new_doc").alias("new_id"))
    found = screening.included_dataset(hits, standins.works(spark, sf_dir), CUT, merged=merged)
    return found.select("id", "doi", "rank")


@query
def enrich_from_index(spark, sf_dir):
    """Enrichment by works that hold inverted indexes instead of abstracts."""
    works = standins.raw_works(spark, sf_dir).withColumn("id", text.short_id("id"))
    near = stage(standins.criteria_hits(spark, sf_dir).select("id"), "near")
    return candidates.enrich(near, works, ("id", "title", "abstract"))


@query
def works_lookup(spark, sf_dir):
    """The works that cite a seed, looked up in an index of two deliveries; most of the ids are of no known work."""
    works = standins.works(spark, sf_dir)
    first = F.length("id") % 2 == 0
    index = work_index.create_work_index(spark, staged_path(spark, "works"), works.where(first))
    index.append(works.where(~first))
    return index.lookup(citations.citing_works(standins.edges(spark, sf_dir), standins.seed_ids(spark, sf_dir)))


# Review labels


@query
def seed_selection(spark, sf_dir):
    marked = seeds.mark_excluded(standins.review(spark, sf_dir), standins.EXCLUDED)
    return marked.select(
        "id",
        "doi",
        "label_included",
        "extra_excluded",
        ((F.col("label_included") != 0) & ~F.col("extra_excluded")).alias("is_seed"),
    )


@query
def training_labels(spark, sf_dir):
    review = standins.review(spark, sf_dir).select("id", "doi", "position", "label_included")
    labelled = seeds.relabel_excluded(review, standins.EXCLUDED, order="position")
    return labelled.select("id", "label_included")


# Citations


def _review_ids(spark, sf_dir):
    return standins.table(spark, sf_dir, "labels").select(standins.work_id("doc_id").alias("id"))


def _snowball(spark, sf_dir):
    ids = standins.seed_ids(spark, sf_dir).select("id")
    return citations.snowball(standins.edges(spark, sf_dir), ids, _review_ids(spark, sf_dir))


@query
def citation_edges(spark, sf_dir):
    """Edges from exploding the reference lists, with works cited per work."""
    edges = citations.citation_edges(standins.referencing_works(spark, sf_dir)).distinct()
    return edges.groupBy("citing").agg(F.count("*").alias("n_cited"), F.min("cited").alias("first_cited"))


@query
def citing_works(spark, sf_dir):
    return citations.citing_works(standins.edges(spark, sf_dir), standins.seed_ids(spark, sf_dir))


@query
def citation_links(spark, sf_dir):
    return citations.citation_links(standins.edges(spark, sf_dir), standins.seed_ids(spark, sf_dir))


@query
def snowball(spark, sf_dir):
    return _snowball(spark, sf_dir).join(standins.dates(spark, sf_dir), "id", "left")


@query
def snowball_provenance(spark, sf_dir):
    """Each citing work with the seeds it leads back to and the works it cites on the way."""
    found = provenance.snowball_provenance(
        standins.edges(spark, sf_dir), standins.seed_ids(spark, sf_dir), _review_ids(spark, sf_dir)
    )
    return found.select(
        "id", "level", F.size("seeds").alias("n_seeds"),
        F.array_join("seeds", " ").alias("seeds"), F.array_join("cites", " ").alias("cites"),
    )


def _index(spark, sf_dir):
    """The edges of one return flag as they were first, the others appended to the index."""
    lines = standins.table(spark, sf_dir, "lineitem")
    edge = (standins.work_id("l_orderkey").alias("citing"), standins.work_id("l_partkey").alias("cited"))
    old = F.coalesce(F.col("l_returnflag") == "N", F.lit(True))
    index = citation_index.create_index(spark, staged_path(spark, "edges"), lines.where(old).select(*edge), BUCKETS)
    return index.append(lines.where(~old).select(*edge))


@query
def snowball_indexed(spark, sf_dir):
    """Both hops by lookup in the kept index; the second joins its buckets as they lie."""
    return _index(spark, sf_dir).snowball(standins.seed_ids(spark, sf_dir), _review_ids(spark, sf_dir), rows=INDEXED_KEYS)


@query
def citation_dataset(spark, sf_dir):
    review = standins.table(spark, sf_dir, "labels").select(standins.work_id("doc_id").alias("id"))
    return screening.citation_dataset(
        standins.edges(spark, sf_dir),
        standins.dated_works(spark, sf_dir),
        standins.seed_ids(spark, sf_dir),
        review,
        ("id", "doi", "title", "abstract", "publication_date"),
    )


@query
def citation_unresolved(spark, sf_dir):
    """Works found by snowballing of which only the id is known."""
    return candidates.unresolved(_snowball(spark, sf_dir), standins.works(spark, sf_dir))


@query
def snowball_summary(spark, sf_dir):
    found = _snowball(spark, sf_dir).join(standins.dates(spark, sf_dir), "id", "left")
    return citations.level_summary(found, SINCE)


# Corpus


@query
def corpus_counts(spark, sf_dir):
    works = standins.dated_works(spark, sf_dir).select("abstract", "publication_year")
    return profile.corpus_counts(works, SINCE)


@query
def column_profile(spark, sf_dir):
    return profile.column_profile(standins.dated_works(spark, sf_dir))


@query
def abstract_rebuild(spark, sf_dir):
    raw = standins.inverted_works(spark, sf_dir)
    return raw.select("doc_id", text.rebuild_abstract("abstract_inverted_index").alias("abstract"))


@query
def work_text(spark, sf_dir):
    told = standins.works(spark, sf_dir).filter(text.has_text())
    return told.select("id", text.encoder_text(text.document_text()).alias("text"))


@query
def restored_text(spark, sf_dir):
    """Texts whose commas were lost to a control character, as hyphens."""
    damaged = F.replace(F.col("abstract"), F.lit(","), F.lit("\x02")).alias("abstract")
    works = standins.works(spark, sf_dir).select("id", damaged)
    return works.select("id", text.restore_hyphens("abstract").alias("abstract"))


@query
def embed_documents(spark, sf_dir):
    """The numbers of the encoder's vectors that are not zero."""
    placed = _encoded(standins.works(spark, sf_dir)).select("id", F.posexplode("embedding").alias("place", "x"))
    return placed.filter(F.col("x") != 0).select("id", "place", F.round(F.col("x").cast("double"), 5).alias("x"))


@query
def embed_truncated(spark, sf_dir):
    """As embed_documents, by the first words of each text up to the encoder's limit of tokens."""
    works = standins.works(spark, sf_dir).select("id", text.document_text().alias("text"))
    vectors = embedding.embed(works, max_tokens=MAX_TOKENS).select("id", F.posexplode("embedding").alias("place", "x"))
    return vectors.filter(F.col("x") != 0).select("id", "place", F.round(F.col("x").cast("double"), 5).alias("x"))


@query
def embed_profile(spark, sf_dir):
    """Length of each embedding and the number of terms that went into it."""
    works = standins.works(spark, sf_dir).select("id", text.document_text().alias("text"))
    terms = embedding.scale(embedding.hashed_terms(works, "text"))
    squares = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    count = F.aggregate(vector_to_array("terms"), F.lit(0.0), lambda t, x: t + x)
    return terms.select(
        "id",
        F.size("embedding").alias("dim"),
        F.round(F.sqrt(squares), 5).alias("norm"),
        count.cast("long").alias("n_terms"),
    )


# Feed


@query
def feed_filter(spark, sf_dir):
    vectors = standins.corpus(spark, sf_dir)
    kept = feed.recent(vectors, standins.dates(spark, sf_dir), SINCE, on=("id",))
    accepted, _ = feed.split_valid(kept, standins.DIM)
    return accepted.select("id", F.size("embedding").alias("dim"), _checksum("embedding"))


@query
def feed_rejected(spark, sf_dir):
    """Works that cannot be stored, as they have no vector."""
    rows = standins.works(spark, sf_dir).select("id").join(standins.corpus(spark, sf_dir), "id", "left")
    _, rejected = feed.split_valid(rows, standins.DIM)
    return rejected.select("id", "reason")


@query
def feed_invalid_vectors(spark, sf_dir):
    """Given vectors, most of them damaged in one of several ways, with what is wrong."""
    kind, vector = F.col("vec_id") % 6, F.col("embedding")
    damaged = (
        F.when(kind == 1, F.slice(vector, 1, standins.DIM - 1))
        .when(kind == 2, F.transform(vector, lambda x, n: F.when(n != 3, x)))
        .when(kind == 3, F.transform(vector, lambda x, n: F.when(n != 5, x).otherwise(float("nan"))))
        .when(kind != 4, vector)
    )
    rows = standins.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(kind != 5, standins.work_id("vec_id")).alias("id"), damaged.alias("embedding")
    )
    accepted, rejected = feed.split_valid(rows, standins.DIM)
    return accepted.select("vec_id", F.lit("accepted").alias("reason")).unionByName(rejected.select("vec_id", "reason"))


@query
def keep_latest(spark, sf_dir):
    versions = standins.table(spark, sf_dir, "lineitem").select(
        standins.work_id("l_partkey").alias("id"),
        F.to_date("l_shipdate").alias("updated_date"),
        F.col("l_linenumber").alias("part"),
        F.col("l_orderkey").alias("source"),
        F.col("l_extendedprice").alias("value"),
    )
    return feed.keep_latest(versions)


@query
def fed_counts(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("updated_date"), F.col("o_orderstatus").alias("part")
    )
    return feed.fed_counts(rows)


@query
def published_vectors(spark, sf_dir):
    path = staged_path(spark, "vectors")
    writers.publish_vectors(standins.corpus(spark, sf_dir), path)
    return readers.read_parquet_parts(spark, path).select("id", _checksum("embedding"))


# Recall


@query
def recall_lists(spark, sf_dir):
    lists = recall.rank_lists(standins.hits(spark, sf_dir))
    works = standins.works(spark, sf_dir).select("id")
    entries = F.transform(
        "inclusions_recall_data", lambda e: F.concat(e["rank"].cast("string"), F.lit("@"), e["query_id"])
    )
    return works.join(lists, "id", "left").select("id", F.array_join(entries, " ").alias("entries"))


@query
def recall_min_rank(spark, sf_dir):
    return recall.best_rank(standins.hits(spark, sf_dir))


def _similarities(spark, sf_dir):
    """Every labelled record's text against those of the seeds and of the criteria, all encoded alike."""
    labelled = standins.table(spark, sf_dir, "labels").select(
        standins.work_id("doc_id").alias("id"), F.concat(F.lit("M"), F.col("doc_id").cast("string")).alias("MID")
    )
    told = labelled.join(standins.works(spark, sf_dir), "id")
    # Encoded once for as long as labels and documents stay the same.
    vectors = materialize_known(_encoded(told, "id", "MID"), f"{run_folder(spark)}/encoded-labelled")
    seeds_of = vectors.join(standins.seed_ids(spark, sf_dir), "id")
    queries = stage(seeds_of.select("query_pos", text.full_id(F.col("id")).alias("query_id"), "embedding"), "seeds")
    newest = standins.table(spark, sf_dir, "documents").agg(F.max("doc_id").alias("doc_id"))
    criteria = standins.works(spark, sf_dir).join(newest.select(standins.work_id("doc_id").alias("id")), "id")
    criteria = materialize_known(_encoded(criteria), f"{run_folder(spark)}/encoded-criteria")
    nearest = similarity.most_similar(vectors, queries, key="MID")
    to_criteria = similarity.similarity_to(vectors, criteria, "criteria_similarity", key="MID")
    return nearest, to_criteria


@query
def recall_similarity(spark, sf_dir):
    nearest, to_criteria = _similarities(spark, sf_dir)
    return nearest.join(to_criteria, "MID").select(
        "MID",
        "query_id",
        F.round("similarity", 6).alias("similarity"),
        F.round("criteria_similarity", 6).alias("criteria_similarity"),
    )


def _attributed(spark, sf_dir, reranked=None):
    nearest, to_criteria = _similarities(spark, sf_dir)
    hits, near = standins.both_hits(spark, sf_dir)
    table = standins.master(spark, sf_dir)
    found = recall.attribute(table, hits, near, nearest, to_criteria, reranked)
    return (
        found.withColumn("n_lists", F.size("inclusions_recall_data"))
        .withColumn("inclusions_similarity", F.round("inclusions_similarity", 6))
        .withColumn("criteria_similarity", F.round("criteria_similarity", 6))
        .drop("inclusions_recall_data", "title", "abstract")
    )


@query
def recall_master(spark, sf_dir):
    return _attributed(spark, sf_dir)


@query
def recall_master_reranked(spark, sf_dir):
    """Positions in the enriched dataset C, which lacks works that were not found."""
    found = screening.reranked_dataset(_reranked(spark, sf_dir), standins.works(spark, sf_dir))
    return _attributed(spark, sf_dir, found)


@query
def recall_master_linear(spark, sf_dir):
    found = screening.reranked_dataset(_reranked(spark, sf_dir, rerank.linear), standins.works(spark, sf_dir))
    placed = _attributed(spark, sf_dir, found)
    return placed.withColumn("logistic_score", F.round("logistic_score", 6))


@query
def recall_at_n(spark, sf_dir):
    relevant = standins.table(spark, sf_dir, "labels").filter(F.col("toxic") == 1)
    relevant = relevant.select(standins.work_id("doc_id").alias("id"))
    curve = recall.recall_curve(standins.hits(spark, sf_dir), relevant, standins.DEPTH)
    return curve.withColumn("recall", F.round("recall", 6))


# Master table


def _linked(spark, sf_dir):
    hits, near = standins.both_hits(spark, sf_dir)
    pool, near = candidates.keep_first(candidates.cut(hits, CUT)), candidates.cut(near, CUT)
    full = text.full_id(F.col("id")).alias("id")
    reranked = _reranked(spark, sf_dir, rerank.linear)
    datasets = {"included": pool.select(full), "criteria": near.select(full), "reranked": reranked.select(full)}
    return standins.master(spark, sf_dir), datasets


@query
def link_flags(spark, sf_dir):
    table, datasets = _linked(spark, sf_dir)
    for name, rows in datasets.items():
        table = master.flag_members(table, rows, f"in_{name}", on="openalex_id")
    return table.select("MID", "openalex_id", *[f"in_{name}" for name in datasets])


@query
def link_coverage(spark, sf_dir):
    table, datasets = _linked(spark, sf_dir)
    rows = None
    for name, dataset in datasets.items():
        flagged = master.flag_members(dataset, table, "in_master", other_on="openalex_id")
        held = master.flag_members(table, dataset, "in_dataset", on="openalex_id")
        one = master.coverage(flagged, F.col("in_master")).select(
            F.lit(name).alias("dataset"),
            F.col("n_rows").alias("n_dataset"),
            F.col("n_members").alias("dataset_in_master"),
            master.coverage(held, F.col("in_dataset")).select("n_members").scalar().alias("master_in_dataset"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def master_upsert(spark, sf_dir):
    works = standins.works(spark, sf_dir)
    return screening.update_master(standins.master(spark, sf_dir), standins.hits(spark, sf_dir), works, CUT)


@query
def master_max_number(spark, sf_dir):
    return master.max_number(standins.master(spark, sf_dir))


# Files


@query
def manifest_files(spark, sf_dir):
    pages = standins.table(spark, sf_dir, "pages").select("url")
    return manifest.file_paths(pages, "source_data")


@query
def snapshot_completeness(spark, sf_dir):
    """Orders per day as declared, against those with a line item as read."""
    orders = standins.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.lower("o_orderstatus").alias("part")
    )
    file = F.concat(F.lit("updated_date="), F.col("day"), F.lit("/part_"), F.col("part"), F.lit(".gz"))
    entries = orders.groupBy(F.concat(F.lit("data/works/"), file).alias("url")).agg(
        F.count("*").alias("record_count")
    )
    sold = standins.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    counts = orders.join(sold.distinct(), "o_orderkey", "left_semi").groupBy(file.alias("file")).agg(F.count("*").alias("n_read"))
    return manifest.completeness(entries, counts).select(
        "file",
        text.partition_value(F.col("file")).alias("updated_date"),
        text.part_number(F.col("file")).alias("part"),
        "record_count",
        "n_read",
        "state",
    )


@query
def snapshot_delta(spark, sf_dir):
    """Orders by month and status in one snapshot and all but some of them in the next: rows fed again, ids retracted.

    In the second snapshot fulfilled orders of the last year are no longer there, and urgent ones lie in a file of their own.
    """
    orders = standins.table(spark, sf_dir, "orders").select(
        standins.work_id("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM").alias("updated_date"), "o_orderstatus",
        "o_orderpriority", F.year("o_orderdate").alias("year"),
    )
    last = orders.agg(F.max("year")).first()[0]
    later = orders.where(~((F.col("year") == last) & (F.col("o_orderstatus") == "F")))
    later = later.withColumn("o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", "U").otherwise(F.col("o_orderstatus")))
    scans, manifests = [], []
    for rows in (orders, later):
        folder = staged_path(spark, "snapshot")
        rows.select("id", F.concat_ws("-", "updated_date", "o_orderstatus").alias("updated_date")).repartition("updated_date").write.partitionBy(
            "updated_date"
        ).json(folder)
        scan = spark.read.schema("id string, updated_date string").json(folder)
        scans.append(scan)
        counts = manifest.file_counts(scan).select(F.element_at(F.split("file", "/"), 1).alias("folder"), F.col("n_read").alias("record_count"))
        # Files are named anew by each write; the manifest names them by their folder.
        url = F.concat(F.lit("data/"), "folder", F.lit("/part_000"))
        manifests.append(stage(counts.select(url.alias("url"), F.lit(None).cast("long").alias("content_length"), "record_count"), "manifest"))
    delta = stage(manifest.snapshot_delta(*manifests), "delta")
    named = [scan.select("id", F.concat(F.lit("updated_date="), "updated_date", F.lit("/part_000")).alias("file")) for scan in scans]
    fresh = stage(named[1].join(delta.where("state IN ('new', 'changed')"), "file", "left_semi"), "fresh")
    gone = manifest.retracted(named[0], delta, fresh)
    fed = fresh.groupBy(F.lit("fed").alias("step")).agg(F.count("*").alias("n"))
    dropped = gone.groupBy(F.lit("retracted").alias("step")).agg(F.count("*").alias("n"))
    return delta.groupBy(F.col("state").alias("step")).agg(F.count("*").alias("n")).unionByName(fed).unionByName(dropped)


@query
def manifest_scan(spark, sf_dir):
    """A manifest of all orders per month against a scan of the files written of the sold ones."""
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("updated_date"))
    sold = standins.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    scanned, listed = staged_path(spark, "scanned"), staged_path(spark, "manifest")
    month = orders.join(sold, "o_orderkey", "left_semi").repartition("updated_date")
    month.write.partitionBy("updated_date").json(scanned)
    counts = stage(manifest.file_counts(spark.read.schema("o_orderkey long").json(scanned)), "counts")
    declared = orders.groupBy("updated_date").agg(F.count("*").alias("record_count"))
    named = counts.select("file", text.partition_value(F.col("file")).alias("updated_date"))
    absent = F.concat(F.lit("updated_date="), "updated_date", F.lit("/none"))
    url = F.concat(F.lit("data/works/"), F.coalesce("file", absent)).alias("url")
    meta = F.struct(F.lit(None).cast("long").alias("content_length"), "record_count").alias("meta")
    entries = declared.join(named, "updated_date", "left").agg(F.collect_list(F.struct(url, meta)).alias("entries"))
    entries.write.json(listed)
    found = manifest.completeness(manifest.read_manifest(spark, listed), counts)
    return found.select(text.partition_value(F.col("file")).alias("updated_date"), "record_count", "n_read", "state")


@query
def vector_json(spark, sf_dir):
    """The criteria vector written as one JSON array and read back."""
    path = staged_path(spark, "vector")
    standins.criteria(spark, sf_dir).select(F.to_json("embedding").alias("value")).coalesce(1).write.text(path)
    return readers.read_vector(spark, path).select(F.size("embedding").alias("dim"), _checksum("embedding"))


@query
def master_csv(spark, sf_dir):
    """The master table written as CSV and read back, with its missing values."""
    path = f"{staged_path(spark, 'master')}.csv"
    writers.write_csv(standins.master(spark, sf_dir), path)
    return readers.read_master(spark, path, standins.MASTER_SCHEMA)


@query
def hits_parquet(spark, sf_dir):
    """Hits with their vectors as written by a search and read again."""
    found, path = stage(standins.criteria_hits(spark, sf_dir), "criteria"), staged_path(spark, "hits")
    writers.write_parquet(neighbors.with_vectors(found, standins.corpus(spark, sf_dir), standins.DEPTH), path)
    return spark.read.parquet(path).select("rank", "id", _checksum("embedding"))


@query
def materialized_twice(spark, sf_dir):
    """The second call finds the first one's table and computes nothing."""
    path = staged_path(spark, "once")
    counts = standins.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    materialize(counts, path)
    return materialize(counts.withColumn("n", F.raise_error(F.lit("computed again")).cast("long")), path)


@query
def materialized_changed(spark, sf_dir):
    """A table computed once, once again from the same input, and anew after a delivery changed the input."""
    folder, kept = staged_path(spark, "source"), staged_path(spark, "known")
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    answers = []
    for call, given in enumerate((orders.where("o_orderstatus <> 'P'"), None, orders.where("o_orderstatus = 'P'"))):
        if given is not None:
            given.write.mode("append").parquet(folder)
        read = spark.read.schema(orders.schema).parquet(folder)
        counts = read.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
        table = materialize_known(counts, kept)
        answers.append(table.withColumns({"call": F.lit(call), "file": F.substring_index(F.col("_metadata.file_path"), "/", -1)}))
    once = answers[0].unionByName(answers[1])
    same = once.groupBy("o_orderstatus", "n").agg((F.count_distinct("file") == 1).alias("computed_once"), F.lit(0).alias("call"))
    return same.unionByName(answers[2].select("o_orderstatus", "n", F.lit(True).alias("computed_once"), "call"))


@query
def cleaned_floats(spark, sf_dir):
    """Discounts with not-a-number for none, read as null."""
    price = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("discount")
    lines = standins.table(spark, sf_dir, "lineitem").select("l_returnflag", price)
    return readers.clean_floats(lines).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count("discount").alias("n_discount"), F.round(F.sum("discount"), 4).alias("discount")
    )


@query
def parts_pruned(spark, sf_dir):
    """Vectors of one update date; the other folders are not opened."""
    path = staged_path(spark, "parts")
    dated = standins.corpus(spark, sf_dir).join(standins.dates(spark, sf_dir), "id")
    dated = dated.select("id", "embedding", F.col("publication_year").cast("string").alias("updated_date"))
    dated.hint("rebalance", "updated_date").write.partitionBy("updated_date").parquet(path)
    parts = readers.read_parquet_parts(spark, path).filter(F.col("updated_date") == SINCE)
    return parts.select("id", F.col("updated_date").cast("int").alias("updated_date"), _checksum("embedding"))


@query
def upsert_corrected(spark, sf_dir):
    """All vectors, then some of them again under the same version, doubled: the correction stays."""
    first = standins.corpus(spark, sf_dir).select("id", F.lit("2024-01-01").alias("updated_date"), F.lit("1").alias("part"), "embedding")
    number = F.substring("id", 2, 20).cast("long")
    doubled = F.transform("embedding", lambda x: (x * 2).cast("float"))
    again = first.filter(number % 3 == 0).withColumn("embedding", doubled)
    folder = staged_path(spark, "arriving")
    table, rejected, progress = (staged_path(spark, name) for name in ("table", "rejected", "progress"))
    for rows in (first, again):
        rows.coalesce(1).write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(first.schema).parquet(folder)
        upsert.upsert_stream(arriving, table, rejected, progress, standins.DIM, buckets=8).awaitTermination()
    upsert.vacuum(spark, table)
    return upsert.current(spark, table).select("id", _checksum("embedding"))


def _json_works(spark, sf_dir):
    path = staged_path(spark, "works")
    # Texts are dealt and sorted by folder; the index, several times as large, is made as it is written.
    texts = standins.dated_texts(spark, sf_dir).hint("rebalance", "updated_date").sortWithinPartitions("updated_date")
    raw = standins.with_index(texts).select(*standins.RAW_COLUMNS)
    raw.write.partitionBy("updated_date").option("compression", "gzip").json(path)
    return path


WORK_FILES = "part-*.gz"


@query
def ingest_json(spark, sf_dir):
    raw = readers.read_works(spark, _json_works(spark, sf_dir), pattern=WORK_FILES)
    return readers.prepare_works(raw).drop("part")


@query
def ingest_stream(spark, sf_dir):
    source = _json_works(spark, sf_dir)
    output, checkpoint = staged_path(spark, "ingested"), staged_path(spark, "progress")
    ingest.ingest_stream(spark, source, output, checkpoint, pattern=WORK_FILES).awaitTermination()
    return spark.read.schema(ingest.PREPARED).parquet(output).drop("part")


@query
def write_split(spark, sf_dir):
    """Texts and hashed vectors written as two tables and joined again."""
    texts, vectors = staged_path(spark, "texts"), staged_path(spark, "vectors")
    corpus.build(spark, _json_works(spark, sf_dir), texts, vectors, WORK_FILES)
    kept, _ = corpus.searchable(spark.read.parquet(vectors), min_year=SINCE)
    both = spark.read.parquet(texts).join(kept.select("id", "part", "embedding"), ["id", "part"])
    return both.select("id", "title", "abstract", "publication_year", F.size("embedding").alias("dim"))


@query
def upsert_deleted(spark, sf_dir):
    """All vectors, then a batch in which works of quality 0 are gone, then included ones of them again."""
    vectors = standins.corpus(spark, sf_dir).withColumns({"part": F.lit("0"), "gone": F.lit(False)})
    first = vectors.withColumn("updated_date", F.lit("2024-01-01")).select("id", "updated_date", "part", "embedding", "gone")
    labels = standins.table(spark, sf_dir, "labels").where("quality = 0").select(standins.work_id("doc_id").alias("id"), "toxic")
    none = F.lit(None).cast("array<float>")
    dead = labels.select("id", F.lit("2024-01-02").alias("updated_date"), F.lit("0").alias("part"), none.alias("embedding"), F.lit(True).alias("gone"))
    back = first.join(labels.where("toxic = 1").select("id"), "id").withColumn("updated_date", F.lit("2024-01-03"))
    # A row of an earlier version that comes late does not bring its id back.
    late = first.join(labels.where("toxic = 0").select("id"), "id")
    folder, (table, rejected, progress) = staged_path(spark, "arriving"), (staged_path(spark, n) for n in ("table", "rejected", "progress"))
    for rows in (first, dead, back.unionByName(late)):
        rows.write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(first.schema).parquet(folder)
        upsert.upsert_stream(arriving, table, rejected, progress, standins.DIM).awaitTermination()
    kept = upsert.current(spark, table).select("id", "updated_date", _checksum("embedding"))
    return kept.unionByName(upsert.gone(spark, table).select("id", "updated_date", F.lit(None).cast("double").alias("checksum")))


@query
def upsert_stream(spark, sf_dir):
    """Versions of vectors arriving file by file; the last one of each id stays."""
    versions = standins.table(spark, sf_dir, "lineitem").select(
        standins.work_id("l_partkey").alias("id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("updated_date"),
        F.col("l_linenumber").cast("string").alias("part"),
    )
    rows = stage(versions.join(standins.corpus(spark, sf_dir), "id", "left"), "versions")
    folder = rows.inputFiles()[0].rsplit("/", 1)[0]
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(folder)
    table, rejected = staged_path(spark, "table"), staged_path(spark, "rejected")
    running = upsert.upsert_stream(arriving, table, rejected, staged_path(spark, "progress"), standins.DIM)
    running.awaitTermination()
    kept = upsert.current(spark, table).select(
        "id", "updated_date", "part", _checksum("embedding"), F.lit(None).cast("string").alias("reason")
    )
    refused = spark.read.parquet(rejected).groupBy("id", "reason").agg(
        F.max("updated_date").alias("updated_date"), F.max("part").alias("part")
    )
    return kept.unionByName(refused.withColumn("checksum", F.lit(None).cast("double")))
