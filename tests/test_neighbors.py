import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline import settings
from sieveline.functions import vectors
from sieveline.operators import clusters, neighbors, similarity

CORPUS = "id string, embedding array<float>"
QUERIES = "query_pos long, query_id string, embedding array<float>"


def make(spark, n=300, dim=8, q=5, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).astype(np.float32)
    if copies:
        data[:copies] = data[0]
    corpus = spark.createDataFrame([(f"W{i}", row.tolist()) for i, row in enumerate(data)], CORPUS)
    queries = spark.createDataFrame(
        [(10 * i, f"https://openalex.org/W{i}", data[i].tolist()) for i in range(q)], QUERIES
    )
    return data.astype(np.float64), corpus, queries


def brute(data, q, k, metric="euclidean"):
    found = []
    for i in range(q):
        if metric == "euclidean":
            distance = np.sqrt(((data - data[i]) ** 2).sum(axis=1))
        else:
            size = np.sqrt((data**2).sum(axis=1) * (data[i] ** 2).sum())
            distance = 1 - np.divide(data @ data[i], size, out=np.zeros(len(data)), where=size > 0)
        order = sorted(range(len(data)), key=lambda n: (round(distance[n], 9), f"W{n}"))[:k]
        found += [(10 * i, rank, f"W{n}") for rank, n in enumerate(order)]
    return found


def triples(hits):
    return sorted((r.query_pos, r["rank"], r.id) for r in hits.collect())


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("k", [1, 20, 1000])
def test_agrees_with_brute_force(spark, metric, k):
    data, corpus, queries = make(spark)
    hits = neighbors.nearest(corpus, queries, k, metric)
    assert triples(hits) == sorted(brute(data, 5, k, metric))


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_partitioning_does_not_matter(spark, parts):
    data, corpus, queries = make(spark, copies=120)
    hits = neighbors.nearest(corpus.repartition(parts), queries, 30)
    assert triples(hits) == sorted(brute(data, 5, 30))


def test_many_copies_are_ordered_by_id(spark):
    _, corpus, queries = make(spark, n=400, copies=200)
    hits = triples(neighbors.nearest(corpus, queries.limit(1), 50))
    assert [h[2] for h in hits] == sorted(f"W{n}" for n in range(200))[:50]


def test_blocks_agree_with_one_scan(spark, monkeypatch):
    monkeypatch.setattr(settings, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(settings, "BLOCK_VECTORS", 25)
    data, corpus, queries = make(spark, copies=40)
    expected = sorted(brute(data, 5, 15))
    assert triples(neighbors.nearest(corpus, queries, 15, max_bytes=0)) == expected
    monkeypatch.setattr(settings, "FIRST_BLOCKS", 4)
    assert triples(neighbors.nearest(corpus, queries, 15, max_bytes=0)) == expected
    assert triples(neighbors.nearest(corpus, queries, 15, max_hits=30)) == expected


def test_salted_merge(spark, monkeypatch):
    monkeypatch.setattr(settings, "MERGE_ROWS", 50)
    data, corpus, queries = make(spark)
    assert triples(neighbors.nearest(corpus, queries, 12)) == sorted(brute(data, 5, 12))


def test_smaller_k_is_a_prefix(spark):
    _, corpus, queries = make(spark)
    short, long = (triples(neighbors.nearest(corpus, queries, k)) for k in (7, 25))
    assert short == [hit for hit in long if hit[1] < 7]


def test_self_hits(spark):
    data, corpus, queries = make(spark)
    own = {(10 * i, f"W{i}") for i in range(5)}
    assert own <= {(pos, id) for pos, _, id in triples(neighbors.nearest(corpus, queries, 5))}
    without = triples(neighbors.nearest(corpus, queries, 5, exclude_self=True))
    assert not own & {(pos, id) for pos, _, id in without}
    assert [rank for pos, rank, _ in without if pos == 10] == [0, 1, 2, 3, 4]


def test_no_queries_and_unusable_rows(spark):
    data, corpus, queries = make(spark)
    assert neighbors.nearest(corpus, queries.limit(0), 5).count() == 0
    unknown = spark.createDataFrame([(99, "none", None)], QUERIES)
    assert triples(neighbors.nearest(corpus, queries.unionByName(unknown), 9)) == sorted(brute(data, 5, 9))
    odd = spark.createDataFrame([("X", None), ("Y", [1.0])], CORPUS)
    hits = neighbors.nearest(corpus.unionByName(odd), queries, 400)
    assert triples(hits) == sorted(brute(data, 5, 400))


def test_zero_vector_is_similar_to_nothing(spark):
    corpus = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [1.0, 1.0]), ("c", [-1.0, 0.0])], CORPUS)
    queries = spark.createDataFrame([(0, "q", [1.0, 0.0])], QUERIES)
    hits = neighbors.nearest(corpus, queries, 3, "cosine").orderBy("rank").collect()
    assert [h.id for h in hits] == ["b", "a", "c"]
    assert [round(h.distance, 6) for h in hits] == [0.292893, 1.0, 2.0]


def test_expressions(spark):
    row = spark.createDataFrame([([3.0, 0.0], [0.0, 4.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    found = row.select(
        vectors.euclidean("a", "b"), vectors.cosine("a", "a"), vectors.cosine("a", "z"), vectors.closeness(F.lit(1.0))
    ).first()
    assert tuple(found) == (5.0, 1.0, 0.0, 0.5)


def test_bfloat16(spark):
    import pyarrow as pa

    column = pa.array([[1.0, 1.00390625, 1.01171875, -3.3]], pa.list_(pa.float32()))
    assert vectors.as_matrix(column, "bfloat16").tolist() == [[1.0, 1.0, 1.015625, -3.296875]]


def test_depth_check(spark):
    _, corpus, queries = make(spark, n=10)
    neighbors.check_depth(neighbors.nearest(corpus, queries, 10), 10)
    with pytest.raises(ValueError):
        neighbors.check_depth(neighbors.nearest(corpus, queries, 10), 11)


def test_vectors_of_hits(spark):
    data, corpus, queries = make(spark)
    hits = neighbors.nearest(corpus, queries, 3)
    for row in neighbors.with_vectors(hits, corpus, 15).collect():
        assert np.allclose(row.embedding, data[int(row.id[1:])])


def test_all_clusters_are_exact_and_few_are_a_subset(spark, tmp_path):
    data, corpus, queries = make(spark)
    centers = clusters.fit_centers(corpus, 6)
    table = clusters.write_clusters(corpus, centers, str(tmp_path / "clusters"))
    every = clusters.nearest_in_clusters(table, centers, queries, 20, 6)
    assert triples(every) == sorted(brute(data, 5, 20))
    some = clusters.nearest_in_clusters(table, centers, queries, 20, 2)
    in_blocks = clusters.nearest_in_clusters(table, centers, queries, 20, 2, max_bytes=0)
    assert triples(in_blocks) == triples(some)
    unknown = spark.createDataFrame([(99, "none", None)], QUERIES)
    assert clusters.nearest_in_clusters(table, centers, queries.limit(0).union(unknown), 20, 2).count() == 0
    report = clusters.recall_report(some, every).collect()
    assert all(0 < row.recall <= 1 and row.n_exact == 20 for row in report)


def test_probed_clusters_are_pruned(spark, tmp_path, plan):
    _, corpus, queries = make(spark)
    centers = clusters.fit_centers(corpus, 6)
    table = clusters.write_clusters(corpus, centers, str(tmp_path / "clusters"))
    text = plan(clusters.nearest_in_clusters(table, centers, queries.limit(1), 20, 1))
    assert "PartitionFilters: [isnotnull(cluster" in text or "PartitionFilters: [(cluster" in text


def test_plan_limits_groups_before_the_shuffle(spark, plan):
    _, corpus, queries = make(spark)
    text = plan(neighbors.nearest(corpus, queries, 5))
    assert text.count("WindowGroupLimit") >= 2
    assert text.count("MapInArrow") >= 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BroadcastHashJoin" in text


@pytest.mark.parametrize("limit", [10_000, 3])
def test_most_similar(spark, limit):
    data, corpus, queries = make(spark, q=6)
    found = similarity.most_similar(corpus, queries, max_references=limit).collect()
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    cos = unit @ unit[:6].T
    assert len(found) == len(data)
    for row in found:
        n = int(row.id[1:])
        assert row.query_pos == 10 * int(cos[n].argmax())
        assert row.query_id == f"https://openalex.org/W{cos[n].argmax()}"
        assert row.similarity == pytest.approx(cos[n].max(), abs=1e-9)


@pytest.mark.parametrize("limit", [10_000, 1])
def test_most_similar_takes_the_first_of_equals(spark, limit):
    corpus = spark.createDataFrame([("a", [1.0, 0.0]), ("z", [0.0, 0.0])], CORPUS)
    queries = spark.createDataFrame([(5, "late", [2.0, 0.0]), (3, "early", [1.0, 0.0]), (9, "x", [0.0, 1.0])], QUERIES)
    found = {r.id: (r.query_id, r.similarity) for r in similarity.most_similar(corpus, queries, max_references=limit).collect()}
    assert found == {"a": ("early", 1.0), "z": ("early", 0.0)}


def test_similarity_to_one_vector(spark):
    corpus = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], CORPUS)
    one = spark.createDataFrame([([3.0, 0.0],)], "embedding array<float>")
    found = similarity.similarity_to(corpus, one, "s").collect()
    assert {r.id: r.s for r in found} == {"a": 1.0, "b": 0.0}


def test_queries_that_cannot_be_compared_are_named(spark):
    _, corpus, queries = make(spark)
    dim = len(queries.first().embedding)
    for bad in ([1.0], [float("nan")] * dim, [None] * dim, []):
        odd = spark.createDataFrame([(99, "odd one", bad)], QUERIES)
        for search in (
            lambda asked: neighbors.nearest(corpus, asked, 3),
            lambda asked: neighbors.nearest(corpus, asked, 3, max_bytes=0),
            lambda asked: similarity.most_similar(corpus, asked),
        ):
            with pytest.raises(ValueError, match="odd one|W"):
                search(queries.unionByName(odd))


def test_rows_that_cannot_be_compared_are_no_hits(spark):
    data, corpus, queries = make(spark)
    dim = len(queries.first().embedding)
    odd = spark.createDataFrame([("X", [float("nan")] * dim), ("Y", [None] * dim), ("Z", [float("inf")] * dim)], CORPUS)
    every = corpus.unionByName(odd)
    for max_bytes in (10**9, 0):
        assert triples(neighbors.nearest(every, queries, 400, max_bytes=max_bytes)) == sorted(brute(data, 5, 400))
    assert similarity.most_similar(every, queries).count() == len(data)


def test_the_driver_receives_no_more_than_the_bound(spark, monkeypatch):
    _, corpus, queries = make(spark)
    received = []
    kind = type(queries)
    fetch = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: received.append(fetch(self)) or received[-1])
    dim = len(queries.first().embedding)
    neighbors.nearest(corpus, corpus.select(F.monotonically_increasing_id().alias("query_pos"), F.col("id").alias("query_id"), "embedding"), 1, max_bytes=dim * 8 * 7)
    assert sum(table.num_rows for table in received) <= 7
    neighbors.nearest(corpus, queries, 1, max_bytes=dim * 8 * 7)
    assert received and all(table.num_rows <= 7 for table in received)


def test_tasks_are_bounded_by_bytes(spark, tmp_path):
    from sieveline.staging import few_tasks

    path = str(tmp_path / "rows")
    spark.range(100_000).repartition(200).write.parquet(path)
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert few_tasks(rows)[1] == 4 * cores
    assert few_tasks(rows, task_bytes=1000)[1] > 4 * cores
