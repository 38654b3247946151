"""What a search by more queries than are broadcast writes: each vector of the corpus once, and no texts."""

import numpy as np
import pytest

from sieveline import settings
from sieveline.functions import vectors
from sieveline.operators import neighbors
from sieveline.plans import catalog

CORPUS = "id string, embedding array<{}>"
QUERIES = "query_pos long, query_id string, embedding array<{}>"


def shuffled(spark, run):
    """(what `run` returns, rows and bytes that its stages wrote to shuffles)"""
    context = spark.sparkContext
    context._jsc.sc().listenerBus().waitUntilEmpty()
    store, none = context._jsc.sc().statusStore(), context._gateway.new_array(context._jvm.double, 0)

    def stages():
        found = store.stageList(None, False, False, none, None)
        found = [found.apply(n) for n in range(found.size())]
        return {(s.stageId(), s.attemptId()): (s.shuffleWriteRecords(), s.shuffleWriteBytes()) for s in found}

    before = stages()
    result = run()
    context._jsc.sc().listenerBus().waitUntilEmpty()
    written = [value for key, value in stages().items() if key not in before]
    return result, sum(w[0] for w in written), sum(w[1] for w in written)


def exact(data, asked, k):
    """(query_pos, rank, id) by brute force, equal distances in the order of ids."""
    found = []
    for n, vector in enumerate(asked):
        distance = np.sqrt(((data.astype(float) - vector.astype(float)) ** 2).sum(axis=1))
        order = sorted(range(len(data)), key=lambda row: (round(distance[row], 9), f"W{row}"))[:k]
        found += [(10 * n, rank, f"W{row}") for rank, row in enumerate(order)]
    return sorted(found)


def tables(spark, rows=300, queries=40, dim=8, kinds=("float", "float")):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(rows, dim)).astype(np.float32)
    data[:30] = data[0]
    corpus = spark.createDataFrame([(f"W{n}", row.tolist()) for n, row in enumerate(data)], CORPUS.format(kinds[0]))
    asked = [(10 * n, f"q{n}", row.tolist()) for n, row in enumerate(data[:queries])]
    return data, corpus, spark.createDataFrame(asked, QUERIES.format(kinds[1]))


def test_rows_are_shuffled_once(spark, monkeypatch):
    """40 queries in blocks of 2 and 300 rows: 20 copies of the rows were written before."""
    monkeypatch.setattr(settings, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(settings, "BLOCK_VECTORS", 100)
    data, corpus, queries = tables(spark)
    hits, records, _ = shuffled(spark, lambda: neighbors.nearest(corpus, queries, 3, max_bytes=0).collect())
    assert sorted((hit.query_pos, hit["rank"], hit.id) for hit in hits) == exact(data, data[:40], 3)
    # The rows, the queries for each of 3 blocks, up to 3 hits of each of them, twice, and small change.
    assert records < 300 + 40 * 3 + 2 * 40 * 3 * 3 + 300


@pytest.mark.parametrize("kinds", [("float", "float"), ("float", "double"), ("double", "float")])
@pytest.mark.parametrize("first", [1, 3, 64])
def test_blocks_by_numbers(spark, monkeypatch, kinds, first):
    """Blocks of at most so many numbers, some searched first, queries in small chunks and groups."""
    monkeypatch.setattr(settings, "BLOCK_CELLS", 8 * 20)
    monkeypatch.setattr(settings, "FIRST_BLOCKS", first)
    monkeypatch.setattr(settings, "HELD_HITS", 7 * 12)
    monkeypatch.setattr(settings, "CHUNK_CELLS", 8 * 9)
    data, corpus, queries = tables(spark, kinds=kinds)
    hits = neighbors.nearest(corpus, queries, 12, max_bytes=0).collect()
    assert sorted((hit.query_pos, hit["rank"], hit.id) for hit in hits) == exact(data, data[:40], 12)


def test_rows_are_held_in_their_precision():
    import pyarrow as pa

    column = pa.array([[0.1, 2.0]], pa.list_(pa.float32()))
    assert vectors.as_matrix(column, dtype=None).dtype == np.float32
    assert vectors.as_matrix(column).dtype == np.float64


def test_texts_stay_in_place(spark, tmp_path):
    """Neither the works' texts nor those searched for are shuffled, also where Spark broadcasts nothing by itself."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(chr(97 + n) for n in rng.integers(0, 26, 9))
    rows = [(n, " ".join(word() for _ in range(400)), "en", "src", 4000) for n in range(160)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(16).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(n, 1, int(n % 10 == 0)) for n in range(120)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        hits, _, written = shuffled(spark, lambda: catalog.search_by_text(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set(threshold, before)
    asked = {hit.query_pos for hit in hits}
    assert asked == {-1, *range(0, 120, 10)} and len(hits) == 20 * len(asked)
    assert all(hit.id == hit.query_id and hit.distance == 0 for hit in hits if hit["rank"] == 0)
    assert written < 160 * 4000 / 4


@pytest.mark.parametrize("size, shift", [(1, 0), (1, 1e4), (1e-3, 1e6), (1e-25, 0), (1e17, 0), (1e25, 0), (None, 0)])
def test_single_precision_loses_no_pair(size, shift):
    """Screening in single precision leaves the k nearest of double precision, also of vectors it cannot tell apart."""
    import pyarrow as pa

    rng = np.random.default_rng(7)
    data = rng.normal(size=(6_000, 24)) * (10.0 ** rng.integers(-12, 12, size=(6_000, 1)) if size is None else size) + shift
    data[1_000:1_050] = data[10]
    data[2_000:2_400] = data[10] * (1 + 1e-9 * rng.normal(size=(400, 1)))
    asked, k = data[:20], 15
    ids = [f"W{n:05}" for n in range(len(data))]
    best = vectors.RunningTopK(asked, k)
    for at in range(0, len(data), 500):
        best.add(pa.array(ids[at : at + 500]), data[at : at + 500])
        best.compact()
    row, col = np.divmod(np.arange(len(data) * 20), 20)
    far = vectors.exact_distances(data, row, asked, col, "euclidean").reshape(-1, 20)
    expected = [(q, *pair) for q in range(20) for pair in sorted(zip(far[:, q].tolist(), ids))[:k]]
    found = sorted((hit["query"], hit["distance"], hit["id"]) for hit in best.result().to_pylist())
    assert found == expected
    assert (best.single is None) == (size in (1e17, 1e25))
