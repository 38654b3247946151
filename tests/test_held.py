"""What the search kernels hold does not grow with the queries."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sieveline import settings
from sieveline.functions import vectors
from sieveline.operators import neighbors, similarity


def chunked(matrix, size):
    ids = pa.array([f"W{n:05}" for n in range(len(matrix))])
    return [(ids.slice(at, size), matrix[at : at + size]) for at in range(0, len(matrix), size)]


@pytest.mark.parametrize("copies", [False, True])
def test_groups_of_queries(monkeypatch, copies):
    """Groups hold their own hits only, and give together what one pass over all queries gives."""
    rng = np.random.default_rng(3)
    rows, queries, k = rng.normal(size=(900, 5)), rng.normal(size=(70, 5)), 12
    rows[100:800] = rows[100] if copies else rows[100:800]
    monkeypatch.setattr(settings, "HELD_HITS", 20 * k)
    seen = []

    def add(best, chunk, start, stop):
        seen.append(stop - start)
        best.add(*chunk)

    found = {}
    for start, hits in neighbors.by_groups(queries, k, "euclidean", chunked(rows, 250), add):
        for hit in hits.to_pylist():
            found.setdefault(start + hit["query"], []).append((hit["distance"], hit["id"]))
    assert max(seen) == 20
    far = vectors.exact_distances(rows, *np.divmod(np.arange(900 * 70), 70)[:1], queries, np.arange(900 * 70) % 70, "euclidean").reshape(900, 70)
    for place in range(70):
        expected = sorted((distance, f"W{n:05}") for n, distance in enumerate(far[:, place].tolist()))[:k]
        assert sorted(found[place])[:k] == expected


def test_ties_at_the_last_place_go_by_id():
    best = vectors.RunningTopK(np.zeros((2, 3)), 2)
    for name in ("W3", "W1", "W2"):
        best.add(pa.array([name]), np.ones((1, 3)))
        best.compact()
    assert sorted((hit["query"], hit["id"]) for hit in best.result().to_pylist()) == [(q, w) for q in (0, 1) for w in ("W1", "W2")]


def test_similarity_in_steps():
    """Rows meet many references without a matrix of all pairs; close references are told apart in double precision."""
    rng = np.random.default_rng(5)
    rows, references = rng.normal(size=(3_000, 8)), rng.normal(size=(4_000, 8))
    references[2_000:] = references[:2_000] + 1e-6 * rng.normal(size=(2_000, 8))
    rows[7], references[9] = 0, references[1]
    tracemalloc.start()
    index, best = vectors.most_similar_rows(rows, references)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000
    sizes = np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(references, axis=1)[None, :]
    cos = np.divide(rows @ references.T, sizes, out=np.zeros(sizes.shape), where=sizes > 0)
    assert np.allclose(best, cos.max(axis=1), atol=1e-12) and np.allclose(cos[np.arange(3_000), index], best, atol=1e-12)
    assert index[7] == 0 and 9 not in index


def test_similarity_beyond_the_bound(spark, monkeypatch):
    """Blocks of rows and of references give what one block gives; the lowest position wins a tie, repeated keys stay."""
    rng = np.random.default_rng(6)
    matrix = rng.normal(size=(60, 4)).astype(np.float32)
    matrix[50:] = matrix[:10]
    rows = [(f"M{n % 55}", row.tolist()) for n, row in enumerate(matrix)] + [("none", None), ("zero", [0.0] * 4), (None, [1.0] * 4)]
    rows = spark.createDataFrame(rows, "MID string, embedding array<float>")
    asked = [(n, f"q{n}", matrix[n * 3 % 20].tolist()) for n in range(30)] + [(40, None, None)]
    asked = spark.createDataFrame(asked, "query_pos long, query_id string, embedding array<float>")
    whole = similarity.most_similar(rows, asked, key="MID").collect()
    monkeypatch.setattr(similarity, "ROW_BLOCK", 25)
    monkeypatch.setattr(similarity, "REFERENCE_BLOCK", 7)
    blocks = similarity.most_similar(rows, asked, key="MID", max_references=5).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, whole)) and len(whole) == 62
