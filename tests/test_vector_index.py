import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.operators import vector_index
from sieveline.operators.clusters import recall_report
from sieveline.operators.neighbors import nearest
from sieveline.staging import staged_path

SCHEMA = "id string, embedding array<float>"


def grouped(n, seed, groups=12, dim=5):
    rng = np.random.default_rng(seed)
    centers = np.random.default_rng(0).normal(size=(groups, dim)) * 4
    return (centers[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * 0.3).astype(np.float32)


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in vectors.items()], SCHEMA)


def asked(spark, matrix):
    rows = [(n, f"q{n}", row.tolist()) for n, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_pos long, query_id string, embedding array<float>")


def rows(found):
    return sorted((r.query_pos, r.rank, r.id, r.distance) for r in found.collect())


@pytest.fixture(scope="module")
def life(spark):
    """(index, the vectors that should stand) after inserts, deletes and one id that comes back."""
    standing = {f"W{n}": v for n, v in enumerate(grouped(1_500, 1))}
    corpus = frame(spark, standing).cache()
    centers = vector_index.fit_two_levels(corpus, 4, 5).cache()
    index = vector_index.create_vector_index(corpus, centers, staged_path(spark, "life"))
    moved = {f"W{n}": v for n, v in zip(range(1_400, 1_700), grouped(300, 2))}
    index.insert(frame(spark, moved | {"bad": None, "short": [1.0]}), 1)
    gone = [f"W{n}" for n in range(0, 1_600, 5)]
    index.delete(spark.createDataFrame([(i,) for i in [*gone, "W99999", None]], "id string"), 2)
    back = {"W0": np.float32([1, 2, 3, 4, 5])}
    index.insert(frame(spark, back), 3)
    standing |= moved
    return index, {i: v for i, v in standing.items() if i not in gone} | back


def test_two_levels_of_centers(life):
    centers = life[0].centers.collect()
    assert len({r.coarse for r in centers}) == 4 and len({r.cluster for r in centers}) == len(centers) <= 20


def test_what_stands(spark, life):
    index, standing = life
    found = {r.id: np.float32(r.embedding) for r in index.vectors().collect()}
    assert index.vectors().count() == len(found) and found.keys() == standing.keys()
    assert all((found[i] == np.float32(v)).all() for i, v in standing.items())
    # Another run opens the same files.
    assert vector_index.VectorIndex(spark, index.path).vectors().count() == len(standing)


def test_search_and_probes(spark, life):
    index, standing = life
    queries, whole = asked(spark, grouped(30, 7)), frame(spark, standing)
    exact = nearest(whole, queries, 20).cache()
    assert rows(index.search(queries, 20, 20)) == rows(exact)
    for given in (queries, None):
        probes, recall = index.probes_for(20, 0.9, given)
        assert 1 <= probes < 20 and recall >= 0.9
    probes, recall = index.probes_for(20, 0.9, queries)
    found = recall_report(index.search(queries, 20, probes), exact).agg(F.avg("recall")).first()[0]
    assert found == pytest.approx(recall)
    if probes > 1:
        less = recall_report(index.search(queries, 20, probes - 1), exact).agg(F.avg("recall")).first()[0]
        assert less < 0.9
    # Copies are read from the folders of the probed clusters only.
    text = index.vectors().where("cluster IN (1, 2)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cluster" in text


def test_nothing_is_rewritten_and_compaction_keeps_all(spark, life):
    index, standing = life
    before = set(index._rows().inputFiles())
    index.insert(frame(spark, {"W0": standing["W0"]}), 9)
    assert before < set(index._rows().inputFiles())
    small = index.compact(staged_path(spark, "compact"))
    assert {r.id for r in small.vectors().collect()} == set(standing) and small._changes().count() == 0
    with pytest.raises(ValueError, match="not later"):
        index.delete(spark.createDataFrame([("W1",)], "id string"), 9)


def test_empty(spark, life):
    index = vector_index.create_vector_index(frame(spark, {}), life[0].centers, staged_path(spark, "empty"))
    assert index.vectors().collect() == [] and index.search(asked(spark, grouped(2, 1)), 3, 20).collect() == []
    index.insert(frame(spark, {"a": [1.0] * 5}), 1)
    assert [r.id for r in index.vectors().collect()] == ["a"]
