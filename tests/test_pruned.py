import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.operators import pruned
from sieveline.operators.neighbors import nearest

SCHEMA = "id string, embedding array<float>"


def vectors(n, groups, dim=6, seed=4):
    """Vectors close to a few centers."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim)) * 5
    return (centers[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * 0.1).astype(np.float32), centers


def frame(spark, matrix, prefix="W"):
    return spark.createDataFrame([(f"{prefix}{n}", row.tolist()) for n, row in enumerate(matrix)], SCHEMA)


def asked(spark, matrix):
    rows = [(n, f"q{n}", row.tolist()) for n, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_pos long, query_id string, embedding array<float>")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    matrix, centers = vectors(3_000, 12)
    # A third of all rows is one vector; its cell is hot and cut into many blocks.
    matrix[:1_000] = matrix[0]
    corpus = frame(spark, matrix).cache()
    table = spark.createDataFrame([(n, c.tolist()) for n, c in enumerate(centers)], "cluster int, embedding array<double>")
    path = str(tmp_path_factory.mktemp("blocks") / "table")
    return corpus, matrix, pruned.write_blocks(corpus, table, path, block_rows=50, n_pivots=5, part_rows=400)


def rows(found):
    return sorted((r.query_pos, r.rank, r.id, r.distance) for r in found.collect())


@pytest.mark.parametrize("k", [1, 20, 1_200, 5_000])
def test_as_the_whole_search(spark, written, k):
    corpus, matrix, blocks = written
    queries = asked(spark, matrix[990:1_030] + np.float32(0.01))
    found = pruned.nearest_pruned(blocks, queries, k).cache()
    assert rows(found) == rows(nearest(corpus, queries, k))
    skipped = found.agg(F.avg("skipped")).first()[0]
    assert skipped > 0.5 if k <= 20 else skipped == 0 if k == 5_000 else True


def test_many_queries_go_group_by_group(spark, written):
    corpus, matrix, blocks = written
    queries = asked(spark, matrix[::60])
    assert rows(pruned.nearest_pruned(blocks, queries, 3, max_bytes=500)) == rows(nearest(corpus, queries, 3))


def test_blocks_are_bounded_and_hold_all(written):
    corpus, _, blocks = written
    sizes = blocks.bounds.agg(F.max("n"), F.sum("n")).first()
    assert sizes[0] <= 50 and sizes[1] == corpus.count() == blocks.rows.count()
    assert len(blocks.rows.select("part").distinct().collect()) >= 6


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(0)
    rows, queries, pivots = rng.normal(size=(40, 3)), rng.normal(size=(9, 3)), rng.normal(size=(4, 3))
    far = pruned._to_all(rows, pivots).reshape(8, 5, 4)
    bound = pruned.block_bounds(far.min(axis=1), far.max(axis=1), pruned._to_all(queries, pivots))
    least = pruned._to_all(rows, queries).reshape(8, 5, 9).min(axis=1)
    assert (bound <= least + 1e-12).all() and (bound > 0).any()


def test_edges(spark, tmp_path):
    odd = [("a", None), ("b", [1.0]), ("c", [float("nan"), 0.0]), ("d", [0.0, 1.0]), ("d", [0.0, 1.0]), (None, [3.0, 4.0])]
    centers = spark.createDataFrame([(0, [0.0, 0.0])], "cluster int, embedding array<double>")
    blocks = pruned.write_blocks(spark.createDataFrame(odd, SCHEMA), centers, str(tmp_path / "odd"))
    queries = spark.createDataFrame([(0, "q", [0.0, 0.0]), (1, "r", None)], "query_pos long, query_id string, embedding array<float>")
    found = pruned.nearest_pruned(blocks, queries, 9).collect()
    assert sorted((r.query_pos, r.rank, r.id, r.distance) for r in found) == [(0, 0, "d", 1.0), (0, 1, "d", 1.0), (0, 2, None, 5.0)]
    assert pruned.nearest_pruned(blocks, queries.where("query_pos = 1"), 9).collect() == []
    empty = pruned.write_blocks(spark.createDataFrame([], SCHEMA), centers, str(tmp_path / "empty"))
    assert pruned.nearest_pruned(empty, queries, 9).collect() == []


def test_blocks_within_do_not_list_queries(spark, written):
    """The table of blocks to read has a row a block and a row a query, whatever the number of queries that need a block."""
    _, matrix, blocks = written
    far = pruned._to_all(matrix[::30].astype(float), blocks.pivots)
    wanted, read = pruned._blocks_within(blocks.bounds, far, np.full(len(far), np.inf))
    assert wanted.columns == blocks.bounds.columns and wanted.count() == blocks.bounds.count()
    assert {(row.place, row.n) for row in read.collect()} == {(place, len(matrix)) for place in range(len(far))}


def test_bounds_are_compared_in_steps(monkeypatch):
    monkeypatch.setattr(pruned, "PAIR_CELLS", 100)
    lo, hi, far = np.zeros((37, 2)), np.arange(74.0).reshape(37, 2), np.full((9, 2), 30.0)
    steps = list(pruned._needed(lo, hi, far, np.full(9, 5.0)))
    assert max(needed.size for _, needed in steps) <= 100
    assert (np.concatenate([needed for _, needed in steps]) == (pruned.block_bounds(lo, hi, far) <= 5 * (1 + 1e-9) + 1e-9)).all()
