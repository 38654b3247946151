import collections
import random

import numpy as np
import pytest
from brute import Groups
from pyspark.sql import functions as F

from sieveline.llm import flatgraph


def unit(rng, dim):
    own = rng.normal(size=dim)
    return own / np.linalg.norm(own)


def corpus(seed, dim=32, lone=500, balls=(2, 3, 40, 150), copies=60):
    rng = np.random.default_rng(seed)
    points = [unit(rng, dim) for _ in range(lone)]
    for size in balls:
        center = unit(rng, dim)
        points += [center + 0.02 * rng.normal(size=dim) for _ in range(size)]
    # A chain whose ends are far apart, and equal vectors.
    one, other = unit(rng, dim), unit(rng, dim)
    points += [one + t * (other - one) for t in np.linspace(0, 1, 25)]
    points += [points[0]] * copies
    order = rng.permutation(len(points))
    return {int(n): points[i].astype(np.float32).astype(float).tolist() for n, i in enumerate(order)}


def brute(vectors, cosine=0.95):
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids])
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    close = matrix @ matrix.T >= cosine
    np.fill_diagonal(close, False)
    groups = Groups(ids)
    for a, b in zip(*np.nonzero(close)):
        groups.join(ids[a], ids[b])
    return {i: (int(close[n].sum()), groups.find(i)) for n, i in enumerate(ids)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def found(table):
    return {row.vec_id: (row.n_links, row.component_id) for row in flatgraph.near_vectors(table).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        # Several clusters, cut into several cells, with queries in several blocks.
        monkeypatch.setattr(flatgraph, "SHARD_ROWS", 100)
        monkeypatch.setattr(flatgraph, "CELL_ROWS", 64)
        monkeypatch.setattr(flatgraph, "TASK_QUERIES", 90)
    vectors = corpus(3)
    rows = list(vectors.items())
    random.Random(1).shuffle(rows)
    result, truth = found(frame(spark, rows)), brute(vectors)
    links = sum(n for n, _ in truth.values())
    assert sum(min(result[i][0], truth[i][0]) for i in truth) >= 0.97 * links
    assert all(result[i][0] <= truth[i][0] for i in truth)
    assert sum(result[i][1] == truth[i][1] for i in truth) >= 0.97 * len(truth)
    if not small:
        assert result == truth


@pytest.mark.parametrize("crowded", [False, True])
def test_two_levels_of_centers(spark, monkeypatch, crowded):
    """More centers are wanted than one level has, or those of it fall together as all vectors lean one way."""
    monkeypatch.setattr(flatgraph, "SHARD_ROWS", 10)
    monkeypatch.setattr(flatgraph, "MOST_CENTERS", 400 if crowded else 6)
    monkeypatch.setattr(flatgraph, "CELL_ROWS", 64)
    monkeypatch.setattr(flatgraph, "TASK_QUERIES", 90)
    vectors = corpus(11)
    if crowded:
        lean = unit(np.random.default_rng(4), 32)
        vectors = {i: (np.array(v) / np.linalg.norm(v) + 1.3 * lean).tolist() for i, v in vectors.items()}
    built = []
    real = flatgraph._centers

    def centers(reps):
        built.append(real(reps))
        return built[-1]

    monkeypatch.setattr(flatgraph, "_centers", centers)
    result, truth = found(frame(spark, list(vectors.items()))), brute(vectors)
    (level,) = built
    assert level.fine.count() > 2 * len(level.centers) and level.most >= level.fine.count()
    assert level.fine.groupBy("coarse").count().agg(F.max("count")).first()[0] <= flatgraph.MOST_CENTERS
    links = sum(n for n, _ in truth.values())
    assert sum(min(result[i][0], truth[i][0]) for i in truth) >= 0.97 * links
    assert all(result[i][0] <= truth[i][0] for i in truth)
    assert sum(result[i][1] == truth[i][1] for i in truth) >= 0.97 * len(truth)


def test_rows_of_two_levels(spark):
    """Each row has one place 0, at the nearest fine center of its nearest center; enough probes reach all clusters."""
    rng = np.random.default_rng(8)
    centers = np.array([unit(rng, 8) for _ in range(3)])
    fine = [(coarse, number, unit(rng, 8).tolist()) for coarse, n in ((0, 2), (2, 5)) for number in range(n)]
    table = spark.createDataFrame(fine, "coarse int, number int, vector array<double>")
    points = {i: unit(rng, 8) for i in range(200)}
    rows = spark.createDataFrame([(i, point.tolist()) for i, point in points.items()], "id long, vector array<double>")
    level = flatgraph.Centers(centers, table, 15)
    own = {}
    for row in flatgraph._dealt(rows, level, 2).collect():
        own.setdefault(row.id, []).append((row.place, row.center))
    for i, point in points.items():
        coarse = int(np.argmax(centers @ point))
        scores = [(point @ np.array(v), n) for c, n, v in fine if c == coarse]
        nearest = max(scores)[1] if scores else 0
        assert sorted(own[i])[0] == (0, (coarse << flatgraph.FINE_BITS) + nearest)
        assert [place for place, _ in own[i]].count(0) == 1 and len(set(own[i])) == len(own[i])
    every = {(c << flatgraph.FINE_BITS) + n for c, n, _ in fine} | {1 << flatgraph.FINE_BITS}
    reached = flatgraph._dealt(rows, level, level.most).groupBy("id").agg(F.collect_set("center").alias("all")).collect()
    assert len(reached) == 200 and all(set(row["all"]) == every for row in reached)
    assert flatgraph._dealt(rows.limit(0), level, 2).count() == 0


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, -0.0])]
    rows += [(9, [1.0, 0.0, 0.0]), (10, [1e300, 1e300]), (11, [1e-300, 1e-300]), (12, [1.0, 0.02]), (12, [1.0, 0.02])]
    table = frame(spark, rows).withColumns({name: F.lit(name) for name in ("id", "digest", "mult", "cell")})
    result = sorted(map(tuple, flatgraph.near_vectors(table).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9)] + [(None, 0, None, True)]
    linked = [(7, 3, 7, True), (8, 3, 7, False), (10, 1, 10, True), (11, 1, 10, False), (12, 3, 7, False), (12, 3, 7, False)]
    assert result == sorted(alone + linked, key=repr)
    assert flatgraph.near_vectors(table.limit(0)).count() == 0


def test_one_id_with_two_vectors(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (3, [1.0, 0.01]), (4, [0.01, 1.0])]
    assert {row.component_id for row in flatgraph.near_vectors(frame(spark, rows)).collect()} == {3}


def test_robust_prune():
    point = np.array([1.0, 0.0])
    angles = np.array([0.1, 0.11, -0.1, 0.5, 3.0])
    candidates = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    # The second is much nearer to the first than to the point.
    chosen = flatgraph.robust_prune(point, candidates, 5)
    assert 1 not in chosen and set(chosen[:2]) == {0, 2}
    assert len(flatgraph.robust_prune(point, candidates, 1)) == 1


def test_search_reaches_all_of_a_ball():
    points = np.array(list(corpus(5, copies=0).values()))
    points /= np.linalg.norm(points, axis=1)[:, None]
    links = flatgraph.build(points)
    medoid = int(np.argmax(points @ points.mean(axis=0)))
    hits = total = 0
    for query in points:
        truth = set(np.nonzero(points @ query >= 0.95)[0])
        got = set(flatgraph.search(query, points, links, medoid))
        assert got <= truth
        hits, total = hits + len(got), total + len(truth)
    assert hits >= 0.97 * total


def test_audit_counts_links_by_brute_force(spark):
    vectors = corpus(4, lone=60, balls=(30,), copies=0)
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors.items()}
    reps = spark.createDataFrame([(i, v.tolist(), 1) for i, v in units.items()], "id long, vector array<double>, mult long")
    truth = brute(vectors)
    full = spark.createDataFrame([(i, n) for i, (n, _) in truth.items()], "id long, links long")
    links = sum(n for n, _ in truth.values())
    assert flatgraph.audit(reps, full, 32, queries=1000) == (links, links)
    assert flatgraph.audit(reps, full.limit(0), 32, queries=1000) == (0, links)
    assert collections.Counter(n for n, _ in truth.values())[0] > 0


def test_linked_sample_draws_from_every_class(spark):
    vectors = corpus(6, lone=900, balls=(2, 2, 40), copies=0)
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors.items()}
    truth = {i: n for i, (n, _) in brute(vectors).items() if n}
    reps = spark.createDataFrame([(i, v.tolist(), 1) for i, v in units.items()], "id long, vector array<double>, mult long")
    # Half of the links of each were found; the sample knows all.
    found = spark.createDataFrame([(i, 0, -(-n // 2), 0) for i, n in truth.items()], "id long, links long, nodes long, root long")
    some = flatgraph.linked_sample(reps, found, 32, most=4)
    assert some.items() <= truth.items() and len(some) <= 4 * 6 and {1, 39} <= set(some.values())
    assert flatgraph.linked_sample(reps, found.limit(0), 32) == {}


def test_planted_copies_are_within_the_range(spark):
    rng = np.random.default_rng(3)
    points = np.array([unit(rng, 16) for _ in range(300)])
    made = flatgraph.turned(points, 0.95)
    cosines = (points * made).sum(axis=1)
    assert (cosines >= 0.95).all() and cosines.min() < 0.955 and cosines.max() < 0.98
    reps = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(points)], "id long, vector array<double>, mult long")
    copies, n = flatgraph.planted(reps, 16, 0.95, 100)
    assert n == 100 and {row.target for row in copies.collect()} <= set(range(300))
    # One number has no direction to be turned in.
    assert np.allclose(flatgraph.turned(np.array([[1.0], [-1.0]]), 0.95), [[1.0], [-1.0]])


def test_a_table_without_links_is_audited(spark, monkeypatch):
    scans = []
    there = flatgraph._there
    monkeypatch.setattr(flatgraph, "_there", lambda *a: scans.append(1) or there(*a))
    monkeypatch.setattr(flatgraph, "SHARD_ROWS", 100)
    vectors = corpus(8, lone=700, balls=(), copies=0)
    rows = flatgraph.near_vectors(frame(spark, list(vectors.items()))).collect()
    assert rows[0].audited_recall >= 0.95 and len(scans) <= 2


def test_a_hot_group_does_not_hide_missed_pairs(spark):
    there = {1: 1, 2: 1} | {i: 500 for i in range(10, 60)}
    found = spark.createDataFrame([(i, 9_000, 500, 10) for i in range(10, 60)], "id long, links long, nodes long, root long")
    pairs = flatgraph.recalls(there, found)
    assert sum(own for _, own in pairs) / len(pairs) > 0.95
    assert flatgraph.least_mean(pairs) == 0
    assert flatgraph.least_mean(flatgraph.recalls({}, found)) == 1


def test_search_goes_on_when_all_cells_are_probed(spark, monkeypatch):
    # One center, so all cells are probed at once; what is searched before the last turn finds nothing.
    search, beams = flatgraph._found, []

    def blind(members, graph, queries, beam, cosine):
        beams.append(beam)
        found = search(members, graph, queries, beam, cosine)
        return found if beam >= 1_024 else found.limit(0)

    monkeypatch.setattr(flatgraph, "_found", blind)
    monkeypatch.setattr(flatgraph, "BEAM", 512)
    monkeypatch.setattr(flatgraph, "CELL_ROWS", 1_000)
    vectors = corpus(7, lone=100, balls=(2, 2, 30), copies=3)
    rows = flatgraph.near_vectors(frame(spark, list(vectors.items()))).collect()
    # The planted queries twice, then all once.
    assert len(beams) == 3 and rows[0].audited_recall == 1
    assert {row.vec_id: (row.n_links, row.component_id) for row in rows} == brute(vectors)


def test_a_beam_of_all_rows_compares_all():
    points = np.array(list(corpus(5, copies=0).values()))
    points /= np.linalg.norm(points, axis=1)[:, None]
    links = [np.empty(0, np.int64)] * len(points)
    for query in points[:50]:
        truth = set(np.nonzero(points @ query >= 0.95)[0])
        assert set(flatgraph.search(query, points, links, 0, flatgraph.WHOLE)) == truth
