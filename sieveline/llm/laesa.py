"""Centroid clustering in exact integers, pruned by a stored table of distances to fixed pivots."""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sieveline.functions.vectors import comparable
from sieveline.staging import spread, stage

DIM, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
# Pivots are the farthest of each other among so many vectors drawn by hash; more pivots, tighter bounds, wider table.
PIVOTS, PIVOT_SAMPLE = 12, 512
PAIRS = 200_000
# Square roots are off by less than this share.
MARGIN = 1e-9

TABLE = "vec_id long, v array<int>, pivots array<double>"
CLUSTERED = "vec_id long, cluster int, distance long, n_exact int"
RESULT = f"{CLUSTERED}, cluster_inertia long, inertia long, centroid_sha256 string"


def _matrix(column, width, kind):
    """Arrow lists of `width` numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _integers(column, dim, scale):
    """Arrow lists of `dim` numbers as a matrix of floor(scale * x)."""
    values = np.floor(scale * _matrix(column, dim, np.float64))
    # Beyond this a squared distance may not fit into 63 bits.
    limit = math.sqrt(2.0**62 / dim) / 2
    if np.abs(values).max(initial=0) >= min(limit, 2**31 - 1):
        raise OverflowError("vectors with components too large for 64-bit squared distances")
    return values.astype(np.int64)


def squared(rows, others):
    """Exact squared distances of the pairs (rows[i], others[i])."""
    apart = rows - others
    return np.einsum("ij,ij->i", apart, apart)


def _roots(rows, others):
    """Distances of all rows to all of a few others, from exact squares."""
    return np.sqrt(np.stack([squared(rows, other[None, :]) for other in others], axis=1).astype(np.float64))


def far_apart(sample, n):
    """Up to `n` rows of a sample, each the farthest from those before it."""
    chosen, nearest = [], np.full(len(sample), np.iinfo(np.int64).max)
    while len(chosen) < n and len(sample) and nearest.max() > 0:
        chosen.append(sample[int(nearest.argmax())])
        nearest = np.minimum(nearest, squared(sample, chosen[-1][None, :]))
    return np.array(chosen, np.int64).reshape(len(chosen), -1)


def closest(rows, to_pivots, centroids, centroid_pivots):
    """(number of the nearest centroid, its squared distance, exact distances taken) per row.

    |d(row, pivot) - d(centroid, pivot)| never exceeds d(row, centroid). The
    centroid of least bound is measured first; those whose bound exceeds its
    distance are out, the others are measured exactly. Ties go to the smaller number.
    """
    bound = np.zeros((len(rows), len(centroids)))
    for pivot in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, pivot, None] - centroid_pivots[None, :, pivot]), out=bound)
    first = bound.argmin(axis=1)
    reach = np.sqrt(squared(rows, centroids[first]).astype(np.float64))
    largest = max(to_pivots.max(initial=0), centroid_pivots.max(initial=0))
    alive = bound <= (reach + MARGIN * (1 + largest))[:, None]
    found = np.full(bound.shape, np.iinfo(np.int64).max)
    row, column = np.nonzero(alive)
    for start in range(0, len(row), PAIRS):
        part = slice(start, start + PAIRS)
        found[row[part], column[part]] = squared(rows[row[part]], centroids[column[part]])
    cluster = found.argmin(axis=1)
    return cluster, found[np.arange(len(rows)), cluster], alive.sum(axis=1)


def _drawn(vectors, word, n):
    """The `n` vectors of least sha256 of `word` and id, in that order; equal ids by components, null ids last."""
    by = F.sha2(F.concat(F.lit(f"{word}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(by.asc_nulls_last(), "embedding").limit(n).select("embedding").toArrow()
    return rows.column(0).combine_chunks()


def pivot_table(vectors, pivots, scale=SCALE):
    """Each vector as integers with its distances to the pivots, stored once for all rounds."""

    def run(batches):
        for batch in batches:
            rows = _integers(batch.column(1), pivots.shape[1], scale)
            far = _roots(rows, pivots)
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
            far_ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * far.shape[1])
            ints = pa.ListArray.from_arrays(ends, pa.array(rows.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ints, pa.ListArray.from_arrays(far_ends, pa.array(far.ravel()))], ["vec_id", "v", "pivots"]
            )

    return stage(spread(vectors).mapInArrow(run, TABLE), "pivots")


def _sums(table, centroids, pivots):
    """{cluster: (vectors, component sums)}: one row per cluster and task, added up by Spark."""
    centroid_pivots, dim = _roots(centroids, pivots), centroids.shape[1]

    def run(batches):
        n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            rows, far = _matrix(batch.column(0), dim, np.int64), _matrix(batch.column(1), len(pivots), np.float64)
            cluster, _, _ = closest(rows, far, centroids, centroid_pivots)
            n += np.bincount(cluster, minlength=len(centroids))
            np.add.at(sums, cluster, rows)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(some, pa.int32()), "n": pa.array(n[some]), "sums": pa.array(list(sums[some]), pa.list_(pa.int64()))}
        )

    partial = table.select("v", "pivots").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = (F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dim))
    return {row[0]: (row[1], row[2:]) for row in partial.groupBy("cluster").agg(F.sum("n"), *total).collect()}


def _assigned(table, centroids, pivots):
    centroid_pivots = _roots(centroids, pivots)

    def run(batches):
        for batch in batches:
            rows = _matrix(batch.column(1), centroids.shape[1], np.int64)
            far = _matrix(batch.column(2), len(pivots), np.float64)
            cluster, distance, tried = closest(rows, far, centroids, centroid_pivots)
            arrays = [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(tried, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance", "n_exact"])

    return stage(table.mapInArrow(run, CLUSTERED), "clustered")


def cluster(vectors, k=CENTROIDS, rounds=ROUNDS, dim=DIM, scale=SCALE, n_pivots=PIVOTS, sample=PIVOT_SAMPLE):
    """The nearest of `k` centroids for each vector, after `rounds` updates, all in integers.

    `vectors` has vec_id and embedding; other columns are not read. Kept are
    vectors of `dim` components of which none is null, NaN or infinite. The
    distances to `n_pivots` fixed pivots are stored once; in each round they
    bound the distance to every centroid from below, and only centroids that
    the bound leaves are measured. Centroids and pivots (k and n_pivots of `dim`
    numbers) are all that passes through the driver, besides `sample` vectors
    that pivots are chosen from.

    Returns vec_id, cluster, distance, n_exact (centroids measured in the last
    assignment), cluster_inertia, inertia, centroid_sha256. Repeated rows count
    as often as they occur, and each is returned; a null vec_id is kept but starts a
    centroid only if there are fewer than `k` others. With fewer vectors than
    `k` each starts one; an empty table gives no rows. Components of 2**31 or so
    after scaling, whose squares exceed 64 bits, raise OverflowError.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding").where(comparable("embedding", dim))
    centroids = _integers(_drawn(vectors, "1", k), dim, scale)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    pivots = far_apart(_integers(_drawn(vectors, "pivot", sample), dim, scale), n_pivots)
    table = pivot_table(vectors, pivots, scale)
    for _ in range(rounds):
        for number, (n, sums) in _sums(table, centroids, pivots).items():
            centroids[number] = [total // n for total in sums]
    assigned = _assigned(table, centroids, pivots)
    # One row per centroid.
    inertia = {row[0]: row[1] for row in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}
    digests = [hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest() for centroid in centroids]
    rows = [(number, of, sum(inertia.values()), digests[number]) for number, of in inertia.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(*(part.split()[0] for part in RESULT.split(", ")))
