"""Approximate neighbours through a cluster-partitioned table of vectors."""

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline import settings
from sieveline.functions.vectors import as_matrix, comparable, exact_distances
from sieveline.operators.neighbors import (
    BATCH_ROWS,
    _chunks,
    _empty,
    _hits_table,
    _match_blocks,
    _partial_schema,
    by_groups,
    merge_hits,
    query_head,
)
from sieveline.staging import few_tasks, stage


def fit_centers(corpus, n_clusters, seed=settings.RERANK_SEED, vector_col="embedding", fraction=1.0):
    """Centers (cluster, embedding) of a k-means model of the vectors.

    For a large corpus a `fraction` of the rows is enough to place the
    centers; every row is then assigned to one of them. Vectors that cannot
    be compared with the first one take no part.
    """
    first = corpus.filter(F.size(vector_col) > 0).select(F.size(vector_col)).first()
    rows = corpus.filter(comparable(vector_col, first[0] if first else 0))
    rows = rows.select(array_to_vector(vector_col).alias("features"))
    rows = rows.sample(fraction, seed) if fraction < 1.0 else rows
    model = KMeans(k=n_clusters, seed=seed, featuresCol="features").fit(rows)
    centers = [(n, [float(x) for x in center]) for n, center in enumerate(model.clusterCenters())]
    return corpus.sparkSession.createDataFrame(centers, "cluster int, embedding array<double>")


def _held(centers, max_bytes):
    """Numbers and matrix of a table of centers, which has to fit `max_bytes`."""
    cluster = F.col("cluster")
    named = centers.select(cluster.cast("long").alias("query_pos"), cluster.cast("string").alias("query_id"), "embedding")
    dim, head = query_head(named, "embedding", settings.TASK_HITS, max_bytes)
    if head is None:
        raise ValueError("no centers" if not dim else f"centers of more than {max_bytes} bytes")
    head = head.sort_by("query_pos")
    return head["query_pos"].to_numpy(), as_matrix(head["embedding"].combine_chunks())


def _closest(vectors, centers, n):
    """Places of the `n` closest centers per vector, the first one on a tie."""
    n = min(n, len(centers))
    row, col = np.divmod(np.arange(len(vectors) * len(centers)), len(centers))
    gaps = exact_distances(vectors, row, centers, col, "euclidean").reshape(len(vectors), len(centers))
    return np.argsort(gaps, axis=1, kind="stable")[:, :n]


def assign(rows, centers, n=1, vector_col="embedding", max_bytes=settings.QUERY_VECTOR_BYTES):
    """`rows` with the column `cluster`, once for each of their `n` closest centers.

    `centers` has cluster and embedding and fits `max_bytes`. Rows that cannot
    be compared with the centers are left out.
    """
    names, matrix = _held(centers, max_bytes)
    shared = rows.sparkSession.sparkContext.broadcast((names, matrix))
    rows = rows.filter(comparable(vector_col, matrix.shape[1]))
    place = rows.columns.index(vector_col)

    def run(batches):
        names, matrix = shared.value
        for batch in batches:
            vectors = as_matrix(batch.column(place))
            step = max(1, 4_000_000 // matrix.size)
            found = [_closest(vectors[at : at + step], matrix, n) for at in range(0, len(vectors), step)]
            found = np.concatenate(found) if found else np.empty((0, min(n, len(matrix))), np.int64)
            repeated = pa.array(np.repeat(np.arange(len(batch)), found.shape[1]))
            columns = [column.take(repeated) for column in batch.columns]
            columns.append(pa.array(names[found.ravel()].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "cluster"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cluster", T.IntegerType())]))


def write_clusters(corpus, centers, path, vector_col="embedding"):
    """Write the corpus partitioned by its cluster; large clusters are split."""
    placed = assign(corpus, centers, vector_col=vector_col)
    placed.hint("rebalance", "cluster").write.partitionBy("cluster").parquet(path)
    return corpus.sparkSession.read.parquet(path)


def nearest_in_clusters(
    clustered,
    centers,
    queries,
    k,
    nprobe,
    metric="euclidean",
    vector_col="embedding",
    max_hits=settings.TASK_HITS,
    max_bytes=settings.QUERY_VECTOR_BYTES,
):
    """The k nearest rows per query within its `nprobe` closest clusters.

    `centers` is the table the corpus was written by. Only clusters that some
    query probes are read. With all clusters probed the result is exact. A
    query set within the bounds is broadcast; a larger one is matched with its
    clusters block by block. Queries without a vector have no hits.
    """
    dim, head = query_head(queries, vector_col, max(1, max_hits // k), max_bytes)
    if not dim:
        return _empty(clustered, "id")
    rows = clustered.filter(comparable(vector_col, dim))
    rows = rows.select("id", F.col(vector_col).alias("embedding"), F.col("cluster").cast("int").alias("cluster"))
    if head is None:
        queries = queries.filter(F.col(vector_col).isNotNull())
        partial, names, parts = _probe_blocks(rows, centers, queries, k, nprobe, metric, vector_col)
    else:
        partial, names, parts = _probe_in_place(rows, centers, head, k, nprobe, metric, vector_col)
    hits = merge_hits(partial, k, parts, F.col("query_pos"))
    return hits.join(names, "query_pos").select("query_pos", "query_id", "rank", "id", "distance")


def _probe_in_place(rows, centers, head, k, nprobe, metric, vector_col):
    spark = rows.sparkSession
    positions = head["query_pos"].to_numpy().astype(np.int64)
    vectors = as_matrix(head[vector_col].combine_chunks())
    numbers, matrix = _held(centers, settings.QUERY_VECTOR_BYTES)
    probed = numbers[_closest(vectors, matrix, nprobe)]
    by_cluster = {int(c): np.nonzero((probed == c).any(axis=1))[0] for c in np.unique(probed)}
    shared = spark.sparkContext.broadcast((positions, vectors, by_cluster))

    def add(best, chunk, start, stop):
        ids, matrix, cuts = chunk
        for cluster, first, end in cuts:
            asked = shared.value[2][cluster]
            asked = asked[np.searchsorted(asked, start) : np.searchsorted(asked, stop)] - start
            if len(asked):
                best.add(ids.slice(first, end - first), matrix[first:end], asked)

    def by_cluster_of(chunk):
        found = chunk["cluster"].to_numpy()
        order = np.argsort(found, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(found[order]) != 0])
        cuts = [(int(found[order[a]]), a, b) for a, b in zip(cuts, np.r_[cuts[1:], len(order)])]
        return chunk["id"].chunk(0).take(pa.array(order)), as_matrix(chunk["embedding"].chunk(0))[order], cuts

    def search(batches):
        positions, vectors, _ = shared.value
        chunks = map(by_cluster_of, _chunks(batches, vectors.shape[1]))
        for start, found in by_groups(vectors, k, metric, chunks, add):
            yield from _hits_table(positions[start:], found).to_batches(max_chunksize=BATCH_ROWS)

    rows, tasks = few_tasks(rows.filter(F.col("cluster").isin(list(by_cluster))))
    names = spark.createDataFrame(
        head.select(["query_pos", "query_id"]).to_pandas(), "query_pos long, query_id string"
    )
    return rows.mapInArrow(search, _partial_schema(rows)), F.broadcast(names), tasks


def _probe_blocks(rows, centers, queries, k, nprobe, metric, vector_col):
    """Each block of a cluster's queries with each block of its rows is one group."""
    asked = queries.select("query_pos", F.col(vector_col).alias("embedding"))
    asked = stage(assign(asked, centers, nprobe), "asked")
    block_queries = max(1, min(settings.BLOCK_QUERIES, settings.TASK_HITS // k))
    held = rows.groupBy("cluster").agg(F.ceil(F.count("*") / settings.BLOCK_VECTORS).cast("int").alias("row_blocks"))
    wanted = asked.groupBy("cluster").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("query_blocks"))
    # One row per cluster, no more than there are centers.
    blocks = F.broadcast(stage(held.join(wanted, "cluster"), "blocks"))
    number = lambda name, n: F.pmod(F.xxhash64(name), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    reach = F.lit(float("inf")).alias("reach")
    left = asked.join(blocks, "cluster").select(
        "cluster", "query_pos", "embedding", reach,
        number("query_pos", "query_blocks").alias("query_block"), every("row_blocks").alias("row_block"),
    )
    right = rows.join(blocks, "cluster").select(
        "cluster", "id", "embedding", number("id", "row_blocks").alias("row_block"), every("query_blocks").alias("query_block")
    )
    most = blocks.agg(F.max("row_blocks")).first()[0] or 1
    found = _match_blocks(left, right, k, metric, keys=("cluster", "query_block", "row_block"))
    return found, queries.select("query_pos", "query_id"), math.ceil(most) * nprobe


def recall_report(found, exact):
    """Share of the exact hits found, per query."""
    marks = found.select("query_pos", "id", F.lit(1).alias("_found"))
    return (
        exact.select("query_pos", "id")
        .join(marks, ["query_pos", "id"], "left")
        .groupBy("query_pos")
        .agg(F.count("*").alias("n_exact"), F.count("_found").alias("n_found"))
        .withColumn("recall", F.col("n_found") / F.col("n_exact"))
    )
