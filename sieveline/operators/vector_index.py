"""A cluster index of vectors that lives: two levels of centers, appended versions and deletes, probes by measured recall."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline import settings
from sieveline.functions.vectors import as_matrix, comparable
from sieveline.operators.clusters import _closest, _held, assign, fit_centers, nearest_in_clusters
from sieveline.operators.neighbors import nearest
from sieveline.staging import fits, small, spread, stage

CENTERS = "coarse int, cluster int, embedding array<double>"
# A coarse cell's fine centers are fitted on at most so many of its vectors for each of them.
ROWS_PER_CENTER, LLOYD_ROUNDS = 64, 10
# Vectors that the number of probes is measured on.
AUDITED = 256


def _lloyd(rows, k):
    """Up to `k` centers of a few vectors: distinct rows spread along the input, moved to the means of their own."""
    distinct = np.unique(rows, axis=0)
    centers = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(np.int64)]
    for _ in range(LLOYD_ROUNDS):
        own = _closest(rows, centers, 1)[:, 0]
        sums, counts = np.zeros_like(centers), np.bincount(own, minlength=len(centers))
        np.add.at(sums, own, rows)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
        if np.array_equal(moved, centers):
            break
        centers = moved
    return centers


def fit_two_levels(corpus, n_coarse, n_fine, id_col="id", vector_col="embedding", fraction=1.0):
    """Centers (coarse, cluster, embedding): up to `n_fine` in each of `n_coarse` cells.

    The coarse ones are those of a k-means model of a `fraction` of the rows. Each
    cell's fine ones are fitted in one task, on at most ROWS_PER_CENTER
    vectors for each, drawn by hash of the id; so neither the number of clusters
    nor the size of a cell is bounded by one task.
    """
    coarse = stage(fit_centers(corpus, n_coarse, vector_col=vector_col, fraction=fraction), "coarse")
    rows = corpus.select(F.col(id_col).cast("string").alias("id"), F.col(vector_col).alias("embedding"))
    placed = assign(rows, coarse).withColumnRenamed("cluster", "coarse")
    most = n_fine * ROWS_PER_CENTER
    drawn = Window.partitionBy("coarse").orderBy(F.xxhash64("id"), "id")
    drawn = placed.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= most)

    def run(group):
        group = group.sort_by("n").combine_chunks()
        centers = _lloyd(as_matrix(group["embedding"].chunk(0)), n_fine)
        coarse = group["coarse"][0].as_py()
        rows = [(coarse, coarse * n_fine + i, center.tolist()) for i, center in enumerate(centers)]
        columns = zip(*rows)
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.float64()))
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["coarse", "cluster", "embedding"])

    return drawn.select("coarse", "n", "embedding").groupBy("coarse").applyInArrow(run, CENTERS)


def assign_two_levels(rows, centers, vector_col="embedding", max_bytes=settings.QUERY_VECTOR_BYTES):
    """`rows` with `cluster`: the closest center of the cell whose mean of centers is closest.

    A vector is compared with one vector a cell and the centers of one cell, not
    with all centers. Rows that cannot be compared are left out.
    """
    cells, means, groups = _levels(centers, max_bytes)
    shared = rows.sparkSession.sparkContext.broadcast((means, groups))
    place = rows.columns.index(vector_col)
    rows = rows.filter(comparable(vector_col, means.shape[1]))

    def run(batches):
        means, groups = shared.value
        for batch in batches:
            vectors = as_matrix(batch.column(place))
            step = max(1, 4_000_000 // means.size)
            cell = [_closest(vectors[at : at + step], means, 1)[:, 0] for at in range(0, len(vectors), step)]
            cell = np.concatenate(cell) if cell else np.empty(0, np.int64)
            found = np.empty(len(vectors), np.int32)
            for one in np.unique(cell):
                numbers, matrix = groups[one]
                at = np.flatnonzero(cell == one)
                for start in range(0, len(at), max(1, 4_000_000 // matrix.size)):
                    some = at[start : start + max(1, 4_000_000 // matrix.size)]
                    found[some] = numbers[_closest(vectors[some], matrix, 1)[:, 0]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "cluster"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cluster", T.IntegerType())]))


def _levels(centers, max_bytes):
    """Cells, the mean of each one's centers, and its (numbers, centers)."""
    numbers, matrix = _held(centers, max_bytes)
    coarse = dict(centers.select("cluster", "coarse").toArrow().to_pandas().itertuples(index=False))
    cell_of = np.array([coarse[number] for number in numbers.tolist()])
    cells = np.unique(cell_of)
    groups = [(numbers[cell_of == cell].astype(np.int32), matrix[cell_of == cell]) for cell in cells]
    return cells, np.stack([matrix.mean(axis=0) for _, matrix in groups]), groups


class VectorIndex:
    """Vectors below `path`, in one folder per version and cluster, and the ids that later versions changed.

    An insert appends a version of some ids, a delete appends their ids alone;
    nothing written before is touched. Reading leaves out what a later version
    replaced or deleted. `compact` writes what is left as one version anew.
    """

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.centers = spark.read.parquet(f"{path}/centers")
        self.schema = spark.read.parquet(f"{path}/schema").schema

    def _rows(self):
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def _changes(self):
        return self.spark.read.schema(self._change_schema()).parquet(f"{self.path}/changes")

    def _change_schema(self):
        return T.StructType([self.schema["id"], T.StructField("version", T.LongType()), T.StructField("gone", T.BooleanType())])

    def insert(self, vectors, version, id_col="id", vector_col="embedding", first=False):
        """Append `vectors` as `version`, later than all before; of repeated ids one row stays, the greatest vector.

        Rows without an id, or that cannot be compared with the centers, are left
        out; `split_valid` reports them. An id whose new vector is left out keeps its old one.
        """
        if not first:
            self._check(version)
        rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding")).where("id IS NOT NULL")
        placed = stage(assign_two_levels(rows, self.centers), "placed")
        placed = placed.groupBy("id").agg(F.max(F.struct("embedding", "cluster")).alias("row")).select("id", "row.*")
        placed = placed.withColumn("version", F.lit(version).cast("long")).select("id", "embedding", "version", "cluster")
        placed.hint("rebalance", "cluster").write.mode("append").partitionBy("version", "cluster").parquet(f"{self.path}/rows")
        if not first:
            written = self._rows().where(F.col("version") == version).select("id", "version", F.lit(False).alias("gone"))
            written.write.mode("append").parquet(f"{self.path}/changes")
        return self

    def delete(self, ids, version, id_col="id"):
        """Append that `ids` are gone as of `version`; ids that are not held do no harm."""
        self._check(version)
        ids = ids.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
        gone = ids.select("id", F.lit(version).cast("long").alias("version"), F.lit(True).alias("gone"))
        gone.write.mode("append").parquet(f"{self.path}/changes")
        return self

    def _check(self, version):
        last = self._changes().agg(F.max("version").alias("version")).first().version or 0
        if version <= last:
            raise ValueError(f"version {version} is not later than {last}")

    def vectors(self):
        """The vectors that stand (id, embedding, cluster).

        A filter on the cluster reaches the folders. Ids changed since the last
        compaction are broadcast if they are few, else joined.
        """
        last = self._changes().groupBy("id").agg(F.max(F.struct("version", "gone")).alias("last")).select("id", "last.*")
        last = stage(last.select("id", F.col("version").alias("_version"), "gone"), "changes")
        rows = self._rows().join(F.broadcast(last) if fits(last) else last, "id", "left")
        stands = F.col("_version").isNull() | (F.col("version") > F.col("_version")) | ((F.col("version") == F.col("_version")) & ~F.col("gone"))
        return rows.where(stands).select("id", "embedding", F.col("cluster").cast("int").alias("cluster"))

    def search(self, queries, k, nprobe, **options):
        """The k nearest vectors per query within its `nprobe` closest clusters."""
        return nearest_in_clusters(self.vectors(), self.centers.select("cluster", "embedding"), queries, k, nprobe, **options)

    def probes_for(self, k, target=0.9, queries=None, audited=AUDITED):
        """(least number of probes whose mean recall over an audit reaches `target`, that recall).

        Audited are `queries`, or up to `audited` vectors of the index drawn by hash. One exact search gives
        their k nearest with the clusters these lie in; a hit is found by as
        many probes as its cluster is among the closest. At all clusters the recall is 1.
        """
        rows = stage(self.vectors(), "standing")
        if queries is None:
            drawn = rows.orderBy(F.xxhash64("id"), "id").limit(audited).select("id", "embedding")
            queries = drawn.select(F.xxhash64("id").alias("query_pos"), F.col("id").cast("string").alias("query_id"), "embedding")
        queries = stage(queries.where("embedding IS NOT NULL"), "audit")
        hits = stage(nearest(rows, queries, k).select("query_pos", "id"), "exact")
        numbers, _ = _held(self.centers, settings.QUERY_VECTOR_BYTES)
        order = _cluster_places(queries, self.centers)
        ids = small(hits.select("id").distinct())
        held = rows.select("id", "cluster").join(ids, "id", "left_semi")
        needed = hits.join(held, "id").join(small(order), ["query_pos", "cluster"])
        found = needed.groupBy("query_pos", "place").agg(F.count("*").alias("n"))
        whole = Window.partitionBy("query_pos")
        share = found.withColumn("share", F.col("n") / F.sum("n").over(whole)).groupBy("place").agg(F.sum("share").alias("share"))
        # One row per number of probes.
        share = {row.place: row.share for row in share.toLocalIterator()}
        total, reached = sum(share.values()), 0.0
        for place in sorted(share):
            reached += share[place]
            if reached >= target * total - 1e-9:
                return place, reached / total
        return len(numbers), 1.0

    def compact(self, path):
        """Write the vectors that stand as a new index of one version below `path`, under the same centers."""
        standing = self.vectors()
        self.centers.coalesce(1).write.parquet(f"{path}/centers")
        fresh = _start(self.spark, path, self.schema)
        rows = standing.select("id", "embedding", F.lit(0).cast("long").alias("version"), "cluster")
        rows.hint("rebalance", "cluster").write.partitionBy("version", "cluster").parquet(f"{path}/rows")
        return fresh


def _cluster_places(queries, centers):
    """(query_pos, cluster, place from 1): clusters by closeness of their centers, the first one on a tie."""
    numbers, matrix = _held(centers, settings.QUERY_VECTOR_BYTES)
    shared = queries.sparkSession.sparkContext.broadcast((numbers, matrix))

    def run(batches):
        numbers, matrix = shared.value
        for batch in batches:
            for start in range(batch.num_rows):
                row = batch.slice(start, 1)
                order = numbers[_closest(as_matrix(row.column(1)), matrix, len(matrix))[0]]
                columns = [pa.array([row.column(0)[0].as_py()] * len(order), pa.int64()), pa.array(order, pa.int32())]
                columns.append(pa.array(np.arange(1, len(order) + 1, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays(columns, ["query_pos", "cluster", "place"])

    return stage(queries.select("query_pos", "embedding").mapInArrow(run, "query_pos long, cluster int, place int"), "places")


def _start(spark, path, schema):
    spark.createDataFrame([], schema).write.parquet(f"{path}/schema")
    index = VectorIndex(spark, path)
    spark.createDataFrame([], index._change_schema()).write.parquet(f"{path}/changes")
    return index


def create_vector_index(corpus, centers, path, id_col="id", vector_col="embedding"):
    """Write `corpus` as version 0 of a new index below `path` by two levels of `centers` (coarse, cluster, embedding)."""
    spark = corpus.sparkSession
    centers.select("coarse", "cluster", F.col("embedding").cast("array<double>").alias("embedding")).coalesce(1).write.parquet(
        f"{path}/centers"
    )
    kinds = [T.StructField("id", corpus.schema[id_col].dataType), T.StructField("embedding", corpus.schema[vector_col].dataType)]
    kinds += [T.StructField("version", T.LongType()), T.StructField("cluster", T.IntegerType())]
    index = _start(spark, path, T.StructType(kinds))
    return index.insert(spread(corpus), 0, id_col, vector_col, first=True)
