"""Exact neighbours over a table of blocks that triangle bounds can leave out.

Distances to a few fixed pivots are stored with every vector. Vectors of one
cell (that of their closest center), in the order of their distance from it, are cut into blocks;
a block keeps the least and the greatest distance to each pivot. A vector
differs from a query by at least what their distances to any pivot differ by,
so a block whose bound exceeds the query's k-th distance is not read for it.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sieveline import settings
from sieveline.functions.vectors import PAIR_CELLS, as_matrix, comparable, exact_distances
from sieveline.operators.clusters import _held
from sieveline.operators.neighbors import BATCH_ROWS, _chunks, _empty, _hits_table, _partial_schema, by_groups, merge_hits, query_head
from sieveline.staging import number_rows, stage

# Bounds are off by rounding less than this share.
MARGIN = 1e-9


def _to_all(vectors, others):
    """Euclidean distances of all vectors to all of a few others."""
    row, col = np.divmod(np.arange(len(vectors) * len(others)), len(others))
    return exact_distances(vectors, row, others, col, "euclidean").reshape(len(vectors), len(others))


def _with_pivots(rows, centers, n_pivots):
    """`rows` (id, embedding) with the place of the closest center, the distance to it and those to the pivots.

    The first `n_pivots` centers are the pivots.
    """
    shared = rows.sparkSession.sparkContext.broadcast(centers)

    def run(batches):
        centers = shared.value
        for batch in batches:
            step, found = max(1, 4_000_000 // centers.size), []
            vectors = as_matrix(batch.column(1))
            for at in range(0, len(vectors), step):
                found.append(_to_all(vectors[at : at + step], centers))
            far = np.concatenate(found) if found else np.empty((0, len(centers)))
            cell = far.argmin(axis=1) if len(far) else np.empty(0, np.int64)
            gaps = far[:, :n_pivots]
            ends = pa.array(np.arange(len(gaps) + 1, dtype=np.int32) * gaps.shape[1])
            columns = [pa.array(cell, pa.int32()), pa.array(far[np.arange(len(far)), cell])]
            columns.append(pa.ListArray.from_arrays(ends, pa.array(gaps.ravel())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "cell", "gap", "gaps"])

    added = T._parse_datatype_string("cell int, gap double, gaps array<double>").fields
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))


class Blocks:
    """A written table of blocks: `rows` (id, embedding, part, run, cell), `bounds` (a row per block), centers and pivots."""

    def __init__(self, spark, path):
        self.path = path
        # Folders of no rows hold no schema; it lies beside them.
        self.rows = spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")
        self.bounds = spark.read.parquet(f"{path}/bounds")
        pivots = spark.read.parquet(f"{path}/pivots").orderBy("pivot").toArrow()
        self.pivots = as_matrix(pivots["embedding"].combine_chunks())
        self.dim = self.pivots.shape[1]


def write_blocks(
    corpus,
    centers,
    path,
    block_rows=settings.BLOCK_VECTORS,
    n_pivots=settings.PIVOTS,
    part_rows=settings.PART_VECTORS,
    id_col="id",
    vector_col="embedding",
):
    """Write `corpus` as blocks of at most `block_rows` vectors below `path`, and read them back.

    `centers` (cluster, embedding) fits the driver and is checked to. Any
    number of vectors may be closest to one center: blocks are runs of one
    global order by cell, distance and id, so a hot cell is many blocks. Rows
    that cannot be compared with the centers are left out. Rows lie in folders
    of about `part_rows`, so a search opens only those that hold a block it needs.
    """
    spark = corpus.sparkSession
    _, matrix = _held(centers, settings.QUERY_VECTOR_BYTES)
    rows = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    placed = stage(_with_pivots(rows.filter(comparable("embedding", matrix.shape[1])), matrix, n_pivots), "placed")
    # Only the keys are numbered; vectors and distances meet their number by one join.
    keys = placed.select("cell", "gap", "id").distinct()
    numbered = number_rows(keys, "number", "cell", "gap", "id")
    run = F.floor(F.col("number") / F.lit(block_rows)).cast("long")
    numbered = numbered.select(F.col("id").alias("_id"), F.col("cell").alias("_cell"), F.col("gap").alias("_gap"), run.alias("run"))
    same = (F.col("id").eqNullSafe(F.col("_id"))) & (F.col("cell") == F.col("_cell")) & (F.col("gap") == F.col("_gap"))
    cut = placed.join(numbered, same)
    part = F.floor(F.col("run") * F.lit(block_rows) / F.lit(max(block_rows, part_rows))).cast("long")
    cut = cut.withColumn("part", part).select("id", "embedding", "gaps", "cell", "run", "part")
    cut.hint("rebalance", "part").sortWithinPartitions("part", "cell", "run").write.partitionBy("part").parquet(f"{path}/rows")
    spark.createDataFrame([], cut.schema).write.parquet(f"{path}/schema")
    held = spark.read.schema(cut.schema).parquet(f"{path}/rows")
    places = range(min(n_pivots, len(matrix)))
    ends = [kind(F.col("gaps")[n]).alias(f"{name}{n}") for n in places for kind, name in ((F.min, "lo"), (F.max, "hi"))]
    bounds = held.groupBy("part", "cell", "run").agg(F.count("*").alias("n"), *ends)
    bounds = bounds.select(
        F.col("part").cast("long"), "cell", "run", "n",
        *(F.array(*(F.col(f"{name}{n}") for n in places)).alias(name) for name in ("lo", "hi")),
    )
    bounds.write.parquet(f"{path}/bounds")
    pivots = [(n, matrix[n].tolist()) for n in places]
    spark.createDataFrame(pivots, "pivot int, embedding array<double>").coalesce(1).write.parquet(f"{path}/pivots")
    return Blocks(spark, path)


def block_bounds(lo, hi, to_pivots):
    """Least distance (blocks x queries) that the intervals of each block allow."""
    bound = np.zeros((len(lo), len(to_pivots)))
    for pivot in range(lo.shape[1]):
        far = to_pivots[None, :, pivot]
        np.maximum(bound, lo[:, pivot, None] - far, out=bound)
        np.maximum(bound, far - hi[:, pivot, None], out=bound)
    return bound


BOUNDED = "place int, part long, cell int, run long, n long, bound double"


def _dealt(bounds):
    """The blocks over all cores: their table is small, but every query is compared with every block."""
    return bounds.repartition(bounds.sparkSession.sparkContext.defaultParallelism)


def _nearest_blocks(bounds, to_pivots, k):
    """Per query the blocks of least bound that hold `k` vectors together: (place, part, cell, run, n, bound)."""
    shared = bounds.sparkSession.sparkContext.broadcast(to_pivots)

    def run(batches):
        to_pivots = shared.value
        for chunk in _chunks(batches, 2 * to_pivots.shape[1]):
            chunk = chunk.sort_by([("cell", "ascending"), ("run", "ascending")]).combine_chunks()
            n, lo, hi = chunk["n"].to_numpy(), as_matrix(chunk["lo"].chunk(0)), as_matrix(chunk["hi"].chunk(0))
            step, most = max(1, PAIR_CELLS // len(n)), min(k, len(n))
            for start in range(0, len(to_pivots), step):
                bound = np.ascontiguousarray(block_bounds(lo, hi, to_pivots[start : start + step]).T)
                # No block is empty, so k of the least bounds are enough.
                last = np.partition(bound, most - 1, axis=1)[:, most - 1 : most]
                place, block = np.nonzero(bound <= last)
                bound = bound[place, block]
                order = np.lexsort((block, bound, place))
                place, block, bound = place[order], block[order], bound[order]
                before = np.cumsum(n[block]) - n[block]
                near = before - before[np.searchsorted(place, place)] < k
                blocks = chunk.select(["part", "cell", "run", "n"]).take(pa.array(block[near])).combine_chunks()
                columns = [pa.array((start + place[near]).astype(np.int32)), *(c.chunk(0) for c in blocks.columns), pa.array(bound[near])]
                yield pa.RecordBatch.from_arrays(columns, ["place", "part", "cell", "run", "n", "bound"])

    found = _dealt(bounds.select("part", "cell", "run", "n", "lo", "hi")).mapInArrow(run, BOUNDED)
    order = Window.partitionBy("place").orderBy("bound", "cell", "run")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumn("_before", before).where(F.col("_before") < k).drop("_before")


def _needed(lo, hi, to_pivots, reach):
    """(first block, blocks x queries) in steps: True where the bounds do not leave a block out for a query."""
    step = max(1, PAIR_CELLS // len(to_pivots))
    for at in range(0, len(lo), step):
        yield at, block_bounds(lo[at : at + step], hi[at : at + step], to_pivots) <= reach * (1 + MARGIN) + MARGIN


def _blocks_within(bounds, to_pivots, reach):
    """Blocks that the bounds do not leave out for every query, as rows of `bounds`, and (place, n): vectors in those of a query.

    Which query needs which block is not listed, as that grows with blocks times queries; the search finds it anew.
    """
    shared = bounds.sparkSession.sparkContext.broadcast((to_pivots, reach))
    schema = T.StructType([T.StructField("place", T.IntegerType()), *bounds.schema.fields])
    names = bounds.columns

    def run(batches):
        to_pivots, reach = shared.value
        read = np.zeros(len(to_pivots), np.int64)
        for batch in batches:
            n, wanted = batch["n"].to_numpy(), np.zeros(batch.num_rows, bool)
            for at, needed in _needed(as_matrix(batch["lo"]), as_matrix(batch["hi"]), to_pivots, reach):
                some = slice(at, at + len(needed))
                wanted[some] = needed.any(axis=1)
                read += np.where(needed, n[some, None], 0).sum(axis=0)
            kept = batch.filter(pa.array(wanted))
            yield pa.RecordBatch.from_arrays([pa.nulls(kept.num_rows, pa.int32()), *kept.columns], ["place", *names])
        place = np.flatnonzero(read).astype(np.int32)
        columns = [pa.array(read[place]) if name == "n" else pa.nulls(len(place), kind) for name, kind in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(place), *columns], ["place", *names])

    kinds = [(field.name, field.type) for field in to_arrow_schema(bounds.schema)]
    found = stage(_dealt(bounds).mapInArrow(run, schema), "wanted")
    read = found.where("place IS NOT NULL").groupBy("place").agg(F.sum("n").alias("n"))
    return found.where("place IS NULL").drop("place"), read


def _search(blocks, wanted, positions, vectors, k, reach, to_pivots=None):
    """The k nearest rows per query and task of the blocks in `wanted`.

    A block has `places` of the queries that need it, or else `lo` and `hi`, by which those within `reach` need it.
    """
    spark = wanted.sparkSession
    shared = spark.sparkContext.broadcast((positions, vectors, reach, to_pivots))
    parts = [row.part for row in wanted.select("part").distinct().toLocalIterator()]
    rows = blocks.rows.where(F.col("part").isin(parts)) if parts else blocks.rows.limit(0)
    schema = _partial_schema(rows)
    listed = "places" in wanted.columns
    needs = ["places"] if listed else ["lo", "hi"]
    rows = rows.select("id", "embedding", "cell", "run").join(wanted.select("cell", "run", *needs), ["cell", "run"])
    # Blocks lie in few files, and each is compared with many queries.
    tasks = 2 * spark.sparkContext.defaultParallelism
    rows = rows.select("id", "embedding", "cell", "run", *needs).repartition(tasks, "cell", "run")

    def cut(chunk):
        chunk = chunk.sort_by([("cell", "ascending"), ("run", "ascending")]).combine_chunks()
        cell, run = chunk["cell"].to_numpy(), chunk["run"].to_numpy()
        cuts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (run[1:] != run[:-1])])
        needed = [chunk[name].chunk(0).take(pa.array(cuts)) for name in needs]
        needed = [np.array(p, np.int64) for p in needed[0].to_pylist()] if listed else [as_matrix(column) for column in needed]
        return chunk["id"].chunk(0), as_matrix(chunk["embedding"].chunk(0)), cuts, needed

    def add(best, chunk, start, stop):
        ids, matrix, cuts, needed = chunk
        ends = np.r_[cuts[1:], len(matrix)]

        def compare(block, asked):
            if len(asked):
                best.add(ids.slice(cuts[block], ends[block] - cuts[block]), matrix[cuts[block] : ends[block]], asked)

        if listed:
            for block, places in enumerate(needed):
                compare(block, places[np.searchsorted(places, start) : np.searchsorted(places, stop)] - start)
            return
        _, _, reach, to_pivots = shared.value
        for at, within in _needed(*needed, to_pivots[start:stop], reach[start:stop]):
            for block, queries in enumerate(within):
                compare(at + block, np.flatnonzero(queries))

    def search(batches):
        positions, vectors, reach, _ = shared.value
        chunks = map(cut, _chunks(batches, vectors.shape[1]))
        for start, found in by_groups(vectors, k, "euclidean", chunks, add, reach):
            yield from _hits_table(positions[start:], found).to_batches(max_chunksize=BATCH_ROWS)

    return rows.mapInArrow(search, schema), tasks


def nearest_pruned(
    blocks,
    queries,
    k=settings.SEARCH_DEPTH,
    id_col="id",
    vector_col="embedding",
    max_hits=settings.TASK_HITS,
    max_bytes=settings.QUERY_VECTOR_BYTES,
):
    """The k rows of `blocks` closest to each query by Euclidean distance, exactly.

    As `nearest`, with one more column: `skipped`, the share of the vectors that no
    distance of the query was taken to. A first search of the blocks of least
    bound gives each query its reach; a second one reads the blocks within
    it. Query sets beyond the bounds are searched group by group, each group
    within them. Without queries or rows there are no hits.
    """
    spark = blocks.rows.sparkSession
    most = max(1, max_hits // k)
    dim, head = query_head(queries, vector_col, most, max_bytes)
    if not dim or dim != blocks.dim:
        return _empty(blocks.rows, "id").withColumn("skipped", F.lit(None).cast("double")).withColumnRenamed("id", id_col)
    if head is not None:
        return _pruned(spark, blocks, head, k, vector_col).withColumnRenamed("id", id_col)
    queries = stage(queries.filter(F.col(vector_col).isNotNull()), "queries")
    groups = math.ceil(queries.count() / max(1, min(most, max_bytes // (8 * dim)) // 2))
    found = None
    for group in range(groups):
        some = queries.where(F.pmod(F.xxhash64("query_pos"), F.lit(groups)) == group)
        head = some.select("query_pos", "query_id", vector_col).toArrow()
        if head.num_rows:
            part = stage(_pruned(spark, blocks, head, k, vector_col), "pruned")
            found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col)


def _pruned(spark, blocks, head, k, vector_col):
    positions = head["query_pos"].to_numpy().astype(np.int64)
    vectors = as_matrix(head[vector_col].combine_chunks())
    to_pivots = _to_all(vectors, blocks.pivots)
    total = blocks.bounds.agg(F.sum("n").alias("n")).first().n or 0
    first = _nearest_blocks(blocks.bounds, to_pivots, k)
    first = stage(first.groupBy("part", "cell", "run").agg(F.sort_array(F.collect_set("place")).alias("places")), "first")
    partial, tasks = _search(blocks, first, positions, vectors, k, np.full(len(vectors), np.inf))
    known = merge_hits(partial, k, tasks, F.col("query_pos"))
    ends = known.groupBy("query_pos").agg(F.max("distance").alias("reach"), F.count("*").alias("n")).toArrow()
    ends = {p: r for p, r, n in zip(*(ends[c].to_pylist() for c in ("query_pos", "reach", "n"))) if n == k}
    reach = np.array([ends.get(int(position), np.inf) for position in positions])
    wanted, read = _blocks_within(blocks.bounds, to_pivots, reach)
    partial, tasks = _search(blocks, wanted, positions, vectors, k, reach, to_pivots)
    hits = merge_hits(partial, k, tasks, F.col("query_pos"))
    names = head.select(["query_pos", "query_id"]).to_pandas()
    names = spark.createDataFrame(names.assign(place=range(len(names))), "query_pos long, query_id string, place int")
    names = names.join(read, "place", "left").withColumn("skipped", 1 - F.coalesce("n", F.lit(0)) / F.lit(max(1, total)))
    names = F.broadcast(names.select("query_pos", "query_id", "skipped"))
    return hits.join(names, "query_pos").select("query_pos", "query_id", "rank", "id", "distance", "skipped")
