"""Nearest-neighbour join of query vectors with a corpus of vectors."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sieveline import settings
from sieveline.functions.text import short_id
from sieveline.functions.vectors import RunningTopK, as_matrix, comparable, vector_fault
from sieveline.staging import few_tasks, fits, stage

BATCH_ROWS = 65_536


def nearest(
    corpus,
    queries,
    k=settings.SEARCH_DEPTH,
    metric="euclidean",
    id_col="id",
    vector_col="embedding",
    exclude_self=False,
    element="float",
    max_hits=settings.TASK_HITS,
    max_bytes=settings.QUERY_VECTOR_BYTES,
):
    """The k corpus rows closest to each query, exactly.

    `queries` has query_pos (list order), query_id and embedding. The result
    has query_pos, query_id, rank (from 0), the corpus id and distance.

    With element `bfloat16` vectors are compared in that precision.

    A query set within the bounds is broadcast and the corpus is read once in
    place, every task returning k rows per query and holding those of a group of queries. A larger one is matched with
    blocks of the corpus through a shuffle. Queries without a vector have no hits; queries
    of different lengths, or with elements that are no numbers, are an error that
    names them. Corpus rows that cannot be compared (see `vector_fault`) are no
    hits of any query; `split_valid` reports them by the same rule.
    """
    depth = k + 1 if exclude_self else k
    dim, head = query_head(queries, vector_col, max(1, max_hits // depth), max_bytes)
    if not dim:
        return _empty(corpus, id_col)
    rows = corpus.filter(comparable(vector_col, dim))
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    if head is not None:
        partial, names, parts = _search_in_place(rows, head, vector_col, depth, metric, element)
    else:
        queries = queries.filter(F.col(vector_col).isNotNull())
        partial, names, parts = _search_blocks(rows, corpus.count(), queries, vector_col, depth, metric, element, dim)
    hits = merge_hits(partial, depth, parts, F.col("query_pos"))
    hits = hits.join(names, "query_pos")
    if exclude_self:
        hits = hits.filter(F.col("id").cast("string") != short_id(F.col("query_id")))
        by_rank = Window.partitionBy("query_pos").orderBy("rank")
        hits = hits.withColumn("n", F.row_number().over(by_rank)).filter(F.col("n") <= k)
        hits = hits.withColumn("rank", F.col("n") - 1).drop("n")
    return hits.select("query_pos", "query_id", "rank", F.col("id").alias(id_col), "distance")


def query_head(queries, vector_col, max_rows, max_bytes):
    """Length of the query vectors, and the queries that have one as an Arrow table.

    The table is None if there are more than `max_rows` or their numbers take
    more than `max_bytes`; nothing beyond that reaches the driver. The length is
    0 if no query has a vector.
    """
    queries = queries.filter(F.col(vector_col).isNotNull())
    size = F.size(vector_col)
    found = queries.agg(F.min(size).alias("least"), F.max(size).alias("most"), F.count("*").alias("n")).first()
    if not found.n:
        return 0, None
    fault = F.coalesce(vector_fault(vector_col, found.most), F.when(size == 0, "empty"))
    faulty = queries.withColumn("_fault", fault).filter(F.col("_fault").isNotNull()).select("query_id", "_fault")
    faulty = faulty.limit(20).collect()
    if faulty:
        raise ValueError(f"queries that cannot be compared: {[tuple(row) for row in faulty]}")
    if found.n > max_rows or found.n * found.most * 8 > max_bytes:
        return found.most, None
    return found.most, queries.select("query_pos", "query_id", vector_col).toArrow()


def _empty(corpus, id_col):
    kind = corpus.schema[id_col].dataType.simpleString()
    schema = f"query_pos long, query_id string, rank int, {id_col} {kind}, distance double"
    return corpus.sparkSession.createDataFrame([], schema)


def _partial_schema(rows):
    return T.StructType(
        [
            T.StructField("query_pos", T.LongType()),
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _hits_table(positions, found):
    return pa.table(
        {
            "query_pos": pa.array(positions[found["query"].to_numpy()]),
            "id": found["id"],
            "distance": found["distance"],
        }
    )


def _chunks(batches, dim):
    """Tables of the rows of `batches`, of about CHUNK_CELLS numbers in vectors of `dim`; none is empty."""
    most, waiting, held = max(1, settings.CHUNK_CELLS // dim), [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            part = batch.slice(start, most)
            if held and held + part.num_rows > most:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, held = [], 0
            waiting.append(part)
            held += part.num_rows
    if held:
        yield pa.Table.from_batches(waiting).combine_chunks()


def by_groups(vectors, k, metric, chunks, add, bound=None):
    """(place of the first query, hits of a group of queries), so that hits held do not grow with the queries.

    `add(best, chunk, start, stop)` compares a chunk with the queries from `start` to `stop`. Queries whose
    hits all fit HELD_HITS are one group, held over all chunks. Of more
    queries every chunk gives k hits each, group by group, and the k-th distances so far
    bound what later chunks give.
    """
    step = max(1, settings.HELD_HITS // k)
    bound = np.full(len(vectors), np.inf) if bound is None else np.array(bound)
    if len(vectors) <= step:
        best = RunningTopK(vectors, k, metric, bound)
        for chunk in chunks:
            add(best, chunk, 0, len(vectors))
        found = best.result()
        if found is not None:
            yield 0, found
        return
    for chunk in chunks:
        for start in range(0, len(vectors), step):
            stop = min(start + step, len(vectors))
            best = RunningTopK(vectors[start:stop], k, metric, bound[start:stop])
            add(best, chunk, start, stop)
            found = best.result()
            if found is not None:
                bound[start:stop] = best.bound
                yield start, found


def _search_in_place(rows, head, vector_col, k, metric, element):
    """Each task scans its part of the corpus against the broadcast queries."""
    spark = rows.sparkSession
    positions = head["query_pos"].to_numpy().astype(np.int64)
    shared = spark.sparkContext.broadcast((positions, as_matrix(head[vector_col].combine_chunks(), element)))

    def search(batches):
        positions, vectors = shared.value
        chunks = _chunks(batches, vectors.shape[1])
        chunks = ((chunk["id"].chunk(0), as_matrix(chunk["embedding"].chunk(0), element)) for chunk in chunks)
        for start, found in by_groups(vectors, k, metric, chunks, lambda best, chunk, *_: best.add(*chunk)):
            yield from _hits_table(positions[start:], found).to_batches(max_chunksize=BATCH_ROWS)

    # Every task emits up to k rows per query, so few long tasks shuffle less
    # than one task per file split.
    rows, tasks = few_tasks(rows)
    partial = rows.mapInArrow(search, _partial_schema(rows))
    names = spark.createDataFrame(
        head.select(["query_pos", "query_id"]).to_pandas(), "query_pos long, query_id string"
    )
    return partial, F.broadcast(names), tasks


def _search_blocks(rows, n_rows, queries, vector_col, k, metric, element, dim):
    """Match every block of corpus rows with all queries.

    Blocks are cut by a hash, so they have the same size whatever the data.
    Rows are shuffled once and only the queries go to every block, so that what is
    written does not grow with the product of both sides but with the queries by the
    blocks, which are as large as a task may hold. Some blocks, of about the square root of
    their number, are searched first: the k-th distance per query there can only be
    too large, so the other blocks need not return anything beyond it.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(n_rows * dim / settings.BLOCK_CELLS), min(4 * cores, math.ceil(n_rows / settings.BLOCK_VECTORS)))
    first = min(blocks, settings.FIRST_BLOCKS, max(cores, math.ceil(math.sqrt(blocks))))
    names = queries.select("query_pos", "query_id")
    asked = queries.select("query_pos", F.col(vector_col).alias("embedding"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    endless = F.lit(float("inf"))
    found = _stream_blocks(rows, asked.withColumn("reach", endless), 0, first, k, metric, element, dim)
    if first == blocks:
        return found, names, blocks
    found = stage(merge_hits(found, k, first, F.col("query_pos")).drop("rank"), "first")
    reach = F.when(F.count("*") == k, F.max("distance")).otherwise(endless).alias("reach")
    asked = asked.join(found.groupBy("query_pos").agg(reach), "query_pos", "left").fillna(float("inf"), "reach")
    rest = _stream_blocks(rows, asked, first, blocks, k, metric, element, dim)
    return found.unionByName(rest), names, blocks - first + 1


def _stream_blocks(rows, queries, start, stop, k, metric, element, dim):
    """Up to k rows per query and block from `start` to `stop`; a task holds one block and takes the queries in chunks."""
    schema = _partial_schema(rows)
    kinds = {df.schema["embedding"].dataType.elementType.simpleString() for df in (rows, queries)}
    vector = F.col("embedding").cast("array<double>" if len(kinds) > 1 else f"array<{kinds.pop()}>").alias("embedding")
    blocks = F.explode(F.sequence(F.lit(start), F.lit(stop - 1))).alias("block")
    left = queries.select(F.lit(True).alias("asked"), blocks, "query_pos", "reach", vector)
    right = rows.filter((F.col("block") >= start) & (F.col("block") < stop))
    right = right.select(F.lit(False).alias("asked"), "block", "id", vector)
    dealt = left.unionByName(right, allowMissingColumns=True).repartitionById(stop - start, F.col("block") - start)
    step = max(1, settings.HELD_HITS // k)

    def hold(batches, held):
        for batch in batches:
            n = pc.index(batch.column("asked"), True).as_py()
            n = batch.num_rows if n < 0 else n
            if n:
                held.append((batch.column("id").slice(0, n), as_matrix(batch.column("embedding").slice(0, n), element, None)))
            if n < batch.num_rows:
                yield batch.slice(n)

    def search(batches):
        # Rows come first, so all of them are held when the first queries come.
        held = []
        for chunk in _chunks(hold(batches, held), dim):
            for at in range(0, chunk.num_rows, step):
                part = chunk.slice(at, step)
                vectors = as_matrix(part["embedding"].chunk(0), element)
                best = RunningTopK(vectors, k, metric, part["reach"].to_numpy())
                for ids, matrix in held:
                    best.add(ids, matrix)
                found = best.result()
                if found is not None:
                    yield from _hits_table(part["query_pos"].to_numpy(), found).to_batches(max_chunksize=BATCH_ROWS)

    return dealt.sortWithinPartitions("asked").mapInArrow(search, schema)


def _match_blocks(left, right, k, metric, element="float", keys=("query_block", "row_block")):
    schema = _partial_schema(right)
    nothing = to_arrow_schema(schema).empty_table()

    def search(queries, rows):
        if queries.num_rows == 0 or rows.num_rows == 0:
            return nothing
        queries, rows = queries.combine_chunks(), rows.combine_chunks()
        vectors, positions = as_matrix(queries["embedding"].chunk(0), element), queries["query_pos"].to_numpy()
        # Rows are few enough to be one chunk.
        chunk = [(rows["id"].chunk(0), as_matrix(rows["embedding"].chunk(0), element))]
        add, reach = lambda best, chunk, *_: best.add(*chunk), queries["reach"].to_numpy()
        found = [_hits_table(positions[start:], hits) for start, hits in by_groups(vectors, k, metric, chunk, add, reach)]
        return pa.concat_tables(found).combine_chunks() if found else nothing

    keys = list(keys)
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(search, schema)


def merge_hits(partial, k, parts, *query):
    """Global k best rows per query from the rows the tasks kept.

    `parts` is the number of tasks or blocks that return up to k rows per query
    each. Very many candidate rows are first reduced in salted parts.
    The filter stands on the row number itself so that Spark limits each
    group before the shuffle.
    """
    expected = parts * k
    if expected > settings.MERGE_ROWS:
        salts = math.ceil(expected / settings.MERGE_ROWS)
        salted = partial.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
        part = Window.partitionBy(*query, "_salt").orderBy("distance", "id")
        partial = salted.withColumn("n", F.row_number().over(part)).filter(F.col("n") <= k).drop("n", "_salt")
    whole = Window.partitionBy(*query).orderBy("distance", "id")
    ranked = partial.withColumn("n", F.row_number().over(whole)).filter(F.col("n") <= k)
    return ranked.withColumn("rank", F.col("n") - 1).drop("n")


def with_vectors(hits, corpus, bound, id_col="id", vector_col="embedding"):
    """Add the embedding of each hit by one more scan of the corpus.

    `bound` is the number of distinct ids the hits are thought to have; whether
    they do is counted before they are broadcast.
    """
    ids = hits.select(id_col).distinct()
    ids = F.broadcast(ids) if bound <= settings.BROADCAST_ROWS and fits(ids) else ids
    return hits.join(corpus.select(id_col, vector_col).join(ids, id_col, "left_semi"), id_col)


def check_depth(hits, k):
    """Raise if any query has fewer than k hits; else return `hits`."""
    short = hits.groupBy("query_pos").count().filter(F.col("count") < k).limit(20).collect()
    if short:
        raise ValueError(f"queries with fewer than {k} hits: {[row.query_pos for row in short]}")
    return hits
