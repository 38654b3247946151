"""Cosine similarity of every row with a set of reference vectors."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline import settings
from sieveline.functions.vectors import References, as_matrix, comparable, most_similar_rows
from sieveline.operators.neighbors import query_head
from sieveline.staging import stage

# Rows and references of one group beyond the bound, and rows compared at once in it.
ROW_BLOCK, REFERENCE_BLOCK, ROW_STEP = 16_384, 8_192, 4_096


def most_similar(
    rows,
    references,
    key="id",
    vector_col="embedding",
    max_references=10_000,
    max_bytes=settings.QUERY_VECTOR_BYTES,
):
    """Per row the highest cosine similarity and the reference that gives it.

    `references` has query_pos, query_id and embedding; on a tie the lowest
    query_pos wins. No row-by-reference pairs are produced. Returns `key`,
    query_pos, query_id and similarity. Rows that cannot be compared are left
    out; references that cannot be compared with each other are an error.
    """
    columns = references.select("query_pos", "query_id", vector_col).filter(F.col(vector_col).isNotNull())
    dim, head = query_head(columns, vector_col, max_references, max_bytes)
    if dim and head is None:
        return _by_join(rows.filter(comparable(vector_col, dim)), columns, key, vector_col)
    head = head.sort_by("query_pos") if dim else columns.limit(0).toArrow()
    return _in_place(rows, head, key, vector_col, dim)


def _in_place(rows, head, key, vector_col, dim):
    spark = rows.sparkSession
    positions = head["query_pos"].to_numpy().astype(np.int64)
    vectors = as_matrix(head[vector_col].combine_chunks()) if head.num_rows else np.empty((0, 0))
    shared = spark.sparkContext.broadcast((positions, vectors))

    def compare(batches):
        positions, vectors = shared.value
        vectors = References(vectors)
        for batch in batches:
            if batch.num_rows and len(positions):
                index, best = most_similar_rows(as_matrix(batch.column(1)), vectors)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(positions[index]), pa.array(best)],
                    ["key", "query_pos", "similarity"],
                )

    schema = T.StructType(
        [
            T.StructField("key", rows.schema[key].dataType),
            T.StructField("query_pos", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    compared = rows.filter(comparable(vector_col, dim)).select(key, vector_col).mapInArrow(compare, schema)
    names = spark.createDataFrame(
        head.select(["query_pos", "query_id"]).to_pandas(), "query_pos long, query_id string"
    )
    return compared.join(F.broadcast(names), "query_pos").select(
        F.col("key").alias(key), "query_pos", "query_id", "similarity"
    )


def _by_join(rows, references, key, vector_col):
    """Beyond the bound: blocks of rows meet blocks of references, and each row keeps the best of its blocks."""
    numbered = rows.select(F.col(key).alias("row_key"), F.col(vector_col).alias("embedding"), F.monotonically_increasing_id().alias("row"))
    numbered = stage(numbered, "rows")
    references = stage(references.withColumnRenamed(vector_col, "embedding"), "references")
    row_blocks = max(1, math.ceil(numbered.count() / ROW_BLOCK))
    reference_blocks = max(1, math.ceil(references.count() / REFERENCE_BLOCK))
    number = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = numbered.select("row", "embedding", number("row", row_blocks).alias("row_block"), every(reference_blocks).alias("reference_block"))
    right = references.select(
        "query_pos", "embedding", number("query_pos", reference_blocks).alias("reference_block"), every(row_blocks).alias("row_block")
    )
    nothing = pa.table({"row": pa.array([], pa.int64()), "query_pos": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())})

    def compare(some, others):
        if not some.num_rows or not others.num_rows:
            return nothing
        others = others.sort_by("query_pos").combine_chunks()
        vectors = References(as_matrix(others["embedding"].chunk(0)))
        found = []
        for batch in some.to_batches(max_chunksize=ROW_STEP):
            index, best = most_similar_rows(as_matrix(batch["embedding"]), vectors)
            found.append(pa.table([batch["row"], others["query_pos"].chunk(0).take(pa.array(index)), pa.array(best)], schema=nothing.schema))
        return pa.concat_tables(found).combine_chunks()

    keys = ["row_block", "reference_block"]
    found = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare, "row long, query_pos long, similarity double")
    # The greatest similarity; of equal ones the lowest query_pos.
    best = found.groupBy("row").agg(F.max(F.struct("similarity", (-F.col("query_pos")).alias("least"))).alias("best"))
    best = best.select("row", (-F.col("best.least")).alias("query_pos"), "best.similarity")
    return (
        best.join(numbered.select("row", "row_key"), "row")
        .join(references.select("query_pos", "query_id"), "query_pos")
        .select(F.col("row_key").alias(key), "query_pos", "query_id", "similarity")
    )


def similarity_to(rows, reference, name, key="id", vector_col="embedding"):
    """Cosine similarity of every row with one vector, as column `name`."""
    one = reference.select(
        F.lit(0).cast("long").alias("query_pos"), F.lit("").alias("query_id"), vector_col
    )
    return most_similar(rows, one, key, vector_col).select(key, F.col("similarity").alias(name))
