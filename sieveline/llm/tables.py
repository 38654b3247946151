"""The given tables, words, and global orders that no single task has to sort."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.staging import stage

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}

# White space of the contracts: blank and the control characters 9 to 13.
BLANK = r"[\x20\x09-\x0D]"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark, sf_dir, name):
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs, column="text"):
    """The text, empty where it is null."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def row_hash(docs):
    """Tells rows of one doc_id but different texts apart."""
    return F.xxhash64(docs["doc_id"], text_of(docs))


def words(text):
    """Array of the words of a text column: the longest runs without blanks."""
    return F.filter(F.split(text, BLANK + "+"), lambda word: word != "")


def running(df, order, totals, row=None):
    """`df` with running totals, this row included, along a global order.

    `totals` maps new columns to columns of `df`; `row` names a row number that
    starts at 0. Rows are dealt by range of `order` and staged with their
    partition; each row adds the totals of the partitions before its own to
    the running total inside it. `df` should be narrow and read from disk, as
    range bounds are sampled first. Rows equal in `order` should be equal in
    the summed columns, so that reruns agree. An empty `df` stays empty.
    """
    sums = dict(totals)
    if row:
        df, sums[row] = df.withColumn("_one", F.lit(1).cast("long")), "_one"
    ranged = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(*(F.sum(of).alias(f"_sum_{new}") for new, of in sums.items()))
        .select("_part", *(F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_before_{new}") for new in sums))
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per partition of the range exchange: as small as its list of tasks.
    ranged = ranged.withColumns({f"_sum_{new}": F.sum(of).over(inside) for new, of in sums.items()}).join(
        F.broadcast(offsets), "_part"
    )
    result = ranged.withColumns({new: F.col(f"_sum_{new}") + F.col(f"_before_{new}") for new in sums})
    if row:
        result = result.withColumn(row, F.col(row) - 1)
    return result.drop("_part", "_one", *(f"_{kind}_{new}" for kind in ("sum", "before") for new in sums))
