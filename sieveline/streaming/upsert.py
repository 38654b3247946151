"""Incremental upsert of vectors into a keyed table: a small version per batch, merged by size."""

import re

from pyspark.sql import functions as F

from sieveline.operators.feed import PART_KEYS, keep_latest, split_valid
from sieveline.staging import small, stage

BUCKETS = 64
# A version is merged with those before it that are at most so many times its size; so each row is
# written again as often as the table has grown by this factor, not once a batch.
MERGE_FACTOR = 4
# Of two rows of one version the one that arrived later stays.
ORDER = (*PART_KEYS, "arrived")


def _bucket(buckets):
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def upsert_stream(rows, table, rejected, checkpoint, dim, buckets=BUCKETS):
    """Start a query that adds the batches of a stream to the vector table.

    A batch is written as a version of its own and nothing else is touched;
    versions of like size are then merged, so that there are few of them
    and a small batch does not write a large table anew. A repeated batch replaces itself.
    Rows with a true column `gone`, if the stream has one, are tombstones: the id is no longer there as
    of their version. Merging drops what they hide and keeps them, as an older row may still come.
    Rows that cannot be stored go to `rejected` with the reason. `current` reads the table as one row per id.
    """

    def add(batch, number):
        spark = batch.sparkSession
        marked = "gone" in batch.columns
        batch = batch.withColumn("gone", F.coalesce("gone", F.lit(False)) if marked else F.lit(False)).persist()
        try:
            stored, refused = split_valid(batch.where(~F.col("gone")), dim)
            nameless = batch.where("gone AND id IS NULL").withColumn("reason", F.lit("missing id"))
            refused.unionByName(nameless).drop("gone").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
            dead = batch.where("gone AND id IS NOT NULL")
            bare = dead.withColumn("embedding", F.lit(None).cast(dead.schema["embedding"].dataType))
            new = stage(keep_latest(stored.unionByName(bare)).withColumn("arrived", F.lit(number).cast("long")), "new")
        finally:
            batch.unpersist()
        spans = _spans(spark, table)
        if any(low <= number <= high for low, high in spans if low != high):
            return  # merged before this batch was run again
        _write(new, table, number, number, buckets)
        _merge(spark, table, buckets)

    return (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _hadoop(spark, path):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _all_spans(spark, table):
    """{(first, last batch): folder} of all finished versions."""
    files, path = _hadoop(spark, table)
    if not files.exists(path):
        return {}
    found = {}
    for status in files.listStatus(path):
        name = re.fullmatch(r"batch=(\d+)-(\d+)", status.getPath().getName())
        folder = f"{table}/{status.getPath().getName()}"
        if name and files.exists(_hadoop(spark, f"{folder}/_SUCCESS")[1]):
            found[int(name[1]), int(name[2])] = folder
    return found


def _spans(spark, table):
    """The versions that no other one contains, in order."""
    found = _all_spans(spark, table)
    inside = lambda one, other: one != other and other[0] <= one[0] and one[1] <= other[1]
    return dict(sorted(item for item in found.items() if not any(inside(item[0], other) for other in found)))


def _bytes(spark, folder):
    files, path = _hadoop(spark, folder)
    return files.getContentSummary(path).getLength()


def _write(rows, table, low, high, buckets):
    folder = f"{table}/batch={low}-{high}"
    if low == 0:
        # The version that all others are laid on: in folders by id, large ones split.
        rows.withColumn("bucket", _bucket(buckets)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    else:
        rows.hint("rebalance").write.mode("overwrite").parquet(folder)


def _read(spark, folder, low):
    rows = spark.read.parquet(folder)
    return rows.drop("bucket") if low == 0 else rows


def _merge(spark, table, buckets):
    """Merge the last versions as long as the one before is not much larger than all after it."""
    spans = list(_spans(spark, table).items())
    together, size = [spans.pop()], 0
    while spans:
        size += _bytes(spark, together[-1][1])
        if _bytes(spark, spans[-1][1]) > MERGE_FACTOR * size:
            break
        together.append(spans.pop())
    if len(together) > 1:
        together.reverse()
        _write(_latest(spark, together), table, together[0][0][0], together[-1][0][1], buckets)


def _latest(spark, spans):
    """The last version of each id over some versions of the table, tombstones included.

    Only the ids of the later versions are compared; what the first one holds of other ids stays in place.
    """
    (low, _), folder = spans[0]
    held = _read(spark, folder, low)
    if len(spans) == 1:
        return held
    later = None
    for (low, _), folder in spans[1:]:
        rows = _read(spark, folder, low)
        later = rows if later is None else later.unionByName(rows)
    ids = small(stage(later.select(F.col("id").alias("_id")).distinct(), "later"))
    same = F.col("id") == F.col("_id")
    touched = stage(later.unionByName(held.join(ids, same, "left_semi")), "touched")
    return held.join(ids, same, "left_anti").unionByName(keep_latest(touched, order=ORDER))


def current(spark, table):
    """The latest version per id over all batches added so far, without ids that are gone."""
    found = _latest(spark, list(_spans(spark, table).items()))
    return found.where(~F.col("gone")).drop("gone", "arrived")


def gone(spark, table):
    """Ids whose latest version is a tombstone, with the version and its other columns."""
    return _latest(spark, list(_spans(spark, table).items())).where("gone").drop("gone", "arrived", "embedding")


def vacuum(spark, table):
    """Remove the versions that were merged into others."""
    kept = _spans(spark, table)
    for span, folder in _all_spans(spark, table).items():
        if span not in kept:
            files, path = _hadoop(spark, folder)
            files.delete(path, True)
