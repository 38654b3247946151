"""Shared-folder tables, size checks and joins that choose by size."""

import hashlib
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline import settings


def shared_dir(spark):
    """Folder every executor can read: `spark.checkpoint.dir`, or the context's checkpoint folder.

    The caller chooses it; without one this raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder


def run_folder(spark):
    """The one folder below the shared one that this application stages its tables in."""
    return f"{shared_dir(spark).rstrip('/')}/sieveline-{spark.sparkContext.applicationId}"


def drop_run(spark):
    """Remove all tables this application has staged; for when its results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged_path(spark, name):
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df, name="stage"):
    """Write `df` once to the shared folder and read it back.

    The copy survives lost executors, is computed once however often it is
    used, and gives Catalyst the real size to choose join strategies by.
    """
    path = staged_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df, path):
    """Read `path` if a finished write is there, else compute `df` into it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fingerprint(df):
    """Digest of what `df` would be computed from: its plan, and the files it reads by path, size and time.

    None if it does not read files alone, as rows given as literals leave no mark on a
    plan. Python functions enter by name only: a changed kernel is the same plan.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    if any(leaves.apply(n).nodeName().split(" ")[0] != "LogicalRelation" for n in range(leaves.size())):
        return None
    limit = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "100000")
    try:
        seen = [plan.canonicalized().toString()]
    finally:
        spark.conf.set(limit, before)
    path_of, hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    wanted = set(df.inputFiles())
    for folder in sorted({file.rsplit("/", 1)[0] for file in wanted}):
        # File names come as URIs; one listing a folder gives all sizes and times.
        folder = path_of(spark.sparkContext._jvm.java.net.URI(folder))
        for status in folder.getFileSystem(hadoop).listStatus(folder):
            if status.getPath().toUri().toString() in wanted or status.getPath().toString() in wanted:
                seen.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(seen[:1] + sorted(seen[1:])).encode()).hexdigest()


def materialize_known(df, path):
    """As `materialize`, below `path` by the fingerprint of `df`: a changed input or plan is computed anew.

    What was computed from earlier inputs stays beside it until its folder is removed. A
    table without a fingerprint is computed on every call.
    """
    known = fingerprint(df)
    return materialize(df, f"{path}/{known}") if known else stage(df, "unknown")


def spread(df):
    """`df` over all cores if it is read from fewer files than there are cores.

    For costly row-wise steps over few or unsplittable files; an input of
    enough files stays in place.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def input_bytes(df):
    """Catalyst's estimate of the size of `df` in bytes, from the files it reads; 0 if it knows nothing."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 2**60 else 0


def few_tasks(df, task_bytes=settings.TASK_BYTES):
    """(df, tasks): `df` in place, in no more tasks than four per core or one per `task_bytes` need.

    For steps whose results per task are large: fewer tasks return less, but
    none reads much more than `task_bytes` however few cores there are yet.
    """
    tasks = max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // task_bytes))
    return df.coalesce(tasks), tasks


PLAIN = {"Project", "Filter", "LogicalRelation", "LocalRelation", "LogicalRDD", "InMemoryRelation"}


def plain_scan(df):
    """True if `df` is no more than a filtered scan, so that reading it again costs little."""
    pending = [df._jdf.queryExecution().optimizedPlan()]
    while pending:
        node = pending.pop()
        if node.nodeName().split(" ")[0] not in PLAIN:
            return False
        pending += [node.children().apply(n) for n in range(node.children().size())]
    return True


def join_known(left, right, on):
    """Left join on a key that may be null for very many rows of `left`.

    Rows without the key match nothing; they are set apart, as the join would
    send all of them to one task.
    """
    known = left.where(F.col(on).isNotNull()).join(right, on, "left")
    return known.unionByName(left.where(F.col(on).isNull()), allowMissingColumns=True)


def fits(df, rows=settings.BROADCAST_ROWS):
    """True if `df`, a table of keys, has at most `rows` rows.

    Tables with texts or vectors are staged instead, so that Catalyst judges
    them by their bytes.
    """
    return df.limit(rows + 1).count() <= rows


def small(df, rows=settings.BROADCAST_ROWS):
    """`df` with a broadcast hint if its size was checked, else unchanged."""
    return F.broadcast(df) if fits(df, rows) else df


def semi_join_hot(left, keys, on, rows=settings.BROADCAST_ROWS, hot_rows=settings.HOT_ROWS):
    """Semi join for a `left` side in which single keys may be very frequent.

    `keys` holds one column `on`, each value once. Within the row bound it is
    broadcast and `left` stays in place. Beyond it the keys with more than
    `hot_rows` rows, of which there cannot be many, are set apart: their rows
    are kept or dropped in place, and only the others are shuffled.
    """
    if fits(keys, rows):
        return left.join(F.broadcast(keys), on, "left_semi")
    counts = left.groupBy(on).agg(F.count("*").alias("_n"))
    hot = small(stage(counts.filter(F.col("_n") > hot_rows).select(on), "hot"))
    wanted = small(stage(hot.join(keys, on, "left_semi"), "wanted"))
    others = left.join(hot, on, "left_anti").join(keys, on, "left_semi")
    return left.join(wanted, on, "left_semi").unionByName(others)


def join_hot(left, right, on, rows=settings.BROADCAST_ROWS, hot_rows=settings.HOT_ROWS):
    """Inner join for a `left` side in which single keys may be very frequent.

    `right` has a few rows per key. Within the row bound it is broadcast and
    `left` stays in place. Beyond it the rows of keys with more than `hot_rows`
    rows on the left meet their keys in place, and only the others are shuffled.
    """
    right = stage(right, "right")
    if fits(right, rows):
        return left.join(F.broadcast(right), on)
    counts = left.groupBy(on).agg(F.count("*").alias("_n"))
    hot = small(stage(counts.filter(F.col("_n") > hot_rows).select(on), "hot"))
    met = small(stage(right.join(hot, on, "left_semi"), "met"))
    return left.join(met, on).unionByName(left.join(hot, on, "left_anti").join(right, on))


def number_rows(df, name, *order, start=0):
    """Number rows by a total order without sorting them all in one task.

    Rows are staged, as the range bounds are sampled first, then partitioned
    by range of `order`, sorted inside their partitions and staged again;
    adding the sizes of the partitions before gives the number.
    """
    ranged = stage(df, "unnumbered").repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stage(ranged.withColumn("_local", F.monotonically_increasing_id()), "numbered")
    # The generated id holds the partition above bit 33 and the row below.
    part, row = F.shiftright("_local", 33), F.col("_local").bitwiseAND(F.lit(2**33 - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.withColumns({"_part": part, "_row": row})
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_row") + F.col("_offset") + F.lit(start))
        .drop("_local", "_part", "_row", "_offset")
    )
