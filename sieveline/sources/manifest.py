"""File lists and completeness of a snapshot."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField(
            "entries",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("url", T.StringType()),
                        T.StructField(
                            "meta",
                            T.StructType(
                                [
                                    T.StructField("content_length", T.LongType()),
                                    T.StructField("record_count", T.LongType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def read_manifest(spark, path):
    """One row (url, content_length, record_count) per file of the manifest."""
    entries = spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.inline("entries"))
    return entries.select("url", "meta.content_length", "meta.record_count")


def file_paths(entries, folder):
    """Save path of each file, `folder`/<last folder>/<file>, in url order."""
    parts = F.split("url", "/")
    path = F.concat_ws("/", F.lit(folder), F.element_at(parts, -2), F.element_at(parts, -1))
    return entries.withColumn("path", path).orderBy("url")


def file_counts(rows):
    """Records read per file of a scan, by the last two segments of its path."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    name = F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1))
    return rows.select(name.alias("file")).groupBy("file").agg(F.count("*").alias("n_read"))


def _file(url):
    parts = F.split(url, "/")
    return F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1))


def snapshot_delta(before, after):
    """(file, state): what became of each file between two manifests (url, content_length, record_count).

    A file is `new`, `vanished`, `changed` if its length or number of records is another, or `same`;
    only the first three need work. A file that a manifest lists twice counts with the greater numbers.
    """
    sides = []
    for name, entries in (("_before", before), ("_after", after)):
        marks = F.struct(F.max("content_length").alias("length"), F.max("record_count").alias("records"))
        sides.append(entries.where("url IS NOT NULL").groupBy(_file(F.col("url")).alias("file")).agg(marks.alias(name)))
    state = (
        F.when(F.col("_before").isNull(), "new")
        .when(F.col("_after").isNull(), "vanished")
        .when(F.col("_before").eqNullSafe(F.col("_after")), "same")
        .otherwise("changed")
    )
    return sides[0].join(sides[1], "file", "full_outer").select("file", state.alias("state"))


def delta_rows(rows, delta):
    """Rows of a scan, with their file, that lie in a new or changed file; other files are not to be embedded again."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    named = rows.withColumn("file", F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)))
    return named.join(delta.where("state IN ('new', 'changed')").select("file"), "file", "left_semi")


def retracted(held, delta, fresh):
    """Ids of `held` (id, file) from changed or vanished files that no file of the new snapshot holds: tombstones.

    `fresh` (id) are the rows of new and changed files. An id that is also held from a file that stayed the
    same is not retracted, nor is one that moved to another file.
    """
    touched = delta.where("state IN ('changed', 'vanished')").select("file")
    gone = held.where("id IS NOT NULL").join(touched, "file", "left_semi").select("id").distinct()
    kept = held.join(touched, "file", "left_anti").select("id").union(fresh.select("id"))
    return gone.join(kept.where("id IS NOT NULL").distinct(), "id", "left_anti")


def completeness(entries, counts):
    """Declared against read records per file; either side may be missing."""
    parts = F.split("url", "/")
    declared = entries.select(
        F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)).alias("file"), "record_count"
    )
    state = (
        F.when(F.col("n_read").isNull(), "missing")
        .when(F.col("record_count").isNull(), "undeclared")
        .when(F.col("n_read") == F.col("record_count"), "complete")
        .otherwise("differs")
    )
    return declared.join(counts, "file", "full_outer").withColumn("state", state)
