"""Works clustered by id, so that a few thousand of them are looked up without reading the table."""

import bisect

from pyspark.sql import functions as F

from sieveline import settings
from sieveline.operators.candidates import WORK_COLUMNS, resolve
from sieveline.staging import small, stage

IN_VALUES = "spark.sql.parquet.pushdown.inFilterThreshold"


def _files(works):
    """(file, first, last, rows) of each file that `works` reads, by their ids."""
    return works.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("id").alias("rows")
    )


class WorkIndex:
    """Works below `path`/works in files sorted by id, and the id range of each file below `path`/files.

    The ids of one delivery fill files that do not overlap; each has Bloom filters of
    its ids, and small row groups and pages. Later deliveries are files of their own,
    whose ranges overlap with the earlier ones.
    """

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def works(self):
        return self.spark.read.parquet(f"{self.path}/works")

    def append(self, works, group_bytes=settings.LOOKUP_GROUP_BYTES, page_rows=settings.LOOKUP_PAGE_ROWS, files=None):
        """Add `works` as new files; none that exist are touched. Works without an id cannot be looked up and stay out.

        `files` is the number of files to deal the rows to, by default as many as Spark makes of their bytes.
        """
        known = works.where(F.col("id").isNotNull())
        dealt = known.repartitionByRange(files, "id") if files else known.repartitionByRange("id")
        before = self._named()
        options = {
            "parquet.bloom.filter.enabled#id": "true",
            # Ids differ from row to row: a dictionary would only keep the filter from being written.
            "parquet.enable.dictionary#id": "false",
            "parquet.block.size": str(group_bytes),
            "parquet.page.row.count.limit": str(page_rows),
        }
        dealt.sortWithinPartitions("id").write.mode("append").options(**options).parquet(f"{self.path}/works")
        now = _files(self.works().select("id", "_metadata"))
        if before is not None:
            now = now.join(before, "file", "left_anti")
        stage(now.where("rows > 0"), "files").coalesce(1).write.mode("append").parquet(f"{self.path}/files")
        return self

    def _named(self):
        """The files listed so far, one row each; None before the first delivery."""
        files = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/files")
        if files.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(files):
            return self.spark.read.parquet(f"{self.path}/files")
        return None

    def lookup(self, ids, columns=WORK_COLUMNS, merged=None, most=settings.LOOKUP_KEYS, values=settings.LOOKUP_VALUES):
        """The given columns of the works with these ids; as `candidates.enrich`.

        Ids are counted. Up to `most` of them are named in the filters of scans, `values`
        to a scan, each of the files alone whose range holds one of its ids; the
        Parquet reader then opens the row groups and pages that may hold them.
        More ids are joined with the whole table.
        """
        keys = stage(resolve(ids, merged).where("id IS NOT NULL"), "keys")
        if keys.count() > most:
            return self.works().select(*columns).join(small(keys), "id", "left_semi")
        wanted = sorted(row.id for row in keys.collect())
        empty = self.works().select(*columns).limit(0)
        scans = self._scans(wanted, values)
        if not scans:
            return empty
        schema = self.works().schema
        found = None
        for files, own in scans:
            part = self.spark.read.schema(schema).parquet(*files).where(F.col("id").isin(own)).select(*columns)
            found = part if found is None else found.unionByName(part)
        # The reader looks at this setting when it runs, so the rows are staged under it.
        before = self.spark.conf.get(IN_VALUES)
        self.spark.conf.set(IN_VALUES, str(max(values, int(before))))
        try:
            return stage(found, "looked-up")
        finally:
            self.spark.conf.set(IN_VALUES, before)

    def _scans(self, wanted, values):
        """[(files, ids)]: runs of up to `values` of the sorted ids `wanted` with the files whose ranges hold one of them."""
        # One row per file; Spark's own listing of the folder holds as much.
        files = self._named().select("file", "first", "last").collect()
        asked = {}
        for file, first, last in files:
            low, high = bisect.bisect_left(wanted, first), bisect.bisect_right(wanted, last)
            for run in range(low // values, -(-high // values) if high > low else 0):
                asked.setdefault(run, []).append(file)
        return [(sorted(asked[run]), wanted[run * values : (run + 1) * values]) for run in sorted(asked)]


def create_work_index(spark, path, works, **layout):
    """Write `works` as a new index below `path`; `layout` as in `WorkIndex.append`."""
    return WorkIndex(spark, path).append(works, **layout)
