"""A reverse citation index that is kept between runs: edges in buckets by the cited work."""

import uuid

from pyspark.sql import functions as F

from sieveline import settings
from sieveline.staging import fits, small, stage

EDGE = "citing STRING, cited STRING"


class CitationIndex:
    """Edges below `path`: `cold` in buckets by cited id, `hot` as they came, and the list of hot ids.

    Lookups of any number of ids join the buckets as they lie, so the edges
    are not shuffled; a table of buckets is known to the catalog of one session
    and declared again over the same files by the next.
    """

    def __init__(self, spark, path, buckets):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"edges_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({EDGE}) USING parquet"
            f" CLUSTERED BY (cited) SORTED BY (cited) INTO {buckets} BUCKETS LOCATION '{path}/cold'"
        )

    @property
    def cold(self):
        return self.spark.table(self.table)

    @property
    def hot(self):
        return self.spark.read.schema(EDGE).parquet(f"{self.path}/hot")

    @property
    def hot_ids(self):
        return self.spark.read.schema("cited STRING").parquet(f"{self.path}/hot-ids").distinct()

    def append(self, edges, hot_rows=settings.HOT_ROWS):
        """Add edges (citing, cited) as new files; nothing written before is touched.

        Ids of more than `hot_rows` edges in this batch, or known as hot, are kept
        apart from the buckets: a bucket is one task's work. Edges without one of the ids are left
        out; an edge may be added twice, lookups return it once.
        """
        edges = stage(edges.select("citing", "cited").where("citing IS NOT NULL AND cited IS NOT NULL").distinct(), "edges")
        counted = edges.groupBy("cited").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select("cited")
        fresh = stage(counted.join(small(self.hot_ids), "cited", "left_anti"), "fresh")
        # At most one id per `hot_rows` edges of a batch.
        fresh.write.mode("append").parquet(f"{self.path}/hot-ids")
        hot = small(self.hot_ids)
        edges.join(hot, "cited", "left_semi").select("citing", "cited").write.mode("append").parquet(f"{self.path}/hot")
        cold = edges.join(hot, "cited", "left_anti").select("citing", "cited")
        cold = cold.repartition(self.buckets, "cited")
        cold.write.mode("append").format("parquet").bucketBy(self.buckets, "cited").sortBy("cited").saveAsTable(self.table)
        self.spark.catalog.refreshTable(self.table)
        return self

    def links(self, ids, rows=settings.BROADCAST_ROWS):
        """The distinct edges that cite one of `ids` (id)."""
        keys = stage(ids.select(F.col("id").cast("string").alias("cited")).where("cited IS NOT NULL").distinct(), "keys")
        hot = small(stage(self.hot_ids.join(small(keys, rows), "cited", "left_semi"), "hot-keys"))
        wanted = F.broadcast(keys) if fits(keys, rows) else keys.hint("merge")
        found = self.cold.join(wanted, "cited", "left_semi")
        return found.unionByName(self.hot.join(hot, "cited", "left_semi")).select("citing", "cited").distinct()

    def citing(self, ids, rows=settings.BROADCAST_ROWS):
        """Ids of all works that cite one of `ids`, each once."""
        return self.links(ids, rows).select(F.col("citing").alias("id")).distinct()

    def snowball(self, seeds, review, rows=settings.BROADCAST_ROWS):
        """As `citations.snowball`, both hops by lookup."""
        primary = stage(self.citing(seeds, rows), "primary")
        secondary = self.citing(primary, rows)
        both = primary.withColumn("hop", F.lit(1)).unionByName(secondary.withColumn("hop", F.lit(2)))
        found = both.groupBy("id").agg(F.min("hop").alias("hop"))
        known = review.select("id").where("id IS NOT NULL").distinct()
        level = F.when(F.col("hop") == 1, "primary").otherwise("secondary")
        return found.join(known, "id", "left_anti").select("id", level.alias("level"))


def create_index(spark, path, edges, buckets, hot_rows=settings.HOT_ROWS):
    """Write `edges` as a new index below `path`."""
    empty = spark.createDataFrame([], EDGE)
    empty.write.parquet(f"{path}/hot")
    empty.select("cited").write.parquet(f"{path}/hot-ids")
    return CitationIndex(spark, path, buckets).append(edges, hot_rows)
