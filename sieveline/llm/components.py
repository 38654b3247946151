"""Connected components of a table of links."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sieveline.staging import stage

# A task holds the nodes of so many links.
TASK_LINKS = 250_000


class Sets:
    """Union of ids; each set goes by its smallest id."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, ids):
        roots = sorted(set(map(self.find, ids)))
        for root in roots[1:]:
            self.parent[root] = roots[0]
        return roots[0]

    def links(self):
        """(smallest, other) of every id that is not the smallest of its set, as two columns."""
        ids = np.array([(self.find(x), x) for x in self.parent if self.find(x) != x], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1])], ["a", "b"])


def _joined(batches):
    """The links of one task as stars: as many links as nodes at most, and no chain."""
    sets = Sets()
    for batch in batches:
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.join(pair)
    yield sets.links()


def _arcs(links):
    """Every link in both directions."""
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _mark(links):
    """Count and order-free sum of hashes: equal tables have equal marks."""
    hashed = F.xxhash64("a", "b")
    row = links.agg(F.count("*").alias("n"), F.sum(hashed.bitwiseAND(F.lit(2**40 - 1))).alias("s")).first()
    return row["n"], row["s"]


def components(links, task_links=TASK_LINKS):
    """(node, component) for all nodes of `links` (a, b); the component is its smallest node.

    First each task joins the links it reads, `task_links` at most, to stars. As
    long as there are several tasks, large and small stars then take turns: each
    node hooks its larger, then its smaller neighbours to the smallest one it
    knows, until nothing changes, which takes about log2 of the longest shortest
    path rounds. Every round is a few aggregates with map-side combine and joins
    on table rows, staged in the shared folder; a node may have any number of
    links. Links of a node with itself or with null are ignored; no links give no
    rows.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    links = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    tasks = -(-links.count() // task_links)
    links = stage(links.coalesce(max(1, tasks)).mapInArrow(_joined, "a long, b long"), "links")
    mark = _mark(links) if tasks > 1 else None
    while mark:
        least = _arcs(links).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = _arcs(links).join(least, "a").where("b > a").select(F.col("least").alias("a"), "b")
        # Links now run from a smaller to a larger node: b sees its smaller neighbours a.
        least = large.groupBy("b").agg(F.min("a").alias("least"))
        small = large.join(least, "b")
        small = small.select(F.col("least").alias("a"), F.col("a").alias("b")).union(small.select(F.col("least").alias("a"), "b"))
        links = stage(small.where("a < b").distinct(), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    found = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return found.union(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
