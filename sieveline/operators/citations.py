"""Citing works and two-hop snowballing over citation edges."""

from pyspark.sql import functions as F

from sieveline import settings
from sieveline.staging import semi_join_hot, stage


def citation_edges(works, id_col="id", references="referenced_works"):
    """One row (citing, cited) per entry of the reference lists."""
    return works.select(F.col(id_col).alias("citing"), F.explode(references).alias("cited"))


def citation_links(edges, ids, rows=settings.BROADCAST_ROWS):
    """The edges that cite one of `ids`, as distinct (citing, cited) pairs."""
    keys = ids.select(F.col("id").alias("cited")).distinct()
    return semi_join_hot(edges, keys, "cited", rows).distinct()


def citing_works(edges, ids, rows=settings.BROADCAST_ROWS):
    """Ids of all works that cite one of `ids`, each once.

    A much-cited work is no bottleneck: a small set of ids is broadcast, and
    beyond the bound the edges of much-cited works are picked in place.
    Repeated citing works collapse before the shuffle.
    """
    return _citing(edges, ids.select("id").distinct(), rows)


def _citing(edges, distinct_ids, rows):
    keys = distinct_ids.withColumnRenamed("id", "cited")
    found = semi_join_hot(edges, keys, "cited", rows)
    return found.select(F.col("citing").alias("id")).distinct()


def snowball(edges, seeds, review, rows=settings.BROADCAST_ROWS):
    """Works citing a seed (`primary`) or citing such a work (`secondary`).

    A work found both ways stays primary. The second hop starts from all
    primary works; works of the review are removed at the end only.
    """
    primary = stage(citing_works(edges, seeds, rows), "primary")
    secondary = _citing(edges, primary, rows)
    both = primary.withColumn("hop", F.lit(1)).unionByName(secondary.withColumn("hop", F.lit(2)))
    found = both.groupBy("id").agg(F.min("hop").alias("hop"))
    known = review.select("id").filter(F.col("id").isNotNull()).distinct()
    level = F.when(F.col("hop") == 1, "primary").otherwise("secondary")
    return found.join(known, "id", "left_anti").select("id", level.alias("level"))


def level_summary(citations, since, year="publication_year"):
    """Counts per level over all works and over those from `since` on."""
    recent = F.col(year) >= since
    counts = {}
    for scope, keep in (("all", F.lit(True)), ("since", recent)):
        counts[f"{scope}_total"] = F.count_if(keep)
        for level in ("primary", "secondary"):
            counts[f"{scope}_{level}"] = F.count_if(keep & (F.col("level") == level))
    one = citations.agg(*[value.alias(name) for name, value in counts.items()])
    return one.selectExpr(
        "stack(2, 'all', all_total, all_primary, all_secondary,"
        " 'since', since_total, since_primary, since_secondary)"
        " AS (scope, total, primary, secondary)"
    )
