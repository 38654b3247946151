"""Where the records of a labelled table were found by each search method."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.functions.text import short_id
from sieveline.operators.responses import lowest_ranks, rank_counts
from sieveline.staging import join_known, number_rows


def rank_lists(hits):
    """Per id all (rank, query_id) in list order, and the best of them.

    The best is the lowest rank; of equal ranks the first list wins. An id
    has at most one entry per result list.
    """
    entry = F.struct("query_pos", "rank", "query_id")
    best = F.min(F.struct("rank", "query_pos", "query_id"))
    grouped = hits.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("entries"), best.alias("best"))
    return grouped.select(
        "id",
        F.transform("entries", lambda e: F.struct(e["rank"].alias("rank"), e["query_id"].alias("query_id"))).alias(
            "inclusions_recall_data"
        ),
        F.col("best.rank").alias("inclusions_min_rank"),
        F.col("best.query_id").alias("inclusions_min_rank_id"),
    )


def best_rank(hits):
    """Lowest rank per id and the first list that gives it."""
    best = F.min(F.struct("rank", "query_pos", "query_id")).alias("best")
    return hits.groupBy("id").agg(best).select(
        "id",
        F.col("best.rank").alias("min_rank"),
        F.col("best.query_id").alias("min_rank_id"),
    )


def dataset_positions(dataset, score="relevance_score"):
    """Position from 0 of each row of a re-ranked dataset, of any size."""
    return number_rows(dataset.select("id", score), "position", F.col(score).desc_nulls_last(), "id")


def attribute(master, hits, criteria_hits, similarity, criteria_similarity, reranked=None, key="openalex_id"):
    """Add the recall columns to a master table.

    `hits` and `criteria_hits` carry short ids, `similarity` has the master's
    MID with query_id and similarity, `criteria_similarity` MID and
    criteria_similarity, `reranked` full ids with relevance_score. Records
    found nowhere keep nulls.
    """
    lists = rank_lists(hits).withColumnRenamed("id", "short_id")
    criteria = criteria_hits.select(F.col("id").alias("short_id"), F.col("rank").alias("criteria_rank"))
    nearest = similarity.select(
        "MID",
        F.col("similarity").alias("inclusions_similarity"),
        F.col("query_id").alias("inclusions_most_similar"),
    )
    found = lists.join(criteria, "short_id", "full")
    table = (
        join_known(master.withColumn("short_id", short_id(key)), found, "short_id")
        .drop("short_id")
        .join(nearest, "MID", "left")
        .join(criteria_similarity, "MID", "left")
    )
    if reranked is None:
        return table
    placed = dataset_positions(reranked).select(
        F.col("id").alias(key),
        F.col("relevance_score").alias("logistic_score"),
        F.col("position").cast("int").alias("logistic_rank"),
    )
    return join_known(table, placed, key)


def recall_curve(hits, relevant, depth=None):
    """Relevant ids found at rank <= n for every n, also as a share of all.

    There are as many n as `hits` has ranks, or `depth`.
    """
    wanted = relevant.select("id").filter(F.col("id").isNotNull()).distinct()
    lowest, depth = lowest_ranks(hits, depth)
    lowest = lowest.join(wanted, "id", "left_semi")
    total = wanted.agg(F.count("*").alias("n_relevant"))
    running = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rank_counts(lowest, depth)
        .select("rank", F.sum("n").over(running).alias("n_found"), total.scalar().alias("n_relevant"))
        .withColumn("recall", F.col("n_found") / F.col("n_relevant"))
    )
