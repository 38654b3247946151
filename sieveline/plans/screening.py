"""The screening datasets composed from the operators."""

from pyspark.sql import functions as F

from sieveline import settings
from sieveline.functions.text import full_id
from sieveline.operators import candidates, citations, master, rerank
from sieveline.operators.neighbors import with_vectors
from sieveline.staging import stage

CITATION_COLUMNS = ("id", "doi", "title", "abstract", "referenced_works", "publication_date")


def criteria_dataset(criteria_hits, works, cut=settings.CUT_CRITERIA, merged=None):
    """Dataset A: the works closest to the inclusion criteria."""
    ranked = stage(candidates.cut(criteria_hits, cut).select("id", "rank"), "ranked")
    return _at_edge(candidates.ranked_dataset(ranked, works, "rank", merged=merged))


def included_dataset(hits, works, cut=settings.CUT_INCLUDED, merged=None, ordered=True):
    """Dataset B: the pooled tops of all lists, each work once."""
    ranked = stage(candidates.keep_first(candidates.cut(hits, cut)).select("id", "rank"), "ranked")
    return _at_edge(candidates.ranked_dataset(ranked, works, "rank", merged=merged, ordered=ordered))


def reranked_pool(hits, corpus, training, cut=settings.CUT_RERANK_POOL, keep=settings.RERANK_KEEP, fit=None):
    """The `keep` works of a deeper pool that a classifier scores highest.

    `training` has embedding and label_included. `fit` makes of it a function
    that adds `relevance_score`; by default the balanced logistic model.
    """
    pool = stage(candidates.keep_first(candidates.cut(hits, cut)), "pool")
    featured = with_vectors(pool, corpus, pool.count())
    scored = (fit or rerank.logistic)(training)(featured).select("id", "relevance_score")
    return stage(rerank.top_scored(scored, keep), "reranked")


def reranked_dataset(pool, works, merged=None):
    """Dataset C: the re-ranked pool with the columns of its works."""
    return _at_edge(candidates.ranked_dataset(pool, works, "relevance_score", descending=True, merged=merged))


def update_master(table, hits, works, cut=settings.CUT_MASTER):
    """The master table with the pooled tops of all lists added and flagged."""
    return master.upsert(table, included_dataset(hits, works, cut, ordered=False))


def citation_dataset(edges, works, included, review, columns=CITATION_COLUMNS):
    """All works found by snowballing with their level, and their columns where the work is known.

    `candidates.unresolved` gives the ids no work is found for.
    """
    found = stage(citations.snowball(edges, included, review), "snowball")
    return _at_edge(found.join(works.select(*columns), "id", "left").select(*columns, "level"))


def _at_edge(dataset):
    return dataset.withColumn("id", full_id(F.col("id")))
