"""Seed selection from a labelled review."""

from pyspark.sql import functions as F

from sieveline.functions.text import matches_doi
from sieveline.settings import EXCLUDED_DOIS


def mark_excluded(review, dois=EXCLUDED_DOIS, regex=False):
    """Add `extra_excluded`: the DOI matches one of the excluded DOIs."""
    return review.withColumn("extra_excluded", matches_doi("doi", dois, regex))


def included(review, dois=EXCLUDED_DOIS, regex=False):
    """Rows labelled as included and not excluded afterwards."""
    marked = mark_excluded(review, dois, regex)
    return marked.filter((F.col("label_included") != 0) & ~F.col("extra_excluded"))


def relabel_excluded(review, dois=EXCLUDED_DOIS, regex=False, first_only=True, order="id"):
    """Set `label_included` to 0 for excluded DOIs, for use as training labels.

    With `first_only` each DOI relabels its first match by `order` alone, and
    a DOI without any match is an error; else every match is relabelled.
    """
    if not first_only:
        hit = matches_doi("doi", dois, regex)
        return review.withColumn("label_included", F.when(hit, 0).otherwise(F.col("label_included")))
    firsts = review.agg(
        *[F.min(F.when(matches_doi("doi", [doi], regex), F.col(order))).alias(f"m{n}") for n, doi in enumerate(dois)]
    ).first()
    missing = [doi for doi, key in zip(dois, firsts) if key is None]
    if missing:
        raise ValueError(f"no review record for excluded DOIs {missing}")
    hit = F.col(order).isin(list(firsts))
    return review.withColumn("label_included", F.when(hit, 0).otherwise(F.col("label_included")))
