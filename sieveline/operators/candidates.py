"""Candidate datasets: cut, dedupe, enrich and order ranked hits."""

from pyspark.sql import functions as F

from sieveline.functions.text import rebuild_abstract
from sieveline.staging import small

WORK_COLUMNS = ("id", "doi", "title", "abstract")
INDEX = "abstract_inverted_index"


def cut(hits, n):
    return hits.filter(F.col("rank") < n)


def keep_first(hits):
    """One row per id with the rank in the first query list that contains it.

    This is the first list by query_pos, not the list with the lowest rank.
    An id occurs once per list, so both aggregates see the same row.
    """
    return hits.groupBy("id").agg(
        F.min("query_pos").alias("query_pos"), F.min_by("rank", "query_pos").alias("rank")
    )


def resolve(ids, merged=None):
    """Ids under which works are found now; `merged` maps old_id to new_id."""
    keys = ids.select("id").distinct()
    if merged is None:
        return keys
    renamed = keys.join(merged.select(F.col("old_id").alias("id"), "new_id"), "id", "left")
    return renamed.select(F.coalesce("new_id", "id").alias("id")).distinct()


def enrich(ids, works, columns=WORK_COLUMNS, merged=None):
    """The given columns of the works with these ids.

    The ids are counted; within the broadcast bound the works are filtered in
    place. Works that hold an inverted index give `abstract` from it.
    """
    keys = small(resolve(ids, merged))
    if "abstract" not in columns or "abstract" in works.columns:
        return works.select(*columns).join(keys, "id", "left_semi")
    kept = works.select(*[INDEX if name == "abstract" else name for name in columns]).join(keys, "id", "left_semi")
    return kept.select(*[rebuild_abstract(INDEX).alias(name) if name == "abstract" else name for name in columns])


def unresolved(ids, works):
    """Ids that no work is found for."""
    return ids.select("id").distinct().join(works.select("id"), "id", "left_anti")


def ranked_dataset(ranked, works, value, descending=False, columns=WORK_COLUMNS, merged=None, ordered=True):
    """Work columns plus `value`, in its order with nulls last, then by id.

    Starts from the works found: one that is found under another id than the
    ranked one has a null value and comes last.
    """
    found = enrich(ranked, works, columns, merged).join(small(ranked.select("id", value)), "id", "left")
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return found.orderBy(order, "id") if ordered else found


def preview(df, *order, n=5):
    return df.orderBy(*order).limit(n)
