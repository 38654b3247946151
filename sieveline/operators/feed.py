"""Selecting, checking and keeping the latest vectors per work."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.vectors import vector_fault
from sieveline.settings import BROADCAST_ROWS, MIN_YEAR, VECTOR_DIM
from sieveline.staging import fits, plain_scan, stage

PART_KEYS = ("updated_date", "part")


def recent(embeddings, metadata=None, min_year=MIN_YEAR, on=("id", *PART_KEYS), year="publication_year"):
    """Vectors of works published in or after `min_year`; an unknown year is out.

    Vectors written with their year, as `write_parts` does, are filtered in
    the scan. Else the year comes from the metadata: that table is filtered
    first and the wide vectors are joined to what is left of it.
    """
    if metadata is None:
        return embeddings.filter(F.col(year) >= min_year)
    kept = metadata.filter(F.col(year) >= min_year).select(*on)
    return embeddings.join(kept, list(on), "left_semi")


def split_valid(rows, dim=VECTOR_DIM, id_col="id", vector_col="embedding"):
    """Rows that can be stored and searched, and the others with the reason why not."""
    reason = F.when(F.col(id_col).isNull(), "missing id").otherwise(vector_fault(vector_col, dim))
    judged = rows.withColumn("reason", reason)
    accepted = judged.filter(F.col("reason").isNull()).drop("reason")
    return accepted, judged.filter(F.col("reason").isNotNull())


def keep_latest(rows, key="id", order=PART_KEYS, bound=BROADCAST_ROWS):
    """The last version of each key by `order`; equal versions by content.

    A maximum combines on the map side, so a key with very many versions
    costs no more than others. Rows with vectors are wide, so their versions
    are compared without them first: if the keys with several versions are
    few, older ones are dropped in place and only equal last versions are
    shuffled. Rows without a key are no version of anything and left out;
    `split_valid` reports them. Rows that are more than a filtered scan are
    staged, as they are read several times.
    """
    rows = rows.where(F.col(key).isNotNull())
    if not any(isinstance(field.dataType, T.ArrayType) for field in rows.schema):
        return _last(rows, key, order)
    rows = rows if plain_scan(rows) else stage(rows, "versions")
    versions = rows.groupBy(key).agg(F.count("*").alias("_n"), F.max(F.struct(*order)).alias("_last"))
    repeated = stage(versions.filter(F.col("_n") > 1).select(F.col(key).alias("_key"), "_last"), "repeated")
    if not fits(repeated, bound):
        return _last(rows, key, order)
    repeated, same = F.broadcast(repeated), F.col(key) == F.col("_key")
    single = rows.join(repeated, same, "left_anti")
    several = rows.join(repeated, same & F.struct(*order).eqNullSafe(F.col("_last")), "left_semi")
    return single.unionByName(_last(several, key, order))


def _last(rows, key, order):
    rest = [name for name in rows.columns if name != key and name not in order]
    last = rows.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("last"))
    return last.select(key, *[F.col("last")[name].alias(name) for name in (*order, *rest)])


def fed_counts(rows, by=PART_KEYS):
    """Rows per part file and in all, by grouping sets."""
    return rows.rollup(*by).agg(F.count("*").alias("n_rows"))
