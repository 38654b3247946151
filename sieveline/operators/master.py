"""Membership flags and upserts of a labelled master table."""

from pyspark.sql import functions as F

from sieveline import settings
from sieveline.functions.text import master_id, numeric_suffix
from sieveline.staging import join_known, number_rows, small, stage


def flag_members(rows, others, name, on="id", other_on="id"):
    """Add `name`: the key occurs in `others`. Null keys are in no table."""
    keys = others.select(F.col(other_on).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    keys = small(keys).select(F.col("_key").alias(on), F.lit(True).alias(name))
    return join_known(rows, keys, on).withColumn(name, F.coalesce(name, F.lit(False)))


def coverage(rows, flag):
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(flag).alias("n_members"))


def coalesce_columns(df, pairs):
    """Fill nulls of each column from its fallback, then drop the fallbacks."""
    filled = df.withColumns({col: F.coalesce(col, fallback) for col, fallback in pairs.items()})
    return filled.drop(*pairs.values())


def fill_flags(df, flags=settings.MASTER_FLAGS):
    return df.fillna(0, [flag for flag in flags if flag in df.columns])


def max_number(master):
    return master.agg(F.max(numeric_suffix("MID")).alias("max_mid"))


RENAMED = {settings.MASTER_OLD_FLAG: "Data_3b_old"}


def upsert(
    master,
    incoming,
    flag="Data_3b",
    flags=settings.MASTER_FLAGS,
    key="openalex_id",
    order=("rank", "id"),
    renamed=RENAMED,
):
    """Add ranked candidates to the master table and set `flag` on them.

    Known works keep their own doi, title and abstract where present. New ones
    are appended and get ids M<n> counted on from the largest number; counting
    runs over all incoming rows in rank order, so known ones leave gaps.
    Incoming rows have one row per id; master rows without a key never match.
    Only ids and ranks are sorted; the incoming texts are staged once.
    """
    master = master.withColumnsRenamed(renamed)
    master = master if flag in master.columns else master.withColumn(flag, F.lit(None).cast("int"))
    first = max_number(master)
    sort = (F.col(order[0]).asc_nulls_last(), *order[1:])
    incoming = stage(incoming.select(*dict.fromkeys(["id", "doi", "title", "abstract", *order])), "incoming")
    numbers = number_rows(incoming.select(*dict.fromkeys(["id", *order])), "_n", *sort, start=1).select("id", "_n")
    numbered = incoming.join(numbers, "id").select(
        F.col("id").alias(key),
        F.col("doi").alias("_doi"),
        F.col("title").alias("_title"),
        F.col("abstract").alias("_abstract"),
        master_id(F.coalesce(first.scalar(), F.lit(0)) + F.col("_n")).alias("_mid"),
        F.lit(1).alias("_flag"),
    )
    extra = {"MID": "_mid", "doi": "_doi", "title": "_title", "abstract": "_abstract", flag: "_flag"}
    marked = join_known(master, numbered, key).withColumn(flag, F.coalesce("_flag", flag))
    known = coalesce_columns(marked, extra)
    held = master.select(key).filter(F.col(key).isNotNull()).distinct()
    new = numbered.join(held, key, "left_anti").withColumnsRenamed({v: k for k, v in extra.items()})
    return fill_flags(known.unionByName(new, allowMissingColumns=True), flags)
