"""Overlap and novelty of ranked result lists."""

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline import settings
from sieveline.staging import join_hot, stage


def distinct_ids(hits):
    return hits.agg(F.count_distinct("id").alias("n_ids"))


def frequency(hits):
    """Number of lists each id occurs in, most frequent first."""
    return hits.groupBy("id").agg(F.count("*").alias("n_responses")).orderBy(F.desc("n_responses"), "id")


def frequency_histogram(hits):
    """Number of ids that occur in exactly n lists."""
    per_id = hits.groupBy("id").agg(F.count("*").alias("n_responses"))
    return per_id.groupBy("n_responses").agg(F.count("*").alias("n_records")).orderBy(F.desc("n_responses"))


def lowest_ranks(hits, depth=None):
    """(id, rank) with each id at its lowest rank, and the number of ranks there are.

    That is one more than the highest rank of `hits`, or `depth` if it is given;
    hits beyond it are an error, as they would be lost.
    """
    ranks = hits.groupBy("id").agg(F.min("rank").alias("rank"), F.max("rank").alias("_deepest"))
    ranks = stage(ranks, "ranks")
    deepest = ranks.agg(F.max("_deepest")).first()[0]
    found = 0 if deepest is None else deepest + 1
    if depth is not None and found > depth:
        raise ValueError(f"there are hits at rank {deepest}, beyond a depth of {depth}")
    return ranks.drop("_deepest"), found if depth is None else depth


def rank_counts(ranks, depth, rank="rank"):
    """Dense (rank, n) over 0..depth-1 from one rank per row."""
    counts = ranks.groupBy(rank).agg(F.count("*").alias("n"))
    domain = ranks.sparkSession.range(depth).select(F.col("id").cast("int").alias(rank))
    return domain.join(counts, rank, "left").select(rank, F.coalesce("n", F.lit(0)).alias("n"))


def discovery_curve(hits, depth=None):
    """Per rank the distinct ids up to it and those new at it.

    The first new_ids is 0 by definition. Each id counts at its lowest rank,
    so one aggregation serves all ranks; the running sum is over `depth` rows,
    by default as many as the hits have ranks.
    """
    lowest, depth = lowest_ranks(hits, depth)
    running = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return rank_counts(lowest, depth).select(
        "rank",
        F.sum("n").over(running).alias("n_ids"),
        F.when(F.col("rank") == 0, F.lit(0)).otherwise(F.col("n")).cast("long").alias("new_ids"),
    )


def choose_cutoff(hits, target, depth=None):
    """The rank cuts whose pooled lists come nearest to `target` ids.

    A cut n keeps ranks below n. Returns the largest cut with at most
    `target` ids and the smallest with at least `target`, with their sizes;
    null where there is none.
    """
    curve = discovery_curve(hits, depth).select((F.col("rank") + 1).alias("cut"), "n_ids")
    at_most = F.when(F.col("n_ids") <= target, F.col("cut"))
    at_least = F.when(F.col("n_ids") >= target, F.col("cut"))
    return curve.agg(
        F.max(at_most).alias("cut_at_most"),
        F.max(F.when(F.col("n_ids") <= target, F.col("n_ids"))).alias("ids_at_most"),
        F.min(at_least).alias("cut_at_least"),
        F.min(F.when(F.col("n_ids") >= target, F.col("n_ids"))).alias("ids_at_least"),
    )


def overlap(hits, lists):
    """Number of common ids for every two of the result lists.

    `lists` has the query_pos of every list. Each id is turned into one 0/1
    vector of the lists that contain it; adding these vectors per list gives
    the rows of the matrix without producing any pair of hits. Beyond MOST_LISTS
    lists, whose names and totals are held whole, that is an error; common_ids()
    has no such bound.
    """
    found = lists.select("query_pos").distinct().orderBy("query_pos").limit(settings.MOST_LISTS + 1).collect()
    if len(found) > settings.MOST_LISTS:
        raise ValueError(f"more than {settings.MOST_LISTS} lists: compare them in parts")
    names = [str(row.query_pos) for row in found]
    marks = CountVectorizerModel.from_vocabulary(names, inputCol="names", outputCol="marks", minTF=1.0)
    per_id = hits.groupBy("id").agg(F.collect_set(F.col("query_pos").cast("string")).alias("names"))
    rows = marks.transform(per_id).select(F.explode("names").alias("name"), "marks")
    totals = rows.groupBy("name").agg(vector_to_array(Summarizer.sum(F.col("marks"))).alias("totals"))
    labels = F.array(*[F.lit(int(name)) for name in names])
    return totals.select(
        F.col("name").cast("long").alias("query_a"),
        F.posexplode("totals").alias("n", "common"),
    ).select(
        "query_a",
        F.element_at(labels, F.col("n") + 1).cast("long").alias("query_b"),
        F.col("common").cast("long").alias("n_common"),
    )


def common_ids(hits, lists):
    """overlap() for any number of lists: beyond MOST_LISTS by overlap_in_blocks()."""
    few = lists.select("query_pos").distinct().limit(settings.MOST_LISTS + 1).count() <= settings.MOST_LISTS
    return overlap(hits, lists) if few else overlap_in_blocks(hits, lists)


def overlap_in_blocks(hits, lists):
    """overlap() by counts of the pairs of lists that share an id.

    Lists are dealt by hash into blocks of about LIST_BLOCK. An id has one row per
    block, with its lists there; each row meets those of the same id in other blocks, so no
    id's lists and no list's totals are held whole. Pairs are counted before the
    shuffle. Those that share nothing get 0.
    """
    names = stage(lists.select("query_pos").distinct(), "lists")
    blocks = max(1, -(-names.count() // settings.LIST_BLOCK))
    block = F.pmod(F.xxhash64(F.col("query_pos").cast("long")), F.lit(blocks)).cast("int")
    hits = hits.select("id", F.col("query_pos").cast("long").alias("query_pos"))
    counts = _meetings(hits, block).groupBy("query_a", "query_b").agg(F.count("*").alias("n_common"))
    # Every two lists, by the pair of their blocks.
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    firsts = hits.select("query_pos").distinct().select(F.col("query_pos").alias("query_a"), block.alias("block_a"), every.alias("block_b"))
    seconds = names.select(F.col("query_pos").cast("long").alias("query_b"), block.alias("block_b"), every.alias("block_a"))
    grid = firsts.join(seconds, ["block_a", "block_b"]).select("query_a", "query_b")
    return grid.join(counts, ["query_a", "query_b"], "left").select(
        "query_a", "query_b", F.coalesce("n_common", F.lit(0)).cast("long").alias("n_common")
    )


def _meetings(hits, block):
    """(query_a, query_b) once for each id that two lists share, by blocks of the lists of an id."""
    per_block = stage(hits.groupBy("id", block.alias("block")).agg(F.collect_set("query_pos").alias("names")), "blocks")
    met = per_block.groupBy("id").agg(F.collect_list("block").alias("others"))
    own = per_block.alias("p").join(met.alias("m"), F.col("p.id").eqNullSafe(F.col("m.id")))
    own = own.select(F.col("p.id").alias("own_id"), F.col("p.names").alias("a"), F.explode("others").alias("other"))
    both = own.join(per_block, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("other") == F.col("block")))
    return both.select(F.explode("a").alias("query_a"), "names").select("query_a", F.explode("names").alias("query_b"))


def large_overlaps(hits, least):
    """(query_a, query_b, n_common) of the lists, query_a < query_b, that have at least `least` ids in common.

    An id counts once per list; null ids and null lists count nowhere. Lists that
    share nothing much are never paired, not even over ids that all lists have: with the ids of
    each list ordered by the number of lists that have them, two lists with
    `least` common ids share one that neither has among its last `least` - 1. So
    lists meet over their rarest ids, by blocks, and only those that met
    are counted in full. The result is exact and holds no zeros.
    """
    if least < 1:
        raise ValueError("lists are paired by at least one common id")
    hits = hits.select("id", F.col("query_pos").cast("long").alias("query_pos"))
    hits = stage(hits.where("id IS NOT NULL AND query_pos IS NOT NULL").distinct(), "entries")
    counted = hits.groupBy("id").agg(F.count("*").alias("n_lists"))
    hits = stage(join_hot(hits, counted, "id"), "counted")
    # Ids of a list found in as many lists are one class; one row per class.
    classes = hits.groupBy("query_pos", "n_lists").agg(F.count("*").alias("n"))
    own = Window.partitionBy("query_pos")
    before = own.orderBy("n_lists").rowsBetween(Window.unboundedPreceding, -1)
    placed = classes.select(
        "query_pos", "n_lists", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(own).alias("all")
    )
    # Whole classes are kept up to the one with the last id needed.
    cuts = placed.where(F.col("before") <= F.col("all") - least).groupBy("query_pos").agg(F.max("n_lists").alias("last"))
    rare = join_hot(hits, cuts, "query_pos").where(F.col("n_lists") <= F.col("last")).select("id", "query_pos")
    blocks = max(1, -(-cuts.count() // settings.LIST_BLOCK))
    block = F.pmod(F.xxhash64("query_pos"), F.lit(blocks)).cast("int")
    met = stage(_meetings(rare, block).where("query_a < query_b").distinct(), "met")
    firsts = hits.select("id", F.col("query_pos").alias("query_a")).join(met, "query_a")
    seconds = hits.select("id", F.col("query_pos").alias("query_b"))
    common = firsts.join(seconds, ["id", "query_b"], "left_semi").groupBy("query_a", "query_b")
    return common.agg(F.count("*").alias("n_common")).where(F.col("n_common") >= least)


def membership(rows, others, by):
    """Per list the distinct ids, and how many of them each other table has.

    `others` maps a column name to a table with an id column.
    """
    # All tables are tagged and meet in one grouping by id.
    tags = {name: n + 1 for n, name in enumerate(others)}
    tagged = rows.select("id", F.col(by).alias("_by"), F.lit(0).alias("_tag"))
    for name, other in others.items():
        nothing = F.lit(None).cast(rows.schema[by].dataType)
        tagged = tagged.unionByName(other.select("id", nothing.alias("_by"), F.lit(tags[name]).alias("_tag")))
    own, tag = F.collect_set(F.when(F.col("_tag") == 0, F.struct("_by"))), F.col("_tag")
    marks = [F.max((tag == tags[name]).cast("int")).alias(name) for name in others]
    per_id = tagged.filter(F.col("id").isNotNull()).groupBy("id").agg(own.alias("_lists"), *marks)
    per_list = per_id.select(F.explode("_lists").alias("_list"), *others).groupBy(F.col("_list._by").alias(by))
    return per_list.agg(F.count("*").alias("n_ids"), *[F.sum(name).cast("long").alias(name) for name in others])


def count_members(hits, other):
    """Distinct ids of `hits` that also occur in `other`."""
    keys = other.select("id").distinct()
    return hits.join(keys, "id", "left_semi").agg(F.count_distinct("id").alias("n_ids"))
