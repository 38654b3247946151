"""Mixing sources to target weights by weighted fair queueing."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.llm.tables import row_hash, running, text_of, words
from sieveline.staging import small, stage

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def n_words(text):
    return F.size(words(text)).cast("long")


def source_targets(sizes, weights=WEIGHTS, repeats=MOST_REPEATS, share=1.0):
    """Target per source: (source, source_size, target) from rows (source, size).

    Sources weigh `weights` in turn, by code point of their name, null last. They
    share `share` of all sizes; a target stops at `repeats` times the size of its
    source and the excess goes to the others by weight, until none is above. In
    order of size for weight the sources that stop are the first ones, so the
    level of the others follows from running sums. Sources without words get 0.
    Its windows sort one row per source.
    """
    # Strings compare by UTF-8 bytes, which is code point order.
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.array(*map(F.lit, weights))[F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))]
    limit = F.lit(repeats) * F.col("source_size")
    filling = Window.orderBy(limit / F.col("weight"), F.col("source").isNull(), "source")
    all_rows = Window.partitionBy()
    before = F.coalesce(F.sum(limit).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(all_rows) * F.lit(share) - before) / others
    level_if = F.when(level * F.col("weight") <= limit, level)
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight.cast("double"))
        .withColumn("_level", level_if)
        # The first source that does not stop sets the level; those of later ones are no higher.
        .withColumn("_level", F.max("_level").over(all_rows))
        .select("source", "source_size", F.least(F.col("_level") * F.col("weight"), limit.cast("double")).alias("target"))
        .withColumn("target", F.coalesce("target", F.lit(repeats) * F.col("source_size").cast("double")))
    )


def fair_mix(docs, weights=WEIGHTS, repeats=MOST_REPEATS, share=1.0, seed=0):
    """What the mix takes of each row of `docs`: (doc_id, row, size, source, source_size, target, copies, taken).

    Every source is shuffled by a keyed hash and read up to `repeats` times over.
    A copy's virtual finish time is the words its source has given when it ends,
    divided by the source's target (weight after caps). Copies are sorted by
    finish time over all sources and cut where their words reach the budget,
    `share` of all words; the copy that reaches it is the last one taken.
    Running sums go by range partitions, so a source may hold any share of the
    rows. Every row comes back; rows of no words have 0 copies.

    Null text has size 0; a null source is a source; ties in time are ordered by
    hash and doc_id. Rows equal in doc_id, source and text are one entry of the
    queue and taken alike. An empty table gives an empty mix.
    """
    text = text_of(docs)
    entry = ["doc_id", "row", "source", "size", "key"]
    rows = (
        docs.select(
            docs["doc_id"].alias("doc_id"),
            row_hash(docs).alias("row"),
            docs["source"].alias("source"),
            n_words(text).alias("size"),
            F.xxhash64(F.lit(seed), docs["doc_id"], text).alias("key"),
        )
        .groupBy(*entry)
        .agg(F.count("*").alias("rows"))
        .withColumn("total", F.col("size") * F.col("rows"))
    )
    rows = stage(rows, "sized")
    sizes = rows.select("source", F.col("total").alias("size"))
    targets = stage(source_targets(sizes, weights, repeats, share), "targets")
    number = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    targets = targets.withColumn("start", F.coalesce(F.sum("source_size").over(number), F.lit(0)))
    targets = targets.withColumnRenamed("source", "_source")
    known = stage(rows.join(small(targets), rows["source"].eqNullSafe(F.col("_source"))).drop("_source"), "known")
    order = [F.col("source").isNull(), "source", "key", "doc_id", "row"]
    # Words the source has given with this row, in its first pass.
    first = running(known, order, {"given": "total"}).withColumn("given", F.col("given") - F.col("start"))
    queued = (
        first.where("size > 0 AND target > 0")
        .select("doc_id", "row", "source", "key", "total", "target", "source_size", "given", _passes(repeats))
        .withColumn("given", F.col("given") + F.col("pass") * F.col("source_size"))
        # Copies that begin after their source's target cannot be reached.
        .where(F.col("given") - F.col("total") < F.col("target"))
        .select((F.col("given") / F.col("target")).alias("finish"), "key", "doc_id", "row", "source", "total")
    )
    budget = targets.agg((F.sum("source_size") * F.lit(share)).alias("budget")).scalar()
    order = ["finish", "key", "doc_id", "row", "source"]
    taken = (
        running(stage(queued, "queued"), order, {"mixed": "total"})
        .where(F.col("mixed") - F.col("total") < budget)
        .groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("source").alias("_source"))
        .agg(F.count("*").alias("_copies"))
    )
    same = (
        known["row"] == taken["_row"], known["doc_id"].eqNullSafe(taken["_id"]), known["source"].eqNullSafe(taken["_source"])
    )
    copies = F.coalesce("_copies", F.lit(0).cast("long"))
    return (
        known.join(taken, list(same), "left")
        .withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .select("doc_id", "row", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
    )


def _passes(repeats):
    return F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("pass")


def mixed(docs, **options):
    """`docs` as the mix takes them, each row as often as it has copies, in the columns it came with."""
    taken = fair_mix(docs, **options).where("copies > 0")
    taken = taken.select(F.col("row").alias("_row"), F.col("source").alias("_source"), F.col("copies").alias("_copies")).distinct()
    rows = docs.select(F.struct("*").alias("_doc"), docs["source"].alias("_from"), row_hash(docs).alias("_key"))
    joined = rows.join(taken, [F.col("_key") == F.col("_row"), F.col("_from").eqNullSafe(F.col("_source"))])
    return joined.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
        *(F.col("_doc")[name].alias(name) for name in docs.columns)
    )
