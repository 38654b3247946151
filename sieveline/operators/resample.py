"""Exact-size samples of the classes of a training set, by keyed hashes: the same under any partitioning."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.staging import number_rows, stage

# Leading hexadecimal digits of a hash: those that rows are counted by, and all that are compared.
COUNTED, COMPARED = 3, 15


def _digits(first, last):
    """Number of the hexadecimal digits `first` to `last` of an MD5, from 1."""
    return lambda text: F.conv(F.substring(F.md5(text), first, last - first + 1), 16, 10).cast("long")


def _text(seed, *parts):
    return F.concat_ws(":", F.lit(str(seed)), *(part.cast("string") for part in parts))


def without_replacement(rows, sizes, key, stratum, seed=0):
    """Exactly the wanted number of rows of each stratum, or all if there are no more.

    `sizes` has the stratum and n, one row each. Rows are taken by the hash of seed and
    key up to a threshold: counts by leading digits place it, and only rows of
    the one group of digits it falls into are ranked. `key` is unique in its
    stratum. Rows without key or stratum, and strata without a size, give none.
    """
    rows = rows.where(F.col(key).isNotNull() & F.col(stratum).isNotNull())
    hashed = rows.withColumns(
        {"_group": _digits(1, COUNTED)(_text(seed, F.col(key))), "_hash": _digits(1, COMPARED)(_text(seed, F.col(key)))}
    )
    before = Window.partitionBy(stratum).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    counts = hashed.groupBy(stratum, "_group").agg(F.count("*").alias("_n"))
    # At most 16 ** COUNTED rows per stratum.
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    wanted = F.broadcast(sizes.select(stratum, F.col("n").alias("_wanted")))
    cut = counts.join(wanted, stratum).where("_before < _wanted")
    cut = stage(cut.select(stratum, "_group", (F.col("_wanted") - F.col("_before")).alias("_left"), "_n"), "cut")
    met = hashed.join(F.broadcast(cut), [stratum, "_group"])
    whole, part = met.where("_n <= _left"), met.where("_n > _left")
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_hash", key))
    part = part.withColumn("_place", place).where(F.col("_place") <= F.col("_left")).drop("_place")
    return whole.unionByName(part).drop("_group", "_hash", "_left", "_n")


def with_replacement(rows, sizes, key, stratum, seed=0, name="copies"):
    """Exactly the wanted number of draws from each stratum; `name` counts how often a row was drawn.

    Rows are numbered in the order of the hash of seed and key, without a
    global sort in one task; draw j takes the row whose number is the hash of seed,
    stratum and j modulo the size of the stratum. Rows that are not drawn are left out.
    """
    rows = rows.where(F.col(key).isNotNull() & F.col(stratum).isNotNull())
    order = _digits(1, COMPARED)(_text(seed, F.col(key)))
    keys = number_rows(rows.select(key, stratum, order.alias("_hash")), "_number", stratum, "_hash", key)
    keys = stage(keys, "keys")
    ends = F.broadcast(stage(keys.groupBy(stratum).agg(F.min("_number").alias("_first"), F.count("*").alias("_size")), "ends"))
    draws = sizes.where("n > 0").join(ends, stratum)
    draws = draws.select(stratum, "_size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)).alias("_draw"))
    drawn = F.pmod(_digits(1, COMPARED)(_text(seed, F.col(stratum), F.col("_draw"))), F.col("_size"))
    drawn = draws.groupBy(stratum, drawn.alias("_place")).agg(F.count("*").alias(name))
    placed = keys.join(ends, stratum).select(key, stratum, (F.col("_number") - F.col("_first")).alias("_place"))
    return rows.join(placed.join(drawn, [stratum, "_place"]).drop("_place"), [key, stratum])


def balanced(training, key="id", label="label_included", seed=0):
    """As many rows of either class as half of all: the smaller class drawn with, the larger without replacement.

    `copies` counts the draws of a row. A training set of one class gives half of it.
    """
    training = training.where(F.col(label).isin(0, 1))
    sizes = stage(training.groupBy(label).agg(F.count("*").alias("_size")), "sizes")
    half = F.floor(F.sum("_size").over(Window.partitionBy()) / 2)
    sizes = stage(sizes.withColumn("n", half.cast("long")), "half")
    large, small = sizes.where("_size >= n").select(label, "n"), sizes.where("_size < n").select(label, "n")
    under = without_replacement(training, large, key, label, seed).withColumn("copies", F.lit(1).cast("long"))
    over = with_replacement(training, small, key, label, seed)
    return under.unionByName(over)
