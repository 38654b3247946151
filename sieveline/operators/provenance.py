"""Which seeds a citing work leads back to, and through which works."""

from pyspark.sql import functions as F

from sieveline import settings
from sieveline.staging import join_hot, number_rows, stage

BITS = 64


def _bits(name="n"):
    """(word, bits) of a number: one bit of a 64-bit word, so that sets of any number of seeds are few rows."""
    bit = F.pmod(F.col(name), F.lit(BITS)).cast("int")
    return F.floor(F.col(name) / BITS).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits")


def numbered_seeds(seeds):
    """Distinct seed ids with a number from 0 (id, n)."""
    known = seeds.select(F.col("id").alias("id")).where("id IS NOT NULL").distinct()
    return stage(number_rows(known, "n", "id").select("id", F.col("n").cast("long").alias("n")), "seeds")


def reached_from(edges, marks, rows=settings.BROADCAST_ROWS, hot_rows=settings.HOT_ROWS):
    """Bitmaps of the works that cite one of the works in `marks` (id, word, bits): the union of theirs.

    One row for each citing work and word, combined before the shuffle; edges of much-cited
    works are met in place.
    """
    found = join_hot(edges, marks.withColumnRenamed("id", "cited"), "cited", rows, hot_rows)
    return found.groupBy(F.col("citing").alias("id"), "word").agg(F.bit_or("bits").alias("bits"))


def cited_among(edges, level, rows=settings.BROADCAST_ROWS, hot_rows=settings.HOT_ROWS):
    """The works of `level` (id) that each work cites (id, cites): no more than its own references."""
    found = join_hot(edges, level.select(F.col("id").alias("cited")), "cited", rows, hot_rows)
    return found.groupBy(F.col("citing").alias("id")).agg(F.sort_array(F.collect_set("cited")).alias("cites"))


def named(marks, seeds):
    """Bitmaps (id, word, bits) as sorted arrays of seed ids (id, seeds)."""
    places = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda n: F.getbit("bits", n) == 1)
    numbers = marks.select("id", F.explode(F.transform(places, lambda n: F.col("word") * BITS + n)).alias("n"))
    names = seeds.select(F.col("id").alias("seed"), "n")
    return numbers.join(names, "n").groupBy("id").agg(F.sort_array(F.collect_list("seed")).alias("seeds"))


def snowball_provenance(edges, seeds, review, rows=settings.BROADCAST_ROWS, hot_rows=settings.HOT_ROWS):
    """The works of `snowball` with the seeds they lead back to and the works they cite on the way.

    Returns id, level, seeds, cites, both sorted. A primary work names the
    seeds it cites in `cites` and `seeds` alike; a secondary one the primary
    works it cites, and all seeds that these cite. A work found both ways stays
    primary, with the seeds that it cites itself. Works of the review are
    removed at the end only, so they may stand on a path. Null ids are no works; repeated edges count once.
    """
    edges = edges.select("citing", "cited").where("citing IS NOT NULL AND cited IS NOT NULL")
    numbered = numbered_seeds(seeds)
    first = stage(reached_from(edges, numbered.select("id", *_bits()), rows, hot_rows), "first-hop")
    second = stage(reached_from(edges, first, rows, hot_rows), "second-hop")
    primary = stage(first.select("id").distinct(), "primary")
    known = review.select("id").where("id IS NOT NULL").distinct()
    levels = []
    for level, marks, before in (("primary", first, numbered.select("id")), ("secondary", second, primary)):
        marks = marks.join(known, "id", "left_anti")
        if level == "secondary":
            marks = marks.join(primary, "id", "left_anti")
        one = named(marks, numbered).join(cited_among(edges, before, rows, hot_rows), "id")
        levels.append(one.select("id", F.lit(level).alias("level"), "seeds", "cites"))
    return levels[0].unionByName(levels[1])
