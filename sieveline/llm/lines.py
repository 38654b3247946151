"""Line dedup across documents; the result is a keep bitmap per document."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.llm.tables import BLANK_CHARS, row_hash, text_of
from sieveline.staging import stage

# Hashes of more rows than one in this many are set apart; so at most as many hashes are broadcast.
HOT_SHARE = 1_000
HOT_TRACKED = 10_000
WORD = 64


def _folded(text):
    """A-Z in lower case, all else as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, upper, lower)).otherwise(F.lower(text))


def line_hashes(docs, least=10):
    """One row (h1, h2, doc_id, row, pos) per line whose key has `least` code points."""
    text = text_of(docs)
    key = F.btrim(F.col("line"), F.lit(BLANK_CHARS))
    return (
        docs.where(docs["doc_id"].isNotNull())
        .select(docs["doc_id"].alias("doc_id"), row_hash(docs).alias("row"), _folded(text).alias("t"))
        .select("doc_id", "row", F.posexplode(F.split("t", "\n")).alias("pos", "line"))
        .where(F.char_length(key) >= least)
        .select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"), "doc_id", "row", "pos")
    )


def keep_bitmaps(docs, least=10):
    """Bitmaps of the lines to keep: (doc_id, row, words), documents that lose none left out.

    A line goes if its key (blanks stripped at both ends, A-Z lower-cased, at
    least `least` code points) is in a document of smaller doc_id. `words` is
    sorted and sparse: of every 64 lines that lose any, their number `word`
    and the bits `keep`, lowest bit first. Bit 1 keeps the line.

    Keys are 128 bits of hash. They are dealt by range of the hash, sorted by
    document and position inside, and a streaming window tells the first
    document of each. A hash of more than one row in HOT_SHARE doesn't go
    there: there are at most HOT_SHARE of them, their first documents come from
    a map-side minimum and are broadcast, and their rows are judged in place.

    Null or empty text is one empty line; rows of a null doc_id lose nothing
    and count for nothing; rows that repeat a doc_id are one document, but each
    different text has its own bitmap (`row`); an empty table gives no bitmaps.
    """
    lines = stage(line_hashes(docs, least), "lines")
    hot = (
        lines.agg(F.expr(f"approx_top_k(h1, {HOT_SHARE}, {HOT_TRACKED})").alias("top"), F.count("*").alias("rows"))
        .select(F.explode("top").alias("top"), "rows")
        .where(F.col("top.count") * HOT_SHARE > F.col("rows"))
        .select(F.col("top.item").alias("h1"))
    )
    hot = F.broadcast(stage(hot, "hot"))
    firsts = lines.join(hot, "h1", "left_semi").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    gone_hot = lines.join(F.broadcast(stage(firsts, "firsts")), ["h1", "h2"]).where(F.col("doc_id") > F.col("first"))
    stream = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, 0)
    gone = (
        lines.join(hot, "h1", "left_anti")
        .repartitionByRange("h1", "h2")
        .withColumn("first", F.first("doc_id").over(stream))
        .where(F.col("doc_id") > F.col("first"))
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("pos", F.lit(WORD)))
    return (
        gone.unionByName(gone_hot, allowMissingColumns=True)
        .groupBy("doc_id", "row", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
        .agg(F.bitwise_not(F.bit_or(bit)).alias("keep"))
        .groupBy("doc_id", "row")
        .agg(F.sort_array(F.collect_list(F.struct("word", "keep"))).alias("words"))
    )


def _left(docs, bitmaps):
    """(_doc, _n, _left): each row packed, its number of lines and the lines that stay."""
    text = text_of(docs)
    rows = docs.select(F.struct("*").alias("_doc"), docs["doc_id"].alias("_id"), row_hash(docs).alias("_row"), text.alias("_text"))
    # Dense words, so that a line finds its bit by position.
    sparse = F.map_from_entries("words")
    dense = F.transform(
        F.sequence(F.lit(0), F.element_at("words", -1)["word"]),
        lambda word: F.coalesce(F.element_at(sparse, word), F.lit(-1).cast("long")),
    )
    bits = bitmaps.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), dense.alias("_bits"))

    def stays(_, pos):
        word = F.coalesce(F.get("_bits", F.floor(pos / WORD).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(word, F.pmod(pos, F.lit(WORD))) == 1

    lines = F.split("_text", "\n")
    left = F.when(F.col("_bits").isNull(), lines).otherwise(F.filter(lines, stays))
    return rows.join(bits, ["_id", "_row"], "left").select("_doc", F.size(lines).cast("long").alias("_n"), left.alias("_left"))


def apply_bitmaps(docs, bitmaps, kept="kept_text"):
    """`docs` with the lines left by `bitmaps` in column `kept`, and n_lines, n_dropped.

    Columns of `docs` of these names are replaced. A null text has one line.
    """
    own = {kept: F.array_join("_left", "\n"), "n_lines": F.col("_n"), "n_dropped": F.col("_n") - F.size("_left")}
    return _left(docs, bitmaps).select(
        *(F.col("_doc")[name].alias(name) for name in docs.columns if name not in own), *(c.alias(n) for n, c in own.items())
    )


def dedup_lines(docs, least=10):
    """`docs` with its texts rewritten to the lines that stay, in the columns it came with."""
    text = F.array_join("_left", "\n")
    return _left(docs, keep_bitmaps(docs, least)).select(
        *((text if name == "text" else F.col("_doc")[name]).alias(name) for name in docs.columns)
    )
