"""The screening data model read from the given tables.

documents are the works (first line title, the rest abstract), embeddings
their vectors, labels the review (toxic = included), orders the publication
dates and lineitem the citations (order cites part).
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.text import full_id
from sieveline.operators.neighbors import nearest
from sieveline.operators.seeds import included
from sieveline.staging import spread, stage

EXCLUDED = ("10.SRC1/8", "10.src6/1", "10.src12/5", "10.src15/1")
DEPTH = 100
DIM = 64


SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "labels": "doc_id long, quality int, toxic int",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "pages": "page_id long, url string, html string",
}


def table(spark, sf_dir, name):
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def work_id(col):
    return F.concat(F.lit("W"), F.col(col).cast("string"))


def works(spark, sf_dir):
    text = F.col("text")
    line_end = F.instr(text, "\n")
    return table(spark, sf_dir, "documents").select(
        work_id("doc_id").alias("id"),
        F.concat(F.lit("https://doi.org/10."), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("doi"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(line_end > 0, F.substr(text, line_end + 1)).alias("abstract"),
    )


def dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        work_id("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("publication_date"),
        F.year("o_orderdate").alias("publication_year"),
    )


def dated_works(spark, sf_dir):
    return works(spark, sf_dir).join(dates(spark, sf_dir), "id", "left")


def review(spark, sf_dir):
    """Labelled works by full id, in the order of position."""
    labels = table(spark, sf_dir, "labels").select(
        work_id("doc_id").alias("id"), F.col("doc_id").alias("position"), F.col("toxic").alias("label_included")
    )
    return labels.join(works(spark, sf_dir), "id").withColumn("id", full_id(F.col("id")))


def corpus(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(work_id("vec_id").alias("id"), "embedding")


def seed_ids(spark, sf_dir):
    """Included works by short id; only labels and DOIs are read."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label_included"))
    dois = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("https://doi.org/10."), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("doi")
    )
    return included(labels.join(dois, "doc_id"), EXCLUDED).select(
        work_id("doc_id").alias("id"), F.col("doc_id").alias("query_pos")
    )


def seeds(spark, sf_dir):
    found = seed_ids(spark, sf_dir).join(corpus(spark, sf_dir), "id")
    return found.select("query_pos", full_id(F.col("id")).alias("query_id"), "embedding")


def criteria(spark, sf_dir):
    """The one query vector: that of the newest record."""
    vectors = table(spark, sf_dir, "embeddings")
    newest = vectors.agg(F.max("vec_id").alias("vec_id"))
    return vectors.join(F.broadcast(newest), "vec_id").select(
        F.lit(0).cast("long").alias("query_pos"), full_id(work_id("vec_id")).alias("query_id"), "embedding"
    )


def hits(spark, sf_dir, k=DEPTH, **options):
    return nearest(corpus(spark, sf_dir), seeds(spark, sf_dir), k, **options)


def criteria_hits(spark, sf_dir, k=DEPTH, **options):
    return nearest(corpus(spark, sf_dir), criteria(spark, sf_dir), k, **options)


def both_hits(spark, sf_dir, k=DEPTH, queries=None, one=None):
    """Hits of the seeds and of the criteria, found by one scan of the corpus."""
    one = (one or criteria(spark, sf_dir)).withColumn("query_pos", F.lit(-1).cast("long"))
    every = (queries or seeds(spark, sf_dir)).unionByName(one)
    found = stage(nearest(corpus(spark, sf_dir), every, k), "hits")
    return found.filter(F.col("query_pos") >= 0), found.filter(F.col("query_pos") == -1)


def edges(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        work_id("l_orderkey").alias("citing"), work_id("l_partkey").alias("cited")
    )


def referencing_works(spark, sf_dir):
    """Works with reference lists: the part and the supplier of each line."""
    return table(spark, sf_dir, "lineitem").select(
        work_id("l_orderkey").alias("id"),
        F.array(work_id("l_partkey"), work_id("l_suppkey")).alias("referenced_works"),
    )


def inverted_works(spark, sf_dir):
    """Raw works whose abstract is an inverted index of the whole text."""
    return with_index(spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")))


def with_index(documents):
    """`documents` with an inverted index of the whole text instead of the text, which takes several times its room."""
    others = [name for name in documents.columns if name != "text"]
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    placed = F.sort_array(F.transform(words, lambda token, pos: F.struct(token.alias("token"), pos.alias("pos"))))
    first = F.filter(
        F.sequence(F.lit(0), F.size("placed") - 1),
        lambda n: (n == 0) | (F.get("placed", n)["token"] != F.get("placed", n - 1)["token"]),
    )
    ends = F.concat(F.slice("first", 2, F.size("first")), F.array(F.size("placed")))
    tokens = F.transform("first", lambda n: F.get("placed", n)["token"])
    positions = F.transform(
        F.arrays_zip("first", "ends"),
        lambda run: F.transform(
            F.slice("placed", run["first"] + 1, run["ends"] - run["first"]), lambda entry: entry["pos"]
        ),
    )
    return (
        documents.select(*others, placed.alias("placed"))
        .withColumn("first", first)
        .withColumn("ends", ends)
        .select(*others, F.map_from_arrays(tokens, positions).alias("abstract_inverted_index"))
    )


def dated_texts(spark, sf_dir):
    """The texts of raw works with year and update date: what is joined and moved before the index is made."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.to_date("o_orderdate").alias("date"))
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return documents.join(orders, "doc_id", "left").select(
        full_id(work_id("doc_id")).alias("id"),
        F.col("lang").alias("title"),
        "text",
        F.year("date").alias("publication_year"),
        F.coalesce(F.trunc("date", "year").cast("string"), F.lit("1970-01-01")).alias("updated_date"),
    )


RAW_COLUMNS = ("id", "title", "abstract_inverted_index", "publication_year", "updated_date")


def raw_works(spark, sf_dir):
    """Raw works with a full id, title, index, year and update date."""
    return with_index(dated_texts(spark, sf_dir)).select(*RAW_COLUMNS)


def master(spark, sf_dir):
    """Master table of the labelled works.

    Records of quality 0 have no identifier; flags follow the labels.
    """
    labels = table(spark, sf_dir, "labels").withColumn("id", work_id("doc_id"))
    known = F.col("quality") == 1
    return labels.join(works(spark, sf_dir), "id").select(
        F.concat(F.lit("M"), F.col("doc_id").cast("string")).alias("MID"),
        F.when(known, full_id(F.col("id"))).alias("openalex_id"),
        F.when(known, F.col("doi")).alias("doi"),
        F.when(F.col("toxic") == 0, F.col("title")).alias("title"),
        "abstract",
        F.col("toxic").alias("Data_0_Synergy"),
        F.when(known, F.col("toxic")).alias("Data_3b_old"),
    )


MASTER_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("MID", "openalex_id", "doi", "title", "abstract")]
    + [T.StructField(name, T.IntegerType()) for name in ("Data_0_Synergy", "Data_3b_old")]
)
