"""Registered queries of the operators, each over its whole table."""

from pyspark.sql import functions as F

from sieveline.llm import (
    bitsliced,
    bpe,
    cascade,
    chat,
    flatgraph,
    hilbert,
    laesa,
    langid,
    lines,
    minhash,
    mixing,
    pseudonyms,
    quality,
)
from sieveline.llm.tables import table

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Pseudonyms are linked for as long as this stays the same; a user passes a secret of their own.
PSEUDONYM_KEY = b"registered query"


def vocabulary(name):
    """Path of a file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


@query
def op1_compression_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    scored = quality.with_score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


@query
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op3_hilbert_shards(spark, sf_dir):
    placed = hilbert.shard(table(spark, sf_dir, "documents"), shards=8)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", grown, "curve")


@query
def op4_rule_cascade(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = cascade.cascade(docs, cascade.ordered(cascade.estimate(docs)), complete=counts)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", "kept", "counts.*").withColumn("base_failed", base_failed)


@query
def op5_feistel_pseudonyms(spark, sf_dir):
    return pseudonyms.pseudonyms(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query
def op6_fair_mix(spark, sf_dir):
    return mixing.fair_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_chat_masks(spark, sf_dir):
    odd = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").union(extra)
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        return chat.read_back(chat.format_chats(turns, file.read()))


@query
def op8_minhash_hamming(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_byte_bpe(spark, sf_dir):
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, bpe_pattern(), tokens=True)
    decoded = bpe.decode(encoded, ranks)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_flat_graph(spark, sf_dir):
    found = flatgraph.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("recall_reached", F.col("audited_recall") >= flatgraph.RECALL).drop("audited_recall")


@query
def op11_language_families(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op12_bitsliced_search(spark, sf_dir):
    return bitsliced.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_laesa_clusters(spark, sf_dir):
    return laesa.cluster(table(spark, sf_dir, "embeddings")).drop("n_exact")
