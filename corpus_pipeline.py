"""A training corpus from raw documents: five operators in turn.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; run() writes it as Parquet and reads it for the next.
All but the last return the columns of documents, extra ones included.

Null and empty texts go through each stage by its operator's rule: the quality
score of an empty text decides on it, it is one empty line, near nothing, of
size 0 in the mix (so it is taken as often as any document of no words is), and has no
tokens. Repeated rows are kept or dropped alike by the first and third stage; the
second drops lines of the later rows only if another doc_id has them. An empty
table gives no rows, and where labels are too few to learn from nothing is rejected.
"""

from pyspark.sql import functions as F

from sieveline.llm import bpe, lines, minhash, mixing, quality
from sieveline.llm.queries import bpe_pattern, vocabulary
from sieveline.llm.tables import table
from sieveline.staging import stage


def good_documents(spark, docs, sf_dir):
    """Documents that the quality classifier, fitted on labelled rows of `docs`, does not reject."""
    labels = table(spark, sf_dir, "labels")
    try:
        model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    except quality.TooFewLabels:
        return docs
    return quality.good_only(docs, model)


def unique_lines(spark, docs, sf_dir):
    """All documents, without the lines that a document of smaller doc_id has; n_chars follows the text."""
    kept = lines.dedup_lines(docs)
    return kept.select(*(F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def unlike_documents(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return minhash.dedup(docs)


def mixed_sources(spark, docs, sf_dir):
    """Documents as the mix takes them, repeated ones as often."""
    return mixing.mixed(docs)


def token_ids(spark, docs, sf_dir):
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), source, and the sha256 of the bytes the ids decode to."""
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs, ranks, bpe_pattern(), keep=("source",), tokens=True)
    decoded = bpe.decode(encoded, ranks, keep=("source",))
    return decoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", unique_lines),
    ("minhash near-dedup", unlike_documents),
    ("source mix", mixed_sources),
    ("byte-level bpe", token_ids),
]

# Trained scores, minhashes, a keyed shuffle and token merges are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
