"""Embedding of a text column."""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.text import encoder_text
from sieveline.settings import ENCODER_PREFIX, MAX_TOKENS, VECTOR_DIM
from sieveline.staging import spread


def term_bucket(word, dim):
    """Bucket of a word: the first 8 hexadecimal digits of its MD5, modulo `dim`."""
    return F.pmod(F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long"), F.lit(dim))


def hashed_terms(df, text_col, dim=VECTOR_DIM, prefix=ENCODER_PREFIX, max_tokens=None):
    """Counts of the words of the whole text, by bucket, as a `terms` vector.

    Words are runs without blanks, tabs and line ends, in lower case. The
    bucket is one any engine can compute, so vectors can be checked elsewhere.
    With `max_tokens` words after so many, those of the prefix included, do not count.
    """
    words = F.filter(F.split(F.lower(encoder_text(text_col, prefix)), r"[ \t\r\n]+"), lambda word: word != "")
    words = words if max_tokens is None else F.slice(words, 1, max_tokens)
    buckets = F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda word: term_bucket(word, dim).cast("string"))
    read = spread(df).withColumn("_buckets", buckets)
    counts = CountVectorizerModel.from_vocabulary([str(n) for n in range(dim)], inputCol="_buckets", outputCol="terms", minTF=1.0)
    return counts.transform(read).drop("_buckets")


def embed(df, text_col="text", dim=VECTOR_DIM, prefix=ENCODER_PREFIX, output="embedding", max_tokens=None):
    """Unit-length hashed term vectors, all inside the JVM.

    A stand-in where no language model is at hand: it is deterministic and
    has the shape of a model embedding, but no notion of meaning.
    """
    return scale(hashed_terms(df, text_col, dim, prefix, max_tokens), output).drop("terms")


def scale(df, output="embedding"):
    """Add the `terms` vector scaled to unit length, as an array."""
    scaled = Normalizer(inputCol="terms", outputCol="_scaled").transform(df)
    return scaled.withColumn(output, vector_to_array("_scaled", "float32")).drop("_scaled")


def first_words(text, n):
    """The text up to the end of its `n`th word, all of it if it has no more: for a model without a tokenizer."""
    end = None
    for count, word in enumerate(re.finditer(r"\S+", text), 1):
        if count > n:
            return text[:end]
        end = word.end()
    return text


def packed(lengths, batch_size, batch_tokens):
    """Batches of places in the order of length: at most `batch_size` texts, and `batch_tokens` once padded to the longest.

    A longer single text is a batch of its own.
    """
    batch, longest = [], 0
    for place in sorted(range(len(lengths)), key=lambda place: (lengths[place], place)):
        longest = max(longest, lengths[place])
        if batch and (len(batch) == batch_size or longest * (len(batch) + 1) > batch_tokens):
            yield batch
            batch, longest = [], lengths[place]
        batch.append(place)
    if batch:
        yield batch


def embed_with(
    df,
    load_model,
    text_col="text",
    prefix=ENCODER_PREFIX,
    batch_size=256,
    output="embedding",
    max_tokens=MAX_TOKENS,
    batch_tokens=256 * MAX_TOKENS,
):
    """Embeddings from a model with `encode(list of texts) -> matrix`.

    `load_model` is called once per Python worker task. With `max_tokens` texts are cut
    to so many tokens, the prefix included: by `model.truncate(text, n)` if the model
    has it, else after so many words. Texts arrive in Arrow batches and are
    encoded in batches of like length, by `model.count(text)` tokens or else
    words: at most `batch_size` texts, and `batch_tokens` tokens once padded. Results are in the order of the rows.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        cut = getattr(model, "truncate", first_words)
        count = getattr(model, "count", lambda text: len(text.split()))
        for texts in batches:
            texts = texts.tolist() if max_tokens is None else [cut(text, max_tokens) for text in texts]
            vectors = [None] * len(texts)
            for places in packed([count(text) for text in texts], batch_size, batch_tokens):
                found = np.asarray(model.encode([texts[place] for place in places]), dtype=np.float32)
                for place, vector in zip(places, found):
                    vectors[place] = vector
            yield pd.Series(vectors, dtype=object)

    return spread(df).withColumn(output, encode(encoder_text(text_col, prefix)))
