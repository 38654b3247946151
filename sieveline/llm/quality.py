"""Quality classifier: which of two trained dictionaries compresses a text better."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.tables import text_of

# At most so many labelled rows of each class fit the model, half of them the dictionaries and half
# the calibration; longer texts are not among them, which bounds what reaches the driver.
FIT_ROWS = 2_000
FIT_CHARS = 20_000
DICTIONARY_BYTES = 108 * 1024
# Texts are compressed in pieces, so that a dictionary counts as much at the end of a long text.
PIECE_BYTES = 1_024
LEVEL = 3
RIDGE = 1e-2
THRESHOLD = 0.3
FEATURES = 4


class TooFewLabels(ValueError):
    """There is nothing to tell good texts from bad ones by."""


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and scale and weights of the calibration over the numbers of Sizes and 1."""

    good: bytes
    bad: bytes
    scale: tuple
    weights: tuple


def _pieces(text):
    return [text[start : start + PIECE_BYTES] for start in range(0, len(text), PIECE_BYTES)]


def _compressor(dictionary):
    trained = zstandard.ZstdCompressionDict(dictionary)
    trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=trained, level=LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False
    )


class Sizes:
    """What the compressed sizes of a text say: FEATURES numbers, zeros for an empty text.

    The normalised difference of its sizes by the two dictionaries, over all of
    it and in the worst piece; and, as text that repeats itself is small by
    either, the logarithm of its least size by its length, over all of it and in
    the smallest piece.
    """

    def __init__(self, good, bad):
        self.good, self.bad = _compressor(good), _compressor(bad)

    def __call__(self, text):
        pieces = _pieces(text)
        if not pieces:
            return (0.0,) * FEATURES
        length = np.array([len(piece) for piece in pieces], float)
        good = np.array([len(self.good.compress(piece)) for piece in pieces], float)
        bad = np.array([len(self.bad.compress(piece)) for piece in pieces], float)
        # Pieces much shorter than the others say little by themselves.
        telling = length * 4 >= min(len(text), PIECE_BYTES)
        each = ((bad - good) / (bad + good))[telling]
        least = np.minimum(good, bad)
        sizes = np.log(least / length)[telling]
        total = (bad.sum() - good.sum()) / (bad.sum() + good.sum())
        return float(total), float(each.min()), float(np.log(least.sum() / length.sum())), float(sizes.min())


def _dictionary(texts):
    """A trained dictionary; of too few texts to train one, the texts themselves."""
    samples = [piece for text in texts for piece in _pieces(text)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


def _calibrated(features, labels):
    """Scale and weights of a ridge logistic regression by Newton's method."""
    scale = np.maximum(np.abs(features).max(axis=0), 1e-9)
    x = np.hstack([features / scale, np.ones((len(features), 1))])
    weights, ridge = np.zeros(x.shape[1]), np.diag([RIDGE] * features.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -35, 35)))
        gradient = x.T @ (p - labels) + ridge @ weights
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(scale), tuple(weights)


def labelled_sample(docs, labels, rows=FIT_ROWS, chars=FIT_CHARS):
    """Up to `rows` texts of each class as lists of bytes {1: [...], 0: [...]}, the same for the same tables.

    Rows are drawn by hash of doc_id among those with a quality and a text of 1 to `chars` characters.
    """
    docs = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    wanted = {}
    for quality in (1, 0):
        ids = labels.where(F.col("quality") == quality).select(F.col("doc_id").alias("_id")).distinct()
        # Twice as many as needed, as some texts are too long or missing.
        ids = ids.where("_id IS NOT NULL").orderBy(F.xxhash64("_id"), "_id").limit(2 * rows)
        found = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
        found = found.where(F.char_length("text").between(1, chars)).select("_id", F.col("text").cast("binary").alias("_text"))
        found = found.orderBy(F.xxhash64("_id"), "_id", "_text").limit(rows).toArrow()
        wanted[quality] = found.column("_text").to_pylist()
    return wanted


def fit(docs, labels, rows=FIT_ROWS, chars=FIT_CHARS):
    """Model from a bounded sample of the rows that `labels` (doc_id, quality 0 or 1) marks.

    Every second text of a class trains its dictionary, the others calibrate the
    score. Class weights are those of the sample, corrected to the numbers of
    `labels`. Raises TooFewLabels if a class has fewer than two texts.
    """
    sample = labelled_sample(docs, labels, rows, chars)
    counts = {row["quality"]: row["count"] for row in labels.groupBy("quality").count().collect() if row["quality"] in (0, 1)}
    if min(len(sample[0]), len(sample[1])) < 2:
        raise TooFewLabels("fewer than two labelled texts in a class")
    model = [_dictionary(sample[quality][::2]) for quality in (1, 0)]
    sizes_of = Sizes(*model)
    rest = {quality: sample[quality][1::2] for quality in (1, 0)}
    features = np.array([sizes_of(text) for quality in (1, 0) for text in rest[quality]])
    truth = np.array([quality for quality in (1, 0) for _ in rest[quality]], float)
    scale, weights = _calibrated(features, truth)
    prior = np.log(counts[1] / counts[0]) - np.log(len(rest[1]) / len(rest[0]))
    return Model(*model, scale, (*weights[:-1], weights[-1] + prior))


def with_score(docs, model, name="score"):
    """`docs` with a column `name`, 0 to 1, higher for texts that are likelier good.

    The score is a function of the whole text alone. Null and empty texts have
    no sizes and get the score of that; a column `name` of `docs` is replaced;
    an empty table gives no rows.
    """
    docs = docs.select(*(column for column in docs.columns if column != name))

    def run(batches):
        sizes_of = Sizes(model.good, model.bad)
        scale, weights = np.array(model.scale), np.array(model.weights)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            features = np.array([sizes_of(text.as_buffer().to_pybytes()) for text in texts]).reshape(-1, FEATURES)
            logits = features / scale @ weights[:-1] + weights[-1]
            scores = pa.array(1 / (1 + np.exp(-np.clip(logits, -35, 35))))
            yield batch.set_column(batch.num_columns - 1, name, scores)

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.select("*", text_of(docs).cast("binary").alias(name)).mapInArrow(run, schema)


def held_out(doc_id):
    """One row in five, by crc32 of the id as text: never used to fit."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def good_only(docs, model, threshold=THRESHOLD):
    """The rows of `docs` whose score reaches `threshold`, in the columns they came with."""
    return with_score(docs, model, "_score").where(F.col("_score") >= threshold).select(*docs.columns)
