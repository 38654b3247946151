"""Byte-level BPE: ranked merges over the bytes of distinct words, and back."""

import base64
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.tables import text_of
from sieveline.staging import stage

ENCODED = T.StructType().add("doc_id", "long").add("n_tokens", "long").add("ids", "binary")
CACHED_WORDS = 400_000
CACHED_BYTES = 64
# Words above this length are merged with a queue instead of by scanning their pairs.
SCANNED_BYTES = 48
NONE = 1 << 62


def read_ranks(path):
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge(word, ranks):
    """Ranks of the tokens of a word: the adjacent pair of lowest rank, leftmost first, is merged until none has a rank."""
    if word in ranks:
        return [ranks[word]]
    return _merge_short(word, ranks) if len(word) <= SCANNED_BYTES else _merge_long(word, ranks)


def _merge_short(word, ranks):
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while pairs:
        low = min(pairs)
        if low == NONE:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NONE)
    return [ranks[part] for part in parts]


def _merge_long(word, ranks):
    """The same merges from a queue of (rank, start), with the part that starts at each byte and its neighbours."""
    n = len(word)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = bytearray(b"\1" * n)

    def pair(start):
        middle = ends[start]
        return ranks.get(word[start : ends[middle]]) if middle < n else None

    queue = [(rank, start) for start in range(n - 1) if (rank := pair(start)) is not None]
    heapq.heapify(queue)
    while queue:
        rank, start = heapq.heappop(queue)
        if not alive[start] or pair(start) != rank:
            continue
        middle = ends[start]
        alive[middle] = 0
        ends[start] = ends[middle]
        if ends[start] < n:
            before[ends[start]] = start
        for left in (before[start], start):
            if left >= 0 and (rank := pair(left)) is not None:
                heapq.heappush(queue, (rank, left))
    tokens, start = [], 0
    while start < n:
        tokens.append(ranks[word[start : ends[start]]])
        start = ends[start]
    return tokens


class _Merged(dict):
    """Packed ranks of words; short words are kept for later batches."""

    def __init__(self, ranks):
        self.ranks = ranks

    def __missing__(self, word):
        value = np.array(merge(word, self.ranks), "<u4").tobytes()
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


# The last vocabulary of this worker and the words it has merged by it.
_last = [None, None]


def _table(ranks):
    if _last[0] is not ranks:
        _last[:] = ranks, _Merged(ranks)
    return _last[1]


def _packed(pieces, merged):
    """Token counts and packed ranks of the texts of a list array of their words."""
    words = pieces.flatten().dictionary_encode()
    encoded = [merged[word] for word in words.dictionary.cast(pa.binary()).to_pylist()]
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    starts = np.cumsum(lengths) - lengths
    flat = np.frombuffer(b"".join(encoded), "<u4")
    at = words.indices.to_numpy()
    sizes = lengths[at]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    ids = flat[np.repeat(starts[at] - ends[:-1], sizes) + np.arange(ends[-1])]
    offsets = pieces.offsets.to_numpy()
    bounds = ends[offsets - offsets[0]]
    return np.diff(bounds), bounds * 4, ids


def encode(docs, ranks, pattern, keep=(), tokens=False):
    """(doc_id, n_tokens, ids) and the columns `keep` of `docs` per row; `ids` are little-endian unsigned 32-bit ranks.

    Each match of `pattern` is a word, encoded for itself without special
    tokens; \\s and \\S have their Unicode meaning. Words are found by Spark's
    regular expressions; in each Arrow batch the distinct ones are merged and
    their tokens dealt back to the texts. `ranks` (bytes to rank) is the whole
    vocabulary and goes to the executors once; single bytes must have ranks.
    Null and empty texts have no tokens; an empty table gives no rows. With `tokens` a
    last column of this name has the ranks as an array.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        merged = _table(sent.value)
        for batch in batches:
            counts, bounds, ids = _packed(batch.column(1), merged)
            buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))]
            packed = pa.Array.from_buffers(pa.binary(), len(batch), buffers)
            own = [batch.column(0), pa.array(counts), packed, *batch.columns[2:]]
            if tokens:
                own.append(pa.ListArray.from_arrays(pa.array((bounds // 4).astype(np.int32)), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(own, schema.names)

    words = F.regexp_extract_all(text_of(docs), F.lit("(?U)" + pattern), F.lit(0))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), words.alias("_words"), *(docs[name] for name in keep))
    schema = T.StructType([*ENCODED, *rows.schema.fields[2:]])
    schema = schema.add("tokens", T.ArrayType(T.IntegerType())) if tokens else schema
    return rows.mapInArrow(run, schema)


def _literal(value, kind):
    """A constant array that Spark parses once, when it plans."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _numbers(packed):
    """Ranks as an array of integers from little-endian unsigned 32-bit numbers."""
    byte = lambda at: F.conv(F.hex(F.substring(packed, at, F.lit(1))), 16, 10).cast("int")
    number = lambda n: byte(4 * n + 1) + 256 * byte(4 * n + 2) + 65_536 * byte(4 * n + 3)
    places = F.filter(F.sequence(F.lit(0), F.octet_length(packed).cast("int")), lambda n: 4 * n < F.octet_length(packed))
    return F.transform(places, number)


def decode(encoded, ranks, keep=()):
    """`encoded` (with columns doc_id, n_tokens, ids, and `keep`) and `decoded`, the bytes of its tokens. Null ids decode to null.

    The piece of each token is taken from a literal array by its place and the
    pieces are joined, by Spark's functions alone. Ranks come from the column
    `tokens` (an array) if encode() was asked for it, else from the packed ids.
    Ranks are below 2 ** 24.
    """
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    table = _literal(pieces, "array<string>")
    tokens = F.col("tokens") if "tokens" in encoded.columns else _numbers(F.col("ids"))
    joined = F.array_join(F.transform(tokens, lambda rank: F.element_at(table, rank + 1)), "")
    return encoded.select("doc_id", "n_tokens", "ids", *keep, F.unhex(joined).alias("decoded"))


# Buckets of the table of pairs; about one pair in each.
BUCKETS = 262_139


def pair_table(ranks):
    """For each bucket the pairs of ranks that merge and the rank they merge to, as JSON values."""
    buckets = [[] for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pair = left << 24 | right
                buckets[pair % BUCKETS].append({"p": pair, "r": rank})
    return buckets


def folded(word, ranks):
    """Ranks of the tokens of a binary column of words: merges folded by higher-order functions, one a step."""
    table = _literal(pair_table(ranks), "array<array<struct<p:bigint,r:int>>>")
    single = _literal([ranks[bytes([b])] for b in range(256)], "array<int>")
    byte = lambda n: F.conv(F.hex(F.substring(word, n, F.lit(1))), 16, 10).cast("int")
    length = F.octet_length(word).cast("int")
    start = F.transform(F.sequence(F.lit(1), length), lambda n: F.element_at(single, byte(n) + 1))

    def merged(left, right):
        pair = F.shiftleft(left.cast("long"), 24).bitwiseOR(right.cast("long"))
        known = F.transform(F.array(pair), lambda p: F.filter(F.element_at(table, (p % BUCKETS).cast("int") + 1), lambda x: x["p"] == p))
        return F.get(F.get(known, F.lit(0)), F.lit(0))["r"]

    def step(parts, _):
        pairs = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda left, n: merged(left, F.get(parts, n + 1)))

        def lowest(found):
            low = F.array_min(found)
            at = F.array_position(found, low).cast("int")
            return F.when(low.isNull(), parts).otherwise(
                F.concat(F.slice(parts, F.lit(1), at - 1), F.array(low), F.slice(parts, at + 2, F.size(parts)))
            )

        return F.get(F.transform(F.array(pairs), lowest), F.lit(0))

    return F.when(length > 1, F.aggregate(F.sequence(F.lit(2), length), start, step)).otherwise(start)


def encode_folded(docs, ranks, pattern):
    """As encode(), by Spark's higher-order functions over the distinct words of all texts; far slower, see the README.

    Words are counted out, folded once each and joined back to their places.
    doc_id is a key here. A word in the vocabulary is its own token.
    """
    words = F.regexp_extract_all(text_of(docs), F.lit("(?U)" + pattern), F.lit(0))
    texts = stage(docs.select(docs["doc_id"].cast("long").alias("doc_id"), words.alias("words")), "words")
    places = texts.select("doc_id", F.posexplode("words").alias("place", "word"))
    whole = docs.sparkSession.createDataFrame([(token, rank) for token, rank in ranks.items()], "bytes binary, rank int")
    distinct = places.select("word").distinct().withColumn("bytes", F.col("word").cast("binary"))
    known = distinct.join(F.broadcast(whole), "bytes", "left")
    own = F.when(F.col("rank").isNotNull(), F.array("rank")).otherwise(folded(F.col("bytes"), ranks))
    merged = stage(known.select("word", own.alias("own")), "merged")
    joined = places.join(merged, "word").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "own"))).alias("all"))
    tokens = joined.select("doc_id", F.flatten(F.transform("all", lambda one: one["own"])).alias("tokens"))
    tokens = texts.select("doc_id").join(tokens, "doc_id", "left")
    return tokens.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<int>")))
