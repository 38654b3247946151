"""Ranked lexical search over bit-sliced Bloom signatures: bounds for all documents, exact scores for those left.

A document's signature holds its terms, and again each term that occurs at least
2, 4, 8, ... times. Signatures of like size stand side by side in blocks, cut
into slices: one bitmap over the documents of the block for each signature bit.
The bitwise and of a term's slices holds every document with the term, and some
others; its levels bound how often it occurs. Summed by the weights of an item's terms they
bound each document's score from above.
"""

import collections
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.llm.tables import text_of
from sieveline.staging import small, spread, stage

TOP = 10
# Bits and slices of a key; a false key then needs 6 of 16 bits by chance, about 1 in 1,000.
KEY_BITS, SLICES = 16, 6
# Documents and bytes of a block. A document of more than 2**LARGEST keys has as many bits as one of these, and more false keys.
BLOCK_DOCS, BLOCK_BYTES, SMALLEST, LARGEST = 2_048, 1 << 20, 4, 22
# Items are searched in groups of so many bytes of text, and their terms counted in blocks by so many term rows.
QUERY_BYTES, CELLS = 4 << 20, 4_000_000
CACHED_TERMS, CACHED_LENGTH = 300_000, 40

# Bytes of terms: 0-9, A-Z (lower-cased), a-z, and all of other code points; the others separate.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

INDEX = "width int, levels int, n_docs int, n_terms long, doc_ids array<long>, lengths array<long>, slices binary"
BOUNDS = "item int, doc_id long, bound double"
SCORES = "item int, doc_id long, score long"
RESULT = "item_id long, rank int, doc_id long, score long"


def terms(text):
    """The terms of a text in UTF-8, in order and repeated."""
    return text.translate(TERM_BYTES).split()


class TermHashes(dict):
    """64-bit hashes of terms; short ones are kept for the next text."""

    def __missing__(self, term):
        value = xxhash.xxh3_64_intdigest(term)
        if len(term) <= CACHED_LENGTH:
            if len(self) >= CACHED_TERMS:
                self.clear()
            self[term] = value
        return value


def places(hashes, level, width):
    """The SLICES bits of each key, a term's hash at a level, in a signature of `width` bits (a power of 2)."""
    with np.errstate(over="ignore"):
        keys = (hashes ^ np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(32)
        step = (keys >> np.uint64(32)) | np.uint64(1)
        found = keys[:, None] + np.arange(SLICES, dtype=np.uint64)[None, :] * step[:, None]
    return (found & np.uint64(width - 1)).astype(np.int64)


def _block(width, rows):
    """One row of the index from [(doc_id, length, hashes, counts)]."""
    stride = -(-len(rows) // 8)
    slices, levels = np.zeros(width * stride, np.uint8), 1
    for at, (_, _, hashes, counts) in enumerate(rows):
        level, bit = 0, np.uint8(128 >> (at % 8))
        while len(hashes):
            slices[(places(hashes, level, width) * stride + at // 8).ravel()] |= bit
            level += 1
            often = counts >= 1 << level
            hashes, counts = hashes[often], counts[often]
        levels = max(levels, level)
    return width, levels, len(rows), sum(row[1] for row in rows), [row[0] for row in rows], [row[1] for row in rows], slices.tobytes()


def _index_batch(block):
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
    names = [field.split()[0] for field in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(block, kinds)], names)


def index(docs):
    """Blocks of bit-sliced signatures of all documents with a term (doc_id, text), written once.

    Every task cuts its own documents into blocks by the size of their
    signatures; nothing is shuffled. A block holds at most BLOCK_DOCS documents
    and, above 8 documents, BLOCK_BYTES.
    """

    def run(batches):
        hash_of, waiting = TermHashes(), collections.defaultdict(list)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_buffer().to_pybytes())
                if not found:
                    continue
                counted = collections.Counter(found)
                hashes = np.fromiter(map(hash_of.__getitem__, counted), np.uint64, len(counted))
                counts = np.fromiter(counted.values(), np.int64, len(counted))
                keys = int(np.log2(counts).astype(np.int64).sum()) + len(counts)
                width = KEY_BITS << min(LARGEST, max(SMALLEST, (keys - 1).bit_length()))
                rows = waiting[width]
                rows.append((doc_id, len(found), hashes, counts))
                if len(rows) >= max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // width)):
                    yield _index_batch(_block(width, rows))
                    rows.clear()
        for width, rows in waiting.items():
            if rows:
                yield _index_batch(_block(width, rows))

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    return stage(spread(texts).mapInArrow(run, INDEX), "signatures")


def document_frequencies(docs, wanted):
    """Numbers of documents that hold each of `wanted`, a list of terms, exactly: one row of counts per task."""
    place = {term: i for i, term in enumerate(wanted)}

    def run(batches):
        counts, known = np.zeros(len(place), np.int64), place.keys()
        for batch in batches:
            for text in batch.column(0):
                found = known & set(terms(text.as_buffer().to_pybytes()))
                counts[np.fromiter((place[term] for term in found), np.int64, len(found))] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], ["term", "n"])

    partial = spread(docs.select(text_of(docs).cast("binary").alias("text"))).mapInArrow(run, "term int, n long")
    found = np.zeros(len(wanted), np.int64)
    for row in partial.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        found[row.term] = row.n
    return found


class Query:
    """A group of items: their weighted terms, and the sums over all documents that scores need."""

    def __init__(self, texts, n_docs, n_terms):
        self.counted = [collections.Counter(terms(text)) for text in texts]
        self.terms = sorted({term for counted in self.counted for term in counted})
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = None

    def weigh(self, frequencies):
        logs = (math.log((2 * self.n_docs + 2) / (2 * int(df) + 1)) for df in frequencies)
        self.weights = dict(zip(self.terms, (math.floor(1000 * value) for value in logs)))

    def normal(self, length):
        """m of a document of `length` terms; of an array of lengths too."""
        return 25 + 75 * length * self.n_docs // self.n_terms

    def score(self, item, counted, m):
        total = 0
        for term, times in self.counted[item].items():
            tf = counted.get(term)
            if tf:
                total += times * self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        return total

    def groups(self, docs=BLOCK_DOCS):
        """Items in groups of at most CELLS / `docs` different terms each (or one item): (hashes, [(item, places, weights)])."""
        most, group, held = CELLS // docs, [], set()
        for item, counted in enumerate(self.counted):
            if group and len(held | counted.keys()) > most:
                yield self._arrays(group, held)
                group, held = [], set()
            group.append(item)
            held |= counted.keys()
        if group:
            yield self._arrays(group, held)

    def _arrays(self, group, held):
        place = {term: i for i, term in enumerate(held)}
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(term) for term in held), np.uint64, len(held))
        items = []
        for item in group:
            counted = self.counted[item]
            at = np.fromiter((place[term] for term in counted), np.int64, len(counted))
            weights = np.fromiter((times * self.weights[term] for term, times in counted.items()), np.float64, len(counted))
            items.append((item, at, weights))
        return hashes, items


def impacts(query, lengths, levels):
    """Row `level`: the most that a term of that many levels can add in each document; row 0 is a term it lacks."""
    m = query.normal(lengths)
    most = np.minimum((np.int64(1) << np.arange(1, levels + 1, dtype=np.int64))[:, None] - 1, lengths[None, :])
    return np.vstack([np.zeros(len(lengths), np.int64), 1_000_000_000 * most // (1000 * most + 8 * m)]).astype(np.float64)


def upper_bounds(query, groups, width, levels, lengths, slices):
    """(item, bounds of all documents of a block) for each item."""
    stride = -(-len(lengths) // 8)
    slices = np.frombuffer(slices, np.uint8).reshape(width, stride)
    adds, at_doc = impacts(query, lengths, levels), np.arange(len(lengths))
    for hashes, items in groups:
        held = np.zeros((len(hashes), len(lengths)), np.uint8)
        bits, left = np.full((len(hashes), stride), 255, np.uint8), np.arange(len(hashes))
        for level in range(levels):
            at = places(hashes[left], level, width)
            bits = bits & np.bitwise_and.reduce(slices[at], axis=1)
            some = bits.any(axis=1)
            bits, left = bits[some], left[some]
            if not len(left):
                break
            held[left] += np.unpackbits(bits, axis=1, count=len(lengths))
        each = adds[held, at_doc[None, :]]
        for item, places_of, weights in items:
            # The margin covers the rounding of sums beyond 53 bits.
            yield item, (weights @ each[places_of]) * (1 + 1e-9)


def _blocks(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            width, levels, _, _, ids, lengths, slices = (batch.column(c)[row] for c in range(7))
            ids = ids.values
            yield width.as_py(), levels.as_py(), ids, lengths.values.to_numpy().astype(np.int64), slices.as_buffer()


def highest_bounds(blocks, query, top=TOP):
    """Per task, the `top` documents of highest bound for each item (item, doc_id, bound)."""

    def run(batches):
        groups, held = list(query.groups()), {}
        for width, levels, ids, lengths, slices in _blocks(batches):
            for item, bounds in upper_bounds(query, groups, width, levels, lengths, slices):
                at = np.argpartition(-bounds, top - 1)[:top] if len(bounds) > top else np.arange(len(bounds))
                at = at[bounds[at] > 0]
                known, known_ids = held.get(item, (np.empty(0), []))
                both, both_ids = np.r_[known, bounds[at]], known_ids + ids.take(pa.array(at)).to_pylist()
                order = np.argsort(-both, kind="stable")[:top]
                held[item] = both[order], [both_ids[i] for i in order]
        for item, (bounds, ids) in held.items():
            columns = [pa.array([item] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(bounds)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "bound"])

    return blocks.mapInArrow(run, BOUNDS)


def not_excluded(blocks, query, least):
    """All (item, doc_id, bound) whose bound reaches the item's entry of `least`, an array."""

    def run(batches):
        groups = list(query.groups())
        for width, levels, ids, lengths, slices in _blocks(batches):
            for item, bounds in upper_bounds(query, groups, width, levels, lengths, slices):
                at = np.flatnonzero(bounds >= least[item])
                if len(at):
                    columns = [pa.array(np.full(len(at), item, np.int32)), ids.take(pa.array(at)), pa.array(bounds[at])]
                    yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "bound"])

    return blocks.mapInArrow(run, BOUNDS)


def exact_scores(docs, pairs, query):
    """Exact scores above 0 of `pairs` (item, doc_id) from the whole texts (item, doc_id, score); each row of a doc_id has its own."""
    wanted = stage(pairs.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("item").alias("_items")), "wanted")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    joined = texts.join(small(wanted), F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "_items")

    def run(batches):
        for batch in batches:
            found = []
            for doc_id, text, items in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                held = terms(text.as_buffer().to_pybytes())
                counted, m = collections.Counter(held), query.normal(len(held))
                found += ((item, doc_id, query.score(item, counted, m)) for item in items)
            found = [row for row in found if row[2] > 0]
            columns = list(zip(*found)) or [(), (), ()]
            kinds = (pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "doc_id", "score"])

    return joined.mapInArrow(run, SCORES)


def best(rows, by, top=TOP):
    """The `top` rows of each item by the column `by`, equal ones by doc_id, nulls last, with their rank from 1."""
    order = Window.partitionBy("item").orderBy(F.col(by).desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_group(docs, blocks, texts, n_docs, n_terms, top):
    query = Query(texts, n_docs, n_terms)
    query.weigh(document_frequencies(docs, query.terms))
    likely = best(highest_bounds(blocks, query, top), "bound", top)
    # The lowest of `top` exact scores: whatever cannot reach it is out.
    known = best(exact_scores(docs, likely.select("item", "doc_id"), query), "score", top)
    least = np.ones(len(texts))
    for row in known.groupBy("item").agg(F.min("score").alias("score"), F.count("*").alias("n")).toLocalIterator():
        if row.n == top:
            least[row.item] = row.score
    left = not_excluded(blocks, query, least).select("item", "doc_id")
    return best(exact_scores(docs, left, query), "score", top)


def search(docs, items, top=TOP, query_bytes=QUERY_BYTES):
    """The `top` documents (doc_id, text) of highest score above 0 for each item (item_id, text).

    Scores are those of the contract's formula, in integers, equal ones ranked by
    doc_id. Documents whose bound is below the lowest of `top` exact scores
    already known cannot be among them; all others are scored from their whole
    text. Items are searched in groups of at most `query_bytes` of text (or
    one longer item), each against all documents; a group's terms and their weights
    are what is broadcast.

    Null and empty texts have no terms: such a document is no hit and not counted, such an
    item has no hits. Rows of one doc_id are ranked each by its own text;
    repeated rows of an item count once, different texts of one item_id are
    ranked each for itself. Null ids are ids like others, last among equal scores. Other columns are not
    read. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    blocks = index(docs)
    sums = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    items = stage(items.select(F.col("item_id").cast("long").alias("item_id"), text_of(items).cast("binary").alias("text")).distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text") + F.lit(64)).alias("bytes")).first().bytes
    result = spark.createDataFrame([], RESULT)
    if not sums[0] or not size:
        return result
    groups = -(-size // query_bytes)
    for group in range(groups):
        held = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group).toArrow()
        if not held.num_rows:
            continue
        found = _search_group(docs, blocks, held.column("text").to_pylist(), *sums, top)
        names = spark.createDataFrame(list(enumerate(held.column("item_id").to_pylist())), "item int, item_id long")
        part = found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
        result = part if groups == 1 else result.unionByName(stage(part, "ranked"))
    return result
