"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures."""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sieveline.llm.components import Sets, components
from sieveline.llm.shingles import digest, minhashes, shingle_set, similar
from sieveline.llm.tables import text_of
from sieveline.staging import small, stage

SIZE = 5
PERCENT = 75
# A signature has POSITIONS values of 16 bits. The first CHUNKS * CHUNK are indexed in chunks; a
# chunk may have one error. So all pairs that differ in fewer than 2 * CHUNKS indexed positions meet.
POSITIONS = 192
CHUNKS = 10
CHUNK = 4
# Candidates with fewer equal positions are no pairs: at a similarity of 0.75, 144 are expected, with
# a deviation of 6; fewer than 114 come less than once in a million pairs, and for more similar ones not at all.
LEAST_EQUAL = 114
# A cell of the exhaustive join holds at most about two blocks: of texts, and of short signatures that screen them.
BLOCK = 1_024
SCREEN_BLOCK = 8_192
KEPT = list(itertools.combinations(range(CHUNK), CHUNK - 1))

SIGNED = "doc_id long, n long, digest binary, keys array<long>, signature binary, short binary"


def _keys(values):
    """One key per chunk and position left out: key number above bit 48, three values below."""
    own = values.astype(np.int64)
    keys = []
    for chunk in range(CHUNKS):
        for kept in KEPT:
            packed = np.int64(len(keys))
            for position in kept:
                packed = (packed << 16) | own[chunk * CHUNK + position]
            keys.append(packed)
    return keys


def _first_common(equal):
    """Number of the first key that pairs have in common, from the equal positions (n, POSITIONS) of each."""
    chunks = equal[:, : CHUNKS * CHUNK].reshape(len(equal), CHUNKS, CHUNK)
    common = np.stack([chunks[:, :, kept].all(axis=2) for kept in KEPT], axis=2)
    return common.reshape(len(equal), CHUNKS * len(KEPT)).argmax(axis=1)


def signatures(docs, size=SIZE):
    """(doc_id, n, digest, keys, signature, short) per row: size and digest of its shingle set, the rest null if it is empty.

    `short` holds the low bytes of the signature: what is equal in it may be equal, what differs is not.
    """

    def sign(batches):
        for batch in batches:
            ids, counts, digests, keys, signs, shorts = batch.column(0), [], [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_buffer().to_pybytes(), size)
                counts.append(len(shingles))
                if len(shingles):
                    values = minhashes(shingles, POSITIONS)
                    digests.append(digest(shingles))
                    keys.append(_keys(values))
                    signs.append(values.tobytes())
                    shorts.append(values.astype(np.uint8).tobytes())
                else:
                    digests.append(None)
                    keys.append(None)
                    signs.append(None)
                    shorts.append(None)
            columns = [ids, pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            columns += [pa.array(signs, pa.binary()), pa.array(shorts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "keys", "signature", "short"])

    return docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).cast("binary").alias("text")).mapInArrow(sign, SIGNED)


def _pairs(pairs):
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _near(pairs, signed):
    """The pairs (a, b) whose signatures are equal in LEAST_EQUAL positions at least."""

    def near(batches):
        for batch in batches:
            one, other = (_matrix(batch.column(n)) for n in (2, 3))
            close = (one == other).sum(axis=1) >= LEAST_EQUAL
            yield batch.select([0, 1]).filter(pa.array(close))

    for side in ("a", "b"):
        pairs = pairs.join(signed.select(F.col("doc_id").alias(side), F.col("signature").alias(f"{side}_sign")), side)
    return pairs.select("a", "b", "a_sign", "b_sign").mapInArrow(near, "a long, b long")


def _matrix(column):
    return np.array([np.frombuffer(value.as_py(), np.uint16) for value in column], np.uint16).reshape(len(column), POSITIONS)


def _texts(docs, ids):
    """(doc_id, text) of the documents in `ids`, a table with one column, staged."""
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    wanted = small(stage(ids.toDF("_id").distinct(), "needed"))
    return stage(texts.join(wanted, F.col("doc_id") == F.col("_id"), "left_semi"), "texts")


def _verified(pairs, docs, size, percent):
    """The pairs (a, b) whose full shingle sets are similar."""

    def verify(batches):
        last, one = None, None
        for batch in batches:
            kept = []
            for a, text, other in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last or one[0] != text:
                    last, one = a, (text, shingle_set(text.as_buffer().to_pybytes(), size))
                kept.append(similar(one[1], shingle_set(other.as_buffer().to_pybytes(), size), percent))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    pairs = stage(pairs, "pairs")
    texts = _texts(docs, pairs.select("a").union(pairs.select("b")))
    for side in ("b", "a"):
        pairs = pairs.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"{side}_text")), side)
    return pairs.select("a", "b", "a_text", "b_text").mapInArrow(verify, "a long, b long")


def _members(reps):
    """(key, doc_id, hub) of all buckets of several documents.

    The hub of a bucket is the member that is in the most and largest buckets, so
    one that many others are near; of equal ones the smallest.
    """
    buckets = reps.select(F.explode("keys").alias("key"), "doc_id")
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = stage(buckets.join(shared, "key"), "shared")
    weights = rows.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    most = F.max(F.struct("weight", (-F.col("doc_id")).alias("minus")))
    hubs = rows.join(weights, "doc_id").groupBy("key").agg((-most["minus"]).alias("hub"))
    return stage(rows.join(hubs, "key").select("key", "doc_id", "hub"), "members")


def _mixed(members):
    """(key, n) of the buckets whose members (key, doc_id, component), hubs left out, are in several components."""
    counts = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    return stage(counts.where("lo <> hi").select("key", "n"), "mixed")


def _cells(members, mixed, block, *columns):
    """Members of mixed buckets, cut into blocks, once for each cell: a pair of blocks of one bucket."""
    sizes = mixed.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("key", "doc_id", "component", "block", other)
    cell = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    side = F.signum(F.col("block") - F.col("other")).cast("int")
    return rows.select(cell.alias("cell"), "doc_id", "component", side.alias("side"), *columns)


def _by_cell(batches, compare):
    """compare(rows of one cell) for each cell of batches sorted by it, the first column."""
    left = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = part if left is None else pa.concat_tables([left, part])
        cell = part.column(0).to_numpy()
        cuts = np.concatenate([[0], np.nonzero(np.diff(cell))[0] + 1])
        for start, end in zip(cuts, cuts[1:]):
            yield compare(part.slice(start, end - start))
        left = part.slice(cuts[-1]) if len(part) else None
    if left is not None and len(left):
        yield compare(left)


def _screened(members, mixed, reps):
    """The members (key, doc_id, component) of mixed buckets that have a near one of another component there.

    Short signatures alone are compared, so documents that share a template
    and little else meet here, in wide cells of narrow rows, and go no further.
    """
    rows = _cells(members, mixed, SCREEN_BLOCK, "key").join(reps.select("doc_id", "short"), "doc_id")
    rows = rows.select("cell", "key", "doc_id", "component", "side", "short")

    def screen(table):
        ids, comps, sides = (table.column(n).to_numpy() for n in (2, 3, 4))
        short = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(len(ids), POSITIONS)
        alive = np.zeros(len(ids), bool)
        for i in range(len(ids) - 1):
            rest = slice(i + 1, None)
            apart = (comps[rest] != comps[i]) & (ids[rest] != ids[i]) & ((sides[rest] == 0) | (sides[rest] != sides[i]))
            # Those already known to have one need not be found again by another that has.
            at = np.nonzero(apart & ~(alive[rest] & alive[i]))[0] + i + 1
            near = at[(short[at] == short[i]).sum(axis=1) >= LEAST_EQUAL]
            alive[near], alive[i] = True, alive[i] or len(near) > 0
        return table.select([1, 2, 3]).filter(pa.array(alive)).combine_chunks()

    def cells(batches):
        for table in _by_cell(batches, screen):
            yield from table.to_batches()

    rows = rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(cells, "key long, doc_id long, component long")
    return stage(rows.distinct(), "screened")


def _cell_links(members, mixed, signed, docs, size, percent):
    """Links between components of mixed buckets, as many as join what is similar there.

    Buckets are cut into blocks and each pair of blocks is a cell of at most
    about 2 * BLOCK rows, compared in one task: signatures as matrices, near
    ones on their full sets. A pair is compared in the first bucket it has in
    common; where one of the two is that bucket's hub, the star has done so.
    Pairs of sets the cell has joined already are skipped, so it returns fewer
    links than it has rows.
    """
    number = F.shiftright("key", 48).cast("int")
    rows = _cells(members, mixed, BLOCK, number.alias("number"))
    rows = stage(rows, "cells")
    told = _texts(docs, rows.select("doc_id")).join(signed.select("doc_id", "signature"), "doc_id")
    rows = rows.join(told, "doc_id").select("cell", "doc_id", "component", "side", "number", "signature", "text")

    def compare(table):
        """Links of one cell: among all of a block, or across two."""
        ids, comps, sides, numbers = (table.column(n).to_numpy() for n in range(1, 5))
        signs, texts = _matrix(table.column(5).combine_chunks()), table.column(6)
        joined, sets = Sets(), {}

        def own(i):
            if i not in sets:
                sets[i] = shingle_set(texts[i].as_buffer().to_pybytes(), size)
            return sets[i]

        for i in range(len(ids)):
            rest = slice(i + 1, None)
            apart = (comps[rest] != comps[i]) & (ids[rest] != ids[i]) & ((sides[rest] == 0) | (sides[rest] != sides[i]))
            at = np.nonzero(apart)[0] + i + 1
            equal = signs[at] == signs[i]
            near = equal.sum(axis=1) >= LEAST_EQUAL
            at, equal = at[near], equal[near]
            for j in map(int, at[_first_common(equal) == numbers[i]]):
                if joined.find(int(comps[i])) != joined.find(int(comps[j])) and similar(own(i), own(j), percent):
                    joined.join([int(comps[i]), int(comps[j])])
                    yield ids[i], ids[j]

    def cells(batches):
        yield from _by_cell(batches, lambda table: _batch(compare(table)))

    return _pairs(rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(cells, "a long, b long"))


def _batch(pairs):
    found = np.array(list(pairs), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def near_duplicates(docs, size=SIZE, percent=PERCENT):
    """(doc_id, n_shingles, component_id, kept) for each row of `docs`.

    Documents are linked if 100 * intersection >= percent * union of their sets
    of `size`-word shingles (a document of fewer words is one shingle). The
    component is the smallest doc_id reachable by links; it alone is kept.

    1. Equal sets are one class, held by its smallest doc_id.
    2. Signatures of POSITIONS minhashes of 16 bits: ten chunks of four positions are
       indexed with each position left out in turn (one error a chunk), so that
       all pairs that differ in fewer than 20 of the 40 positions share a bucket.
    3. Each member of a bucket is compared with the bucket's hub (a star, not all
       pairs) and pairs confirmed on the full sets become links.
    4. Buckets whose other members are then in several components are compared
       exhaustively across components, in bounded cells: first the low bytes of the signatures, then those
       that have a near one by their texts; confirmed pairs join.

    Which pairs within a component are compared is open, the components are not.
    A null doc_id links with nothing, has a null component and is kept; empty
    texts and texts without words link with nothing. Rows that repeat a doc_id
    are one document, linked through any of its texts. An empty table gives no rows.
    """
    signed = stage(signatures(docs, size), "signed")
    known = signed.where("doc_id IS NOT NULL AND n > 0")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    rows = stage(known.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep", "digest"), "rows")
    reps = rows.where("doc_id = rep").select("doc_id", "digest").distinct()
    reps = stage(known.dropDuplicates(["doc_id", "digest"]).join(reps, ["doc_id", "digest"], "left_semi"), "reps")
    several = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    several = rows.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).distinct()

    members = _members(reps).where("doc_id <> hub")
    stars = _pairs(members.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")))
    links = _verified(_near(stars, reps), docs, size, percent).union(several)
    found = stage(components(links), "found")
    component = F.coalesce("component", "doc_id").alias("component")
    apart = members.join(found, F.col("doc_id") == F.col("node"), "left").select("key", "doc_id", component)
    apart = stage(apart, "apart")
    near = _screened(apart, _mixed(apart), reps)
    more = _cell_links(near, _mixed(near), reps, docs, size, percent)
    found = components(more.union(found.select("node", "component")))

    ends = rows.select("digest", "rep").distinct().join(found, F.col("rep") == F.col("node"), "left")
    ends = ends.select(F.col("digest").alias("_digest"), F.coalesce("component", "rep").alias("_component"))
    joined = signed.select("doc_id", "n", "digest").join(ends, F.col("digest") == F.col("_digest"), "left")
    component = F.coalesce("_component", "doc_id")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def dedup(docs, size=SIZE, percent=PERCENT):
    """The rows of `docs` that near_duplicates() keeps, in the columns they came with.

    Of rows equal in doc_id all are kept or none.
    """
    kept = near_duplicates(docs, size, percent).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select(F.struct("*").alias("_doc"), docs["doc_id"].alias("_key"))
    rows = rows.join(kept, F.col("_key").eqNullSafe(F.col("_id")), "left_semi")
    return rows.select(*(F.col("_doc")[name].alias(name) for name in docs.columns))
