"""Embedding near-dedup by a flat graph of robustly pruned neighbours."""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.components import Sets, components
from sieveline.staging import small, stage

COSINE = 0.95
# Shards: about one center per SHARD_ROWS vectors, MOST_CENTERS at most. Where more than CROWDED times as many
# are wanted as there are, each has up to MOST_CENTERS fine centers of its own. A cluster of more than
# CELL_ROWS vectors is cut by hash into cells, each of which is searched.
SHARD_ROWS = 2_048
MOST_CENTERS = 4_096
CROWDED = 4
CELL_ROWS = 4_096
# Bits of a fine center's number, below that of its coarse one.
FINE_BITS = 13
TASK_QUERIES = 8_192
# Centers closer than this to an earlier one are left out, so that a dense ball has one.
CENTER_COSINE = 0.6
FINE_COSINE = 0.8
OVERLAP = 2
NEAR, FAR, ALPHA, CANDIDATES = 20, 8, 1.2, 56
# The first try: beam and probed cells. They are raised in turn until the audit is content.
BEAM, PROBES = 4, 4
# A beam that holds any cell: all its rows are compared.
WHOLE = 2**62
# The audit plants a copy of each of PLANTED vectors, turned by a little less than the range, and asks for
# them; and compares up to CLASS_SAMPLE of the vectors found with about as many links, in one scan.
PLANTED, CLASS_SAMPLE = 1_024, 32
RECALL = 0.97


def unit_vectors(vectors, id_col="vec_id", vector_col="embedding"):
    """(id, vector, digest, dim) per row: the vector in double precision with length 1.

    Vector, digest and dim are null where the row can link with nothing: a null
    id, or a vector that is null, empty, zero, or holds null or non-finite components.
    """

    def unit(batches):
        for batch in batches:
            units, digests = [], []
            for known, value in zip(batch.column(0).is_valid().to_pylist(), batch.column(1).to_pylist()):
                own = None
                if known and value and None not in value:
                    own = np.array(value, float)
                    # Scaled first, so that no square over- or underflows.
                    most = np.abs(own).max()
                    own = own / most if np.isfinite(most) and most > 0 else None
                if own is not None:
                    # Adding zero makes equal what differs in the sign of zero only.
                    own = own / np.sqrt((own * own).sum()) + 0.0
                units.append(own)
                digests.append(None if own is None else hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            columns = [batch.column(0), pa.array(units, pa.list_(pa.float64())), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "digest"])

    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("vector"))
    rows = rows.mapInArrow(unit, "id long, vector array<double>, digest binary")
    return rows.withColumn("dim", F.when(F.col("digest").isNotNull(), F.size("vector")))


def _matrix(column, dim):
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, float).reshape(-1, dim)


def _spread(points, cosine=CENTER_COSINE):
    """Of the rows of `points`, those that are no nearer than `cosine` to an earlier one kept."""
    kept = np.empty_like(points)
    n = 0
    for point in points:
        if not n or (kept[:n] @ point).max() < cosine:
            kept[n] = point
            n += 1
    return kept[:n]


def _routed(rows, centers, most):
    """`rows` (id, vector, ...) once for each of their `most` nearest centers, with (center, place).

    `place` is 0 for the nearest center.
    """
    dim = centers.shape[1]
    sent = rows.sparkSession.sparkContext.broadcast(centers)
    place_of = rows.columns.index("vector")

    def route(batches):
        for batch in batches:
            scores = _matrix(batch.column(place_of), dim) @ sent.value.T
            k = min(most, scores.shape[1])
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            at = pa.array(np.repeat(np.arange(len(batch)), k))
            place = pa.array(np.tile(np.arange(k, dtype=np.int32), len(batch)))
            columns = [column.take(at) for column in batch.columns]
            center = pa.array(top.ravel().astype(np.int32))
            yield pa.RecordBatch.from_arrays([*columns, center, place], [*batch.schema.names, "center", "place"])

    added = [T.StructField("center", T.IntegerType()), T.StructField("place", T.IntegerType())]
    return rows.mapInArrow(route, T.StructType([*rows.schema.fields, *added]))


def _fine_centers(reps, centers, share):
    """(coarse, number, vector): up to MOST_CENTERS centers of each of `centers`, drawn by hash among the nodes nearest to it.

    `share` is the number wanted for each node; twice as many are drawn, none near another is kept.
    """
    drawn = reps.where(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(2**40)) < int(2 * share * 2**40))
    order = Window.partitionBy("center").orderBy(F.xxhash64("id"), "id")
    most = MOST_CENTERS
    some = _routed(drawn.select("id", "vector"), centers, 1).withColumn("turn", F.row_number().over(order))
    some = some.where(F.col("turn") <= 2 * most).select("center", "turn", "vector")

    def spread(key, table):
        table = table.sort_by("turn")
        vectors = table.column("vector").combine_chunks()
        kept = _spread(_matrix(vectors, len(vectors[0])), FINE_COSINE)[: -(-len(table) // 2)]
        coarse = pa.array([key[0].as_py()] * len(kept), pa.int32())
        number = pa.array(range(len(kept)), pa.int32())
        return pa.table({"coarse": coarse, "number": number, "vector": pa.array(kept.tolist(), pa.list_(pa.float64()))})

    return some.groupBy("center").applyInArrow(spread, "coarse int, number int, vector array<double>")


def _routed_finely(near, fine, most):
    """What _routed() gave, each row once for each of the nearest fine centers of its center, with (center, place) anew.

    The nearest center gives its `most` nearest fine ones, the second half as many, the third
    a third. `place` is 0 for the nearest fine center of the nearest center. A center's rows come in blocks,
    each with a copy of its fine centers. A center without fine ones has itself.
    """
    blocks = F.ceil(F.count("*") / TASK_QUERIES).cast("int").alias("blocks")
    counted = small(stage(near.groupBy("center").agg(blocks), "blocks"))
    asked = near.join(counted, "center").withColumn("block", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("blocks")).cast("int"))
    asked = asked.select(*near.columns, "block")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_block")
    held = fine.join(counted, F.col("coarse") == F.col("center"))
    held = held.select(F.col("coarse").alias("_coarse"), each, F.col("number").alias("_number"), F.col("vector").alias("_vector"))
    names = near.columns

    def route(key, left, right):
        taken, centers, places = [], [], []
        coarse = left.column("center").to_numpy() << FINE_BITS if len(left) else None
        if len(left) and len(right):
            vectors = left.column("vector").combine_chunks()
            dim = len(vectors[0])
            points, number = _matrix(vectors, dim), right.column("_number").to_numpy()
            own = _matrix(right.column("_vector").combine_chunks(), dim)
            place = left.column("place").to_numpy()
            wanted = np.minimum(-(-most // (place + 1)), len(own))
            for start in range(0, len(points), 512):
                scores = points[start : start + 512] @ own.T
                top = np.argsort(-scores, axis=1, kind="stable")[:, : wanted[start : start + 512].max()]
                rows, nth = np.nonzero(np.arange(top.shape[1]) < wanted[start : start + 512, None])
                taken.append(start + rows)
                centers.append(coarse[start + rows] + number[top[rows, nth]])
                places.append(place[start + rows] + nth)
        elif len(left):
            taken, centers, places = [np.arange(len(left))], [coarse], [left.column("place").to_numpy()]
        empty = np.empty(0, np.int64)
        table = left.select(names).take(pa.array(np.concatenate([empty, *taken]).astype(np.int64)))
        for name, parts in (("center", centers), ("place", places)):
            column = pa.array(np.concatenate([empty, *parts]).astype(np.int32))
            table = table.set_column(names.index(name), name, column)
        return table

    return asked.groupBy("center", "block").cogroup(held.groupBy("_coarse", "_block")).applyInArrow(route, near.schema)


def _dealt(rows, graph, most):
    """_routed() to the centers of `graph`, through both levels if it has two."""
    near = _routed(rows, graph.centers, most)
    return near if graph.fine is None else _routed_finely(stage(near, "coarse"), graph.fine, most)


def robust_prune(point, candidates, most, alpha=ALPHA):
    """Indices of up to `most` rows of `candidates`, nearest first; one is left out if a chosen one is `alpha` times nearer to it than `point`."""
    own = 1 - candidates @ point
    order = np.argsort(own, kind="stable")
    between = 1 - candidates[order] @ candidates[order].T
    own = own[order]
    alive, chosen = np.ones(len(order), bool), []
    for n in range(len(order)):
        if alive[n]:
            chosen.append(order[n])
            if len(chosen) == most:
                break
            alive &= alpha * between[n] > own
    return chosen


def build(points, seed=0):
    """Neighbour lists of the rows of `points`: pruned nearest ones and a few pruned far ones, with their reverse links."""
    n = len(points)
    random = np.random.default_rng(seed)
    links = [set() for _ in range(n)]
    for start in range(0, n, 512):
        scores = points[start : start + 512] @ points.T
        scores[np.arange(len(scores)), start + np.arange(len(scores))] = -np.inf
        k = min(CANDIDATES, n - 1)
        nearest = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else np.empty((len(scores), 0), int)
        for row, near in enumerate(nearest):
            own = start + row
            far = random.integers(0, n, 3 * FAR)
            far = far[far != own]
            chosen = [*near[robust_prune(points[own], points[near], NEAR)], *far[robust_prune(points[own], points[far], FAR)]]
            links[own].update(map(int, chosen))
            for other in chosen:
                links[int(other)].add(own)
    return [np.fromiter(sorted(found), np.int64, len(found)) for found in links]


def search(query, points, links, medoid, beam=BEAM, cosine=COSINE):
    """Rows of `points` within `cosine` of `query` that the graph leads to from `medoid`.

    Greedy: the best of the `beam` best rows not yet expanded is next. The range
    expands: as soon as rows are within `cosine`, all of them are expanded,
    however many, until no more come up. A beam that holds all rows compares all.
    """
    if beam >= len(points):
        return np.nonzero(points @ query >= cosine)[0]
    seen = np.zeros(len(points), bool)
    seen[medoid] = True
    ids, scores = np.array([medoid]), points[[medoid]] @ query
    expanded = np.zeros(1, bool)
    within = []
    while True:
        inside = (scores >= cosine) & ~expanded
        if inside.any():
            turn = np.nonzero(inside)[0]
        else:
            turn = np.nonzero(~expanded)[0]
            if not len(turn):
                break
            turn = turn[[np.argmax(scores[turn])]]
        expanded[turn] = True
        new = np.unique(np.concatenate([links[i] for i in ids[turn]]))
        new = new[~seen[new]]
        seen[new] = True
        ids, scores = np.concatenate([ids, new]), np.concatenate([scores, points[new] @ query])
        expanded = np.concatenate([expanded, np.zeros(len(new), bool)])
        # What is within range goes to the result; only the beam goes on.
        done = (scores >= cosine) & expanded
        within.append(ids[done])
        ids, scores, expanded = ids[~done], scores[~done], expanded[~done]
        waiting = scores >= cosine
        if len(ids) > beam:
            best = np.argpartition(-scores, beam - 1)[:beam]
            keep = waiting.copy()
            keep[best] = True
            ids, scores, expanded = ids[keep], scores[keep], expanded[keep]
    return np.concatenate(within) if within else np.empty(0, np.int64)


def _graph(members):
    """(id, neighbours) of all vectors, the union of their lists over all cells.

    `members` (cell, id, vector) has every vector in OVERLAP clusters; each cell is
    built in one task.
    """

    def built(key, table):
        ids = table.column("id").to_numpy()
        vectors = table.column("vector").combine_chunks()
        order = np.argsort(ids)
        ids = ids[order]
        points = _matrix(vectors, len(vectors[0]))[order]
        links = build(points)
        neighbours = pa.array([ids[found] for found in links], pa.list_(pa.int64()))
        return pa.table({"id": ids, "neighbours": neighbours})

    lists = members.select("cell", "id", "vector").groupBy("cell").applyInArrow(built, "id long, neighbours array<long>")
    return lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))


FOUND = "id long, links long, nodes long, root long, planted long"


def _found(members, graph, queries, beam, cosine):
    """(id, links, nodes, root) rows: partial counts of the links and linked nodes of vectors, and ids in one set with them.

    The queries of a cell come in blocks, each with a copy of the cell's graph.
    Of the vectors found only those count whose nearest center is the cell's, so
    each link counts once for each end; other members lead the way. All links
    found by a task are joined there: one row per id leaves it, not one per link.
    A query with a target is planted: if its target is found, its number is the one thing returned, as `planted`.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    own = (F.col("place") == 0).alias("own")
    held = small(stage(queries.groupBy("cell").agg(F.max("blocks").alias("blocks")), "held"))
    nodes = members.join(held, "cell").join(graph, "id").select("cell", blocks, "id", "vector", "mult", own, "neighbours")
    asked = queries.select(*(F.col(name).alias(f"_{name}") for name in ("cell", "block", "id", "vector", "target")))

    def searched(key, left, right):
        counts, linked, sets, planted = {}, {}, Sets(), []
        if len(left) and len(right):
            ids = left.column("id").to_numpy()
            order = np.argsort(ids)
            ids = ids[order]
            vectors = left.column("vector").combine_chunks()
            dim = len(vectors[0])
            points = _matrix(vectors, dim)[order]
            mult, own = left.column("mult").to_numpy()[order], left.column("own").to_numpy()[order]
            links = []
            neighbours = left.column("neighbours").combine_chunks()
            for row in order:
                named = neighbours[int(row)].values.to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(ids, named), len(ids) - 1)
                links.append(at[ids[at] == named])
            mean = points.mean(axis=0)
            medoid = int(np.argmax(points @ mean))
            roots = ids.copy()
            targets = right.column("_target").to_pylist()
            asked_ids = right.column("_id").to_numpy()
            for query_id, target, query in zip(asked_ids, targets, _matrix(right.column("_vector").combine_chunks(), dim)):
                found = search(query, points, links, medoid, beam, cosine)
                if target is not None:
                    if (own[found] & (ids[found] == target)).any():
                        planted.append(int(query_id))
                    continue
                found = found[own[found] & (ids[found] != query_id)]
                if len(found):
                    query_id = int(query_id)
                    counts[query_id], linked[query_id] = int(mult[found].sum()), len(found)
                    root = sets.join([query_id, *map(int, np.unique(roots[found]))])
                    roots[found] = root
        touched = sorted(sets.parent)
        rows = [(x, counts.get(x, 0), linked.get(x, 0), sets.find(x), None) for x in touched]
        rows += [(None, None, None, None, number) for number in planted]
        names = ["id", "links", "nodes", "root", "planted"]
        return pa.table([pa.array([row[n] for row in rows], pa.int64()) for n in range(5)], names=names)

    return nodes.groupBy("cell", "block").cogroup(asked.groupBy("_cell", "_block")).applyInArrow(searched, FOUND)


@dataclass(frozen=True)
class Centers:
    """Centers, and the fine centers (coarse, number, vector) of each if there are two levels.

    `most` is a number of probes that reaches every cluster.
    """

    centers: np.ndarray
    fine: DataFrame | None
    most: int


@dataclass(frozen=True)
class Graph(Centers):
    """The number of cells of each center (center, cells), vectors by cell, and their neighbours."""

    cells: DataFrame
    members: DataFrame
    lists: DataFrame


def _centers(reps):
    """One level of centers for the nodes `reps`, or two where the first would be crowded."""
    n = reps.count()
    wanted = max(1, -(-n // SHARD_ROWS))
    first = min(MOST_CENTERS, wanted)
    drawn = reps.orderBy(F.xxhash64("id"), "id").limit(2 * first).select("vector").toArrow().column("vector")
    centers = _spread(_matrix(drawn.combine_chunks(), len(drawn[0])))[:first]
    if wanted <= CROWDED * len(centers):
        return Centers(centers, None, len(centers))
    fine = stage(_fine_centers(reps, centers, wanted / n), "fine")
    largest = fine.agg(F.max("number")).first()[0]
    return Centers(centers, fine, len(centers) * (1 + (largest or 0)))


def _built(reps):
    """The graph of `reps` (id, vector, mult), all of one length."""
    level = _centers(reps)
    routed = stage(_dealt(reps.select("id", "vector", "mult"), level, OVERLAP), "routed")
    cells = routed.groupBy("center").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / CELL_ROWS)).cast("int").alias("cells"))
    cells = small(stage(cells, "cells"))
    cell = F.col("center").cast("long") * F.lit(2**21) + F.pmod(F.xxhash64("id"), F.col("cells"))
    members = routed.join(cells, "center").withColumn("cell", cell).select("cell", "place", "id", "vector", "mult")
    return Graph(level.centers, level.fine, level.most, cells, members, stage(_graph(members), "graph"))


def _searched(graph, queries, beam, probes, cosine):
    """Partial counts of one way of searching for `queries` (id, vector, target), staged."""
    routed = stage(_dealt(queries.select("id", "vector", "target"), graph, probes), "asked")
    blocks = F.greatest(F.lit(1), F.ceil(F.count("*") / TASK_QUERIES)).cast("int").alias("blocks")
    blocks = small(stage(routed.groupBy("center").agg(blocks), "blocks"))
    asked = routed.join(blocks, "center").join(graph.cells, "center")
    asked = asked.withColumn("n", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    asked = asked.withColumn("cell", F.col("center").cast("long") * F.lit(2**21) + F.col("n"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "id"), F.col("blocks")).cast("int"))
    return stage(_found(graph.members, graph.lists, asked, beam, cosine), "found")


def turned(points, cosine, seed=0):
    """Each row turned in a random direction, to a cosine halfway between `cosine` and 1 at most and just above it at least."""
    random = np.random.default_rng(seed)
    aside = random.normal(size=points.shape)
    aside -= (aside * points).sum(axis=1, keepdims=True) * points
    size = np.sqrt((aside * aside).sum(axis=1, keepdims=True))
    aside = np.divide(aside, size, out=np.zeros_like(aside), where=size > 1e-9)
    near = cosine + (1 - cosine) * random.uniform(1e-6, 0.5, (len(points), 1))
    made = near * points + np.sqrt(1 - near * near) * aside
    return made / np.sqrt((made * made).sum(axis=1, keepdims=True))


def planted(reps, dim, cosine, n=PLANTED):
    """(id, vector, target): `n` vectors drawn by hash, turned by a little less than the range. No link of theirs is ever missing."""
    drawn = reps.orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(n).select("id", "vector").toArrow()
    points = turned(_matrix(drawn.column("vector").combine_chunks(), dim), cosine) if drawn.num_rows else np.empty((0, dim))
    rows = [(number, vector.tolist(), target) for number, (vector, target) in enumerate(zip(points, drawn.column("id").to_pylist()))]
    return reps.sparkSession.createDataFrame(rows, "id long, vector array<double>, target long"), len(rows)


def _content(graph, copies, n, cosine, recall, beam, probes):
    """(beam, probes, share of the planted copies that find their vector), the first try that reaches `recall`."""
    while True:
        found = _searched(graph, copies, beam, probes, cosine)
        share = found.where("planted IS NOT NULL").select("planted").distinct().count() / n
        if share >= recall or beam == WHOLE and probes >= graph.most:
            return beam, probes, share
        beam, probes = _raised(graph, beam, probes)


def _raised(graph, beam, probes):
    """The next try: half as many probes more, or twice the beam where probes are the more of the two or all."""
    if probes < graph.most and probes <= beam:
        return beam, probes + max(1, probes // 2)
    return (2 * beam if 2 * beam <= CELL_ROWS else WHOLE), probes


def _there(reps, drawn, dim, cosine):
    """{id: (links, nodes)} of those of the vectors `drawn` (an Arrow table of id, vector) that have any, by brute force over all of `reps`."""
    points = _matrix(drawn.column("vector").combine_chunks(), dim) if drawn.num_rows else np.empty((0, dim))
    sent = reps.sparkSession.sparkContext.broadcast((drawn.column("id").to_numpy(), points))

    def count(batches):
        own, queries = sent.value
        links, nodes = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for batch in batches:
            ids, mult, vectors = batch.column(0).to_numpy(), batch.column(2).to_numpy(), _matrix(batch.column(1), dim)
            for start in range(0, len(own), 512):
                at = slice(start, start + 512)
                rows, close = np.nonzero(vectors @ queries[at].T >= cosine)
                other = ids[rows] != own[at][close]
                rows, close = rows[other], close[other]
                np.add.at(links[at], close, mult[rows])
                np.add.at(nodes[at], close, 1)
        any_ = nodes > 0
        yield pa.RecordBatch.from_arrays([pa.array(own[any_]), pa.array(links[any_]), pa.array(nodes[any_])], ["id", "links", "nodes"])

    counted = reps.select("id", "vector", "mult").mapInArrow(count, "id long, links long, nodes long")
    rows = counted.groupBy("id").agg(F.sum("links").alias("links"), F.sum("nodes").alias("nodes")).collect()
    sent.destroy()
    return {row["id"]: (row["links"], row["nodes"]) for row in rows}


def audit(reps, found, dim, cosine=COSINE, queries=PLANTED):
    """(links found, links there) of `queries` vectors drawn by hash, by brute force over all of `reps`."""
    drawn = reps.orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(queries).select("id", "vector").toArrow()
    there = {i: links for i, (links, _) in _there(reps, drawn, dim, cosine).items()}
    counts = _of(found, there, "links")
    return sum(min(counts.get(i, 0), links) for i, links in there.items()), sum(there.values())


def _of(found, ids, column):
    """{id: sum of `column`} of those of the few `ids` that `found` has."""
    wanted = F.broadcast(found.sparkSession.createDataFrame([(i,) for i in ids], "id long"))
    return {row["id"]: row["n"] for row in found.join(wanted, "id").groupBy("id").agg(F.sum(column).alias("n")).collect()}


def linked_sample(reps, found, dim, cosine=COSINE, most=CLASS_SAMPLE):
    """{id: nodes linked} of vectors that were found to have links, by brute force in one scan of `reps`.

    Up to `most` drawn by hash of each class of vectors with about as many linked nodes (see recalls()),
    so a hot group does not stand for all. Of a table without links none is drawn.
    """
    counts = found.where("id IS NOT NULL").groupBy("id").agg(F.sum("nodes").alias("n")).where("n > 0")
    place = F.row_number().over(Window.partitionBy(F.floor(F.log2("n"))).orderBy(F.xxhash64("id"), "id"))
    # At most 63 classes.
    some = stage(counts.withColumn("place", place).where(F.col("place") <= most).select("id"), "drawn")
    drawn = reps.join(F.broadcast(some), "id").select("id", "vector").toArrow()
    return {i: nodes for i, (_, nodes) in _there(reps, drawn, dim, cosine).items()} if drawn.num_rows else {}


def recalls(there, found):
    """(size class, recall) of each vector of a linked_sample(): the share of its linked nodes, not of rows, that `found` has.

    Vectors with 1, 2 to 3, 4 to 7 ... linked nodes are one class.
    """
    counts = _of(found, there, "nodes") if there else {}
    return [(nodes.bit_length(), min(counts.get(i, 0), nodes) / nodes) for i, nodes in there.items()]


def least_mean(pairs):
    """The least mean recall of any size class; 1 if there are no linked vectors at all."""
    classes = {}
    for size, own in pairs:
        classes.setdefault(size, []).append(own)
    return min((sum(own) / len(own) for own in classes.values()), default=1.0)


def near_vectors(vectors, cosine=COSINE, recall=RECALL, id_col="vec_id", vector_col="embedding"):
    """(vec_id, n_links, component_id, kept, audited_recall) per row of `vectors`.

    Rows are linked if the cosine of their vectors, in double precision, is
    `cosine` or more; n_links counts them, component_id is the smallest vec_id
    that links reach. Only pairs whose cosine was computed are links.

    1. Equal vectors are one node, held by their smallest vec_id.
    2. Centers are drawn among the nodes, none near another; where there are too few for the rows, each has
       fine centers of its own, which no task or broadcast holds together. Each node belongs to
       the clusters of its OVERLAP nearest centers (of two levels, to OVERLAP of the nearest one and to
       fewer of the next ones); big clusters are cut into cells.
    3. Per cell a graph is built: the CANDIDATES nearest nodes, robustly pruned, and
       some far ones, in both directions. A node's lists from all cells are united.
    4. Each node is searched for in the cells of its nearest centers, PROBES at first, greedily
       from the medoid, expanding all nodes within range.
    5. Beam and probed cells are those for which enough planted queries find what they were made
       from: copies of nodes drawn by hash, turned by a little less than the
       range; so the audit has links to find in any table. They are only asked for, never found.
    6. After the search, nodes with links of every class of about as many linked nodes are compared with all others,
       in one scan. If the mean recall of a class is below `recall`, the search is repeated with a wider
       beam or more probes. Once all cells are probed and the beam exceeds CELL_ROWS, cells are
       compared whole, which finds every link.

    audited_recall is the least of the planted share and the mean recalls of the classes; null
    only if there are no nodes.

    Null ids and unusable vectors (see unit_vectors()) have no links; their component is
    their own vec_id. Vectors of different length are not compared. Rows that
    repeat a vec_id are one node of the components; each counts as a link of
    others. An empty table gives no rows.
    """
    every = stage(unit_vectors(vectors, id_col, vector_col), "units")
    known = every.where("digest IS NOT NULL")
    classes = known.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("mult"))
    rows = stage(known.select("id", "digest").join(classes, "digest"), "rows")
    reps = rows.where("id = rep").select("id", "digest", "mult").distinct()
    reps = stage(known.dropDuplicates(["id", "digest"]).join(reps, ["id", "digest"]).select("id", "vector", "dim", "mult"), "reps")
    several = rows.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("id", "a")
    joins = rows.join(several, "id").select("a", F.col("rep").alias("b"))

    counts = every.sparkSession.createDataFrame([], "id long, links long, root long")
    audited = []
    for (dim,) in sorted(map(tuple, reps.select("dim").distinct().collect())):
        own = reps.where(F.col("dim") == dim)
        graph = _built(own)
        copies, n = planted(own, dim, cosine)
        beam, probes, share = _content(graph, copies, n, cosine, recall, BEAM, PROBES)
        queries = own.withColumn("target", F.lit(None).cast("long"))
        while True:
            found = _searched(graph, queries, beam, probes, cosine).where("id IS NOT NULL")
            reached = least_mean(recalls(linked_sample(own, found, dim, cosine), found))
            if reached >= recall or beam == WHOLE and probes >= graph.most:
                break
            beam, probes = _raised(graph, beam, probes)
        audited.append(min(share, reached))
        counts = counts.union(found.select("id", "links", "root"))

    links = stage(counts.select(F.col("root").alias("a"), F.col("id").alias("b")).union(joins), "links")
    places = components(links)
    sums = counts.groupBy("id").agg(F.sum("links").alias("links"))
    nodes = rows.select("digest", "rep", "mult").distinct().join(sums, F.col("rep") == F.col("id"), "left").drop("id")
    nodes = nodes.join(places, F.col("rep") == F.col("node"), "left").select(
        "digest",
        (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    placed = known.select("id", "digest").join(nodes, "digest").select("id", "n_links", "component_id")
    alone = every.where("digest IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return placed.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(min(audited, default=None)).cast("double").alias("audited_recall"),
    )
