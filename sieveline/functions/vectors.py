"""Distance expressions and the Arrow kernels that run inside tasks."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

PAIR_CELLS = 1_000_000
CACHED_CELLS = 100_000
# Squared lengths up to which sums in single precision are finite.
SINGLE_SIZE = 1e30


def dot(a, b):
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def euclidean(a, b):
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def norm(a):
    return F.sqrt(dot(a, a))


def cosine(a, b):
    """Cosine similarity; a zero vector is similar to nothing."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def vector_fault(col, dim):
    """Why a vector cannot be compared with vectors of `dim` numbers; null if it can."""
    vector = F.col(col) if isinstance(col, str) else col
    endless = F.lit(float("inf"))
    return (
        F.when(vector.isNull(), "missing embedding")
        .when(F.size(vector) != dim, "wrong length")
        .when(F.exists(vector, lambda x: x.isNull()), "missing value")
        .when(F.exists(vector, lambda x: F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == endless)), "not a number")
    )


def comparable(col, dim):
    return vector_fault(col, dim).isNull()


def closeness(distance):
    return F.lit(1.0) / (F.lit(1.0) + distance)


def as_matrix(column, element="float", dtype=np.float64):
    """Rows of an Arrow list column as a float64 matrix, or with dtype None in the precision they have.

    With element `bfloat16` the values are first rounded to its 8 significant
    bits, half to even, as an index with that element type stores them.
    """
    values = column.flatten().to_numpy(zero_copy_only=False)
    if element == "bfloat16":
        bits = values.astype(np.float32).view(np.uint32)
        values = ((bits + 0x7FFF + ((bits >> 16) & 1)) & 0xFFFF0000).astype(np.uint32).view(np.float32)
    return (values if dtype is None else values.astype(dtype)).reshape(len(column), -1)


def exact_distances(rows, row, others, other, metric):
    """Distances of the pairs (rows[row], others[other]).

    Each pair is summed by itself, in the same way wherever it occurs.
    """
    found = np.empty(len(row))
    step = max(1, CACHED_CELLS // rows.shape[1])
    for start in range(0, len(row), step):
        part = slice(start, start + step)
        a, b = rows[row[part]], others[other[part]]
        if metric == "euclidean":
            a -= b
            found[part] = np.sqrt(_dots(a, a))
        else:
            size = np.sqrt(_dots(a, a) * _dots(b, b))
            found[part] = 1.0 - np.divide(_dots(a, b), size, out=np.zeros(len(size)), where=size > 0)
    return found


def _dots(a, b):
    return np.einsum("ij,ij->i", a, b)


class RunningTopK:
    """The k nearest vectors per query seen so far, over all batches of a task.

    A matrix product screens each batch against the k-th distance held so
    far, in single precision where that says enough, with a margin above its rounding error. Pairs that pass get their
    distance summed directly, so the result does not depend on batching.
    Equal distances are ordered by id.
    """

    def __init__(self, queries, k, metric="euclidean", bound=None):
        self.queries = queries
        self.sizes = (queries * queries).sum(axis=1)
        self.k = k
        self.metric = metric
        self.bound = np.full(len(queries), np.inf) if bound is None else np.array(bound)
        self.single = None
        self.kept = None
        self.waiting = []
        self.waiting_rows = 0

    def add(self, ids, vectors, columns=None):
        """Compare `vectors` with all queries, or with those in `columns`."""
        step = max(1, PAIR_CELLS // max(1, len(self.queries) if columns is None else len(columns)))
        for start in range(0, len(vectors), step):
            rows = vectors[start : start + step].astype(np.float64, copy=False)
            self._add_rows(ids.slice(start, step), rows, slice(None) if columns is None else columns)

    def _add_rows(self, ids, rows, columns):
        near = self._near_single(rows, columns)
        row, col = self._near_double(rows, columns) if near is None else near
        if not len(row):
            return
        col = col if isinstance(columns, slice) else columns[col]
        found = exact_distances(rows, row, self.queries, col, self.metric)
        self.waiting.append(
            pa.table({"query": pa.array(col), "distance": pa.array(found), "id": ids.take(pa.array(row))})
        )
        self.waiting_rows += len(row)
        if self.waiting_rows > max(20_000, self.kept.num_rows if self.kept else 0):
            self.compact()

    def _near_single(self, rows, columns):
        """Rows and queries of the pairs that products in single precision do not rule out, for Euclidean distances.

        A pair is within the bound b if r.q - r.r / 2 >= (q.q - b * b) / 2; the last number of the
        vectors multiplied gives the second term, and sizes are taken less by above twice
        the rounding error. None while bounds are open or where a fiftieth of the pairs
        would pass, as with vectors close together and far from zero.
        """
        bound = self.bound[columns]
        if self.metric != "euclidean" or not np.isfinite(bound).all():
            return None
        sizes, row_sizes = self.sizes[columns], _dots(rows, rows)
        if max(row_sizes.max(), sizes.max(initial=0.0), bound.max(initial=0.0) ** 2) > SINGLE_SIZE:
            return None
        if self.single is None:
            self.single = np.ones((len(self.queries), rows.shape[1] + 1), np.float32)
            self.single[:, :-1] = self.queries
        loss = 4e-7 * (rows.shape[1] + 8)
        single = np.empty((len(rows), rows.shape[1] + 1), np.float32)
        single[:, :-1], single[:, -1] = rows, row_sizes * (loss - 1) / 2
        least = (sizes * (1 - loss) - bound * bound * (1 + loss)) / 2 - 1e-9
        products = single @ self.single[columns].T
        place = np.flatnonzero(products >= least.astype(np.float32))
        return np.divmod(place, products.shape[1]) if 50 * len(place) <= products.size else None

    def _near_double(self, rows, columns):
        """Rows and queries of the pairs that products in double precision do not rule out."""
        screened, margin = self._screen(rows, columns)
        limit = self.bound[columns]
        limit = (limit * limit if self.metric == "euclidean" else limit)[None, :] + margin
        if len(rows) > self.k:
            kth = np.partition(screened, self.k - 1, axis=0)[self.k - 1]
            limit = np.minimum(limit, kth[None, :] + 2 * margin.max())
        return np.nonzero(screened <= limit)

    def _screen(self, rows, columns):
        queries, sizes = self.queries[columns], self.sizes[columns]
        row_sizes = (rows * rows).sum(axis=1)
        products = rows @ queries.T
        if self.metric == "euclidean":
            total = row_sizes[:, None] + sizes[None, :]
            return total - 2.0 * products, 1e-9 * (1.0 + total)
        size = np.sqrt(row_sizes[:, None] * sizes[None, :])
        cos = np.divide(products, size, out=np.zeros_like(products), where=size > 0)
        return 1.0 - cos, np.full_like(products, 1e-9)

    def compact(self):
        """Reduce what is held to k rows per query and tighten the bounds."""
        tables = ([self.kept] if self.kept is not None else []) + self.waiting
        self.kept, self.waiting, self.waiting_rows = None, [], 0
        if not tables:
            return
        table = pa.concat_tables(tables)
        del tables
        query, distance = table["query"].to_numpy(), table["distance"].to_numpy()
        order = np.lexsort((distance, query))
        if self._cut_by_id(query[order], distance[order]):
            keys = [("query", "ascending"), ("distance", "ascending"), ("id", "ascending")]
            order = pc.sort_indices(table, sort_keys=keys).to_numpy()
        place = self._places(query[order])
        order = order[place < self.k]
        last = order[place[place < self.k] == self.k - 1]
        self.bound[query[last]] = np.minimum(self.bound[query[last]], distance[last])
        self.kept = table.take(pa.array(order)).combine_chunks()

    @staticmethod
    def _places(query):
        return np.arange(len(query)) - np.searchsorted(query, query, side="left")

    def _cut_by_id(self, query, distance):
        """True if a query's k-th distance is also that of a row after it, so that ids decide which row stays."""
        at = np.flatnonzero(self._places(query) == self.k)
        return bool((distance[at] == distance[at - 1]).any())

    def result(self):
        self.compact()
        return self.kept


class References:
    """Vectors that others are compared with by cosine, and their copies of unit length in single precision."""

    def __init__(self, vectors):
        self.vectors, self.unit = vectors, _unit(vectors)


def _unit(vectors):
    sizes = np.sqrt(_dots(vectors, vectors))[:, None]
    return np.divide(vectors, sizes, out=np.zeros(vectors.shape, np.float32), where=sizes > 0, casting="same_kind")


def most_similar_rows(rows, references):
    """Index and cosine of the most similar one of `references`; the first on a tie.

    Products in single precision screen the references, with a margin above twice their
    rounding error; those that pass are compared in double precision. Rows are
    taken in steps, so that memory does not grow with the references.
    """
    references = references if isinstance(references, References) else References(references)
    best = np.full(len(rows), -np.inf)
    index = np.zeros(len(rows), dtype=np.int64)
    margin = 4e-7 * (rows.shape[1] + 8)
    step = max(1, 4 * PAIR_CELLS // len(references.vectors))
    for start in range(0, len(rows), step):
        part = rows[start : start + step]
        screened = _unit(part) @ references.unit.T
        row, col = np.nonzero(screened >= screened.max(axis=1, keepdims=True) - np.float32(margin))
        cos = 1.0 - exact_distances(part, row, references.vectors, col, "cosine")
        order = np.lexsort((col, -cos, row))
        row, col, cos = row[order], col[order], cos[order]
        first = np.r_[True, row[1:] != row[:-1]]
        index[start + row[first]], best[start + row[first]] = col[first], cos[first]
    return index, best
