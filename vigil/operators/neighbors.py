"""Exact k nearest neighbours inside each class.

The rows of a class are dealt into query blocks of bounded bytes by a hash of their id.
Every block is one run of rows in one task: first its queries, then all rows of the class
as candidates, which stream past while the task keeps each query's ``k`` best so far.
Only candidates are replicated (once per block), nothing is merged afterwards, and memory
is one block and one slab of distances whatever the class or the dimension is.

Distances are summed component by component in order and ranked unrounded, so any engine
that folds the same way ranks the same; ties go to the smaller id.

Inside a block the queries lie in cells around pivots.  By the triangle inequality a candidate
can only be among the ``k`` best of a query if it is no farther from the query's pivot than
the query itself and the query's ``k``-th best distance so far together (at first: its
``k``-th best inside its own cell).  A candidate is thus compared with the pivots, and with the
queries of those cells only that it may still belong to.  What is left out cannot be a
neighbour, so the result is exact; where all rows are about equally far apart, nothing is left
out and work stays quadratic in the class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 4 << 20   # vectors of one query block
SLAB_BYTES = 16 << 20   # distances held at once
CELL_ROWS, CELL_MOST = 32, 512   # queries around a pivot: least expected, most held together
#: rounding of a distance is far below this share of it, or (squares underflow) this length
SLACK, TINY = 1 + 1e-9, 1e-150


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``, component by component."""
    d2 = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        d2 += diff * diff
    return d2


def _kth(d2: np.ndarray, k: int) -> np.ndarray:
    """Per row the ``k``-th smallest number; infinite where there are fewer or it is no number."""
    if d2.shape[1] < k:
        return np.full(len(d2), np.inf)
    kth = np.partition(d2, k - 1, axis=1)[:, k - 1]
    return np.where(np.isnan(kth), np.inf, kth)


class _Best:
    """The ``k`` best candidates so far of one cell's queries, with their vectors if these are
    ``wanted``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, pivot: np.ndarray, wanted: bool = True):
        self.ids, self.vectors, self.k, self.wanted = ids, vectors, k, wanted
        self.radius = np.sqrt(squared(vectors, pivot[None, :])[:, 0])
        own = squared(vectors, vectors)
        np.fill_diagonal(own, np.inf)
        self.kth = _kth(own, k)       # an upper bound: the cell's rows are candidates too
        self._bound()
        self.d2 = np.empty((len(ids), 0))
        self.nbr = np.empty((len(ids), 0), ids.dtype)
        self.nbr_vec = np.empty((len(ids), 0, vectors.shape[1]))

    def _bound(self) -> None:
        #: no candidate farther from the pivot is a neighbour; no number bounds nothing
        self.reach = float(np.max((self.radius + np.sqrt(self.kth)) * SLACK + TINY))

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        d2 = squared(self.vectors, vectors)
        own = self.ids[:, None] == ids[None, :]
        d2[own] = np.inf                                # a row is not its own neighbour
        if self.d2.shape[1] == self.k:                  # only what beats or ties the worst
            live = np.flatnonzero((d2 <= self.d2[:, -1, None]).any(axis=0))
            if not len(live):
                return
            d2, ids, vectors = d2[:, live], ids[live], vectors[live]
        all_d2 = np.hstack([self.d2, d2])
        all_ids = np.hstack([self.nbr, np.broadcast_to(ids, d2.shape)])
        rank = all_ids
        if all_ids.dtype == object:
            rank = np.unique(all_ids, return_inverse=True)[1].reshape(all_ids.shape)
        order = np.lexsort((rank, all_d2), axis=-1)[:, :self.k]
        rows = np.arange(len(self.ids))[:, None]
        if self.wanted:
            seen = self.d2.shape[1]
            old = order < seen
            vec = vectors[np.where(old, 0, order - seen)]
            if seen:
                vec[old] = self.nbr_vec[np.broadcast_to(rows, order.shape)[old], order[old]]
            self.nbr_vec = vec
        self.d2, self.nbr = all_d2[rows, order], all_ids[rows, order]
        self.kth = np.minimum(self.kth, _kth(self.d2, self.k))
        self._bound()

    def batches(self, cls, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        n, width = self.d2.shape
        ok = np.isfinite(self.d2).ravel()
        if not ok.any():
            return
        rank = np.broadcast_to(np.arange(1, width + 1), (n, width)).ravel()[ok]
        columns = [
            pa.array(np.repeat(self.ids, width)[ok], schema.field(0).type),
            pa.array([cls] * len(rank), schema.field(1).type),
            pa.array(rank, pa.int32()), pa.array(self.nbr.ravel()[ok], schema.field(3).type),
            pa.array(self.d2.ravel()[ok])]
        if self.wanted:
            vec = self.nbr_vec.reshape(n * width, -1)[ok]
            ends = np.arange(len(vec) + 1, dtype=np.int32) * vec.shape[1]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(vec.ravel())))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


class _Block:
    """The queries of one block, in cells around pivots: rows at even steps of the block.  A
    cell that many rows share is held in pieces."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, cell_rows: int = CELL_ROWS,
                 wanted: bool = True):
        n = len(ids)
        self.pivots = vectors[::max(cell_rows, int(n ** 0.5))]
        self.step = max(k, SLAB_BYTES // (8 * max(CELL_MOST, len(self.pivots))))
        near = np.concatenate([np.argmin(squared(vectors[at:at + self.step], self.pivots), axis=1)
                               for at in range(0, n, self.step)])
        ends = np.cumsum(np.bincount(near, minlength=len(self.pivots)))[:-1]
        cells = np.split(np.argsort(near, kind="stable"), ends)
        self.cells = [(c, _Best(ids[rows[at:at + CELL_MOST]], vectors[rows[at:at + CELL_MOST]], k,
                                self.pivots[c], wanted))
                      for c, rows in enumerate(cells) for at in range(0, len(rows), CELL_MOST)]
        self.pairs = self.compared = 0    # candidates with queries; with queries or pivots

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(ids), self.step):
            own, vec = ids[at:at + self.step], vectors[at:at + self.step]
            apart = np.sqrt(squared(self.pivots, vec))
            self.compared += apart.size
            for c, best in self.cells:
                self.pairs += len(own) * len(best.ids)
                live = np.flatnonzero(~(apart[c] > best.reach))
                if len(live):
                    self.compared += len(live) * len(best.ids)
                    best.offer(own[live], vec[live])

    def batches(self, cls, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for _, best in self.cells:
            yield from best.batches(cls, schema)


def _stream(k: int, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = None, None
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if schema is None:
                id_type, cls_type = batch.schema.field("id").type, batch.schema.field("cls").type
                schema = pa.schema([("id", id_type), ("cls", cls_type), ("rank", pa.int32()),
                                    ("nbr_id", id_type), ("d2", pa.float64()),
                                    *([("nbr_vec", pa.list_(pa.float64()))] if wanted else [])])
            cls, qb, side = (batch.column(c).to_pylist() for c in ("cls", "qb", "side"))
            own = batch.column("id").to_numpy(zero_copy_only=False)
            vec = batch.column("vec").flatten().to_numpy().reshape(len(own), -1)
            key = list(zip(cls, qb, side))
            cuts = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if key[a][:2] != block:
                    if best is not None:
                        yield from best.batches(block[0], schema)
                    block, best, ids, vectors = key[a][:2], None, [], []
                if side[a] == 0:
                    ids.append(own[a:b])
                    vectors.append(vec[a:b])
                elif ids or best is not None:
                    if best is None:
                        best = _Block(np.concatenate(ids), np.concatenate(vectors), k, wanted=wanted)
                        ids, vectors = [], []
                    best.offer(own[a:b], vec[a:b])
        if best is not None:
            yield from best.batches(block[0], schema)
    return run


def knn_within_class(df: DataFrame, id_col: str, class_col: str, vec_col: str, k: int = 5,
                     block_rows: int | None = None, seed=42,
                     vectors: str | None = None) -> DataFrame:
    """``(id, class, rank, nbr_id, d2)``: for every row its ``k`` nearest other rows of
    the same class by squared Euclidean distance; ties by smaller ``nbr_id``.
    ``id_col`` must be unique and not null, vectors of one length.  With ``vectors`` the
    neighbour's vector is returned under that name, so no join has to fetch it."""
    base = df.select(F.col(id_col).alias("id"), F.col(class_col).alias("cls"),
                     F.col(vec_col).cast("array<double>").alias("vec"))
    if block_rows is None:
        first = base.select(F.size("vec")).first()
        block_rows = max(16, BLOCK_BYTES // (8 * max(1, first[0] if first else 1)))
    sizes = base.groupBy(F.col("cls").alias("__cls")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("nb"))
    rows = base.join(sizes, F.col("cls").eqNullSafe(F.col("__cls"))).drop("__cls")
    mine = F.pmod(F.xxhash64(F.lit(str(seed)), "id"), F.col("nb"))
    queries = rows.select("cls", mine.alias("qb"), F.lit(0).alias("side"), "id", "vec")
    cands = rows.select("cls", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1)).alias("qb"),
                        F.lit(1).alias("side"), "id", "vec")
    kinds = base.schema
    schema = T.StructType([T.StructField("id", kinds["id"].dataType), T.StructField("cls", kinds["cls"].dataType),
                           T.StructField("rank", T.IntegerType()), T.StructField("nbr_id", kinds["id"].dataType),
                           T.StructField("d2", T.DoubleType())])
    if vectors:
        schema = schema.add("nbr_vec", T.ArrayType(T.DoubleType()))
    top = (queries.unionByName(cands).repartition("cls", "qb")
                  .sortWithinPartitions("cls", "qb", "side", "id").mapInArrow(_stream(k, bool(vectors)), schema))
    out = [F.col("id").alias(id_col), F.col("cls").alias(class_col), "rank", "nbr_id", "d2"]
    return top.select(*out, *([F.col("nbr_vec").alias(vectors)] if vectors else []))
