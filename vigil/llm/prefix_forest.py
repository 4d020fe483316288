"""Approximate nearest neighbours by a hash-prefix forest.

Every tree hashes a vector to a long bit string (signs of random projections) and keeps
the strings of a block of vectors in a sorted array.  A query descends to its
longest-prefix match in each tree; then all trees ascend together, one bit at a time, and
score the vectors that share the query's prefix in some tree, until half as many candidates
again bring no vector among the best any more (and a multiple of ``k`` has been seen).  Where
neighbours are much nearer than the rest this ends early; where they are not it looks at most
of a block, as any search that is to find nine tenths of them must.

Vectors are dealt over blocks by bands of like length, so that a band's scale fits its
vectors, and within a band by a hash of the id.  Inner products are searched as angles: vectors
get one more component that gives all of a band the length of its longest.  The stated query
set is streamed past the blocks of the longest vectors first; what a query finds there is a
bound that a shorter band has to beat (query length times the band's longest), else the query
does not travel there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.store import keep

TREES, BITS, SEED = 48, 32, 11
#: rows that a block holds on average
BLOCK_ROWS = 8192
#: candidates that a query scores in a block at least, as a multiple of k; by how much they
#: grow until the next look at the best
LEAST, GROWTH = 8, 1.5
#: a query that scores more than one in so many rows of a block does so by a matrix product
WIDE = 16
#: such a query marks the rows of a prefix of at most so many bits by bitmaps
SHORT = 8
#: lengths within a band differ by this factor at most (the last band holds all shorter ones)
BAND, BANDS = 1.2, 40
#: rows of the bands, from the longest on, that every query looks at
FIRST_ROWS = 1024


class Forest:
    """The sorted arrays over one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float,
                 trees: int = TREES, least: int = LEAST, growth: float = GROWTH):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.least, self.growth, self.asked, self.scored = least, growth, 0, 0
        rng = np.random.default_rng(SEED)
        self.planes = rng.standard_normal((trees * BITS, vectors.shape[1] + 1))
        scaled = self.vectors / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1, keepdims=True)))
        codes = self._codes(np.hstack([scaled, rest]))
        self.order = np.argsort(codes, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(codes, self.order.T, axis=0).T.copy()

    def _codes(self, points: np.ndarray) -> np.ndarray:
        """Points x trees: hash strings as unsigned integers, first bit highest."""
        bits = (points @ self.planes.T > 0).reshape(len(points), -1, BITS)
        weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        return bits @ weights

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in each sorted array the strings with a query's prefix start and end, by
        query, tree and number of last bits not compared."""
        points = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        codes = self._codes(np.hstack([points, np.zeros((len(points), 1))]))
        free = (1 << np.arange(BITS + 1)).astype(np.int64)
        low = codes[:, :, None] // free * free
        lo, hi = np.empty(low.shape, np.int32), np.empty(low.shape, np.int32)
        for t, array in enumerate(self.sorted):
            lo[:, t] = np.searchsorted(array, low[:, t])
            hi[:, t] = np.searchsorted(array, low[:, t] + free)
        return lo, hi

    @cached_property
    def maps(self) -> list[np.ndarray]:
        """The rows of every prefix of ``SHORT`` bits, then of one bit less and so on, by tree and
        prefix, a bit a row: short prefixes hold so many rows that this is faster than a range."""
        maps = []
        for order, codes in zip(self.order, self.sorted):
            has = np.zeros((1 << SHORT, len(order)), bool)
            has[codes >> (BITS - SHORT), order] = True
            maps.append(np.packbits(has, axis=1))
        levels = [np.stack(maps)]
        while levels[-1].shape[1] > 1:
            levels.append(levels[-1][:, ::2] | levels[-1][:, 1::2])
        return levels

    def _ascend(self, query: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int,
                products: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows that share a prefix with the query in some tree, longest prefixes first, a whole
        level at a time, until the last part of them had none of the ``k`` best; and their inner
        products, each found once (or taken from ``products``, those of all rows)."""
        n = len(self.ids)
        enough = min(n, self.least * k)
        reach = (hi - lo).sum(axis=0)  # with repeats: an upper bound of the union
        marked, seen = np.zeros(n, bool), np.zeros(n, bool)
        rough = np.empty(n) if products is None else products
        best = np.empty(0)
        for level in range(int(np.argmax(reach >= enough)), BITS + 1):
            if reach[level] < enough:  # cannot be enough: the next level has these too
                continue
            if products is not None and level >= BITS - SHORT:
                some = np.flatnonzero(lo[:, level] < hi[:, level])
                maps = self.maps[level - BITS + SHORT][some, self.sorted[some, lo[some, level]] >> level]
                marked = np.unpackbits(np.bitwise_or.reduce(maps, axis=0), count=n).view(bool)
            else:
                marked[np.concatenate([rows[a:b] for rows, a, b in zip(
                    self.order, lo[:, level].tolist(), hi[:, level].tolist())])] = True
            done = int(np.count_nonzero(marked))
            if done < enough:
                continue
            new = np.flatnonzero(marked != seen)
            if products is None:
                rough[new] = self.vectors[new] @ query
            before = best[0] if len(best) == k else -np.inf
            better = rough[new]
            better = better[better > before]
            best = np.sort(np.concatenate((best, better)))[-k:]
            np.copyto(seen, marked)
            if done == n or before > -np.inf and not len(better):
                break
            enough = min(n, int(self.growth * done) + 1)
        rows = np.flatnonzero(seen)
        self.asked += 1
        self.scored += len(rows)
        return rows, rough[rows]

    def candidates(self, query: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int) -> np.ndarray:
        """The rows that ``_ascend`` scores."""
        return self._ascend(query, lo, hi, k)[0]

    def best(self, own: int, query: np.ndarray, rows: np.ndarray, rough: np.ndarray, k: int
             ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the ``k`` largest among these rows (``rough``: their
        products) other than ``own``; ties to the smaller id.  Products are summed in component
        order, so equal vectors have equal ones."""
        other = self.ids[rows] != own
        rows, rough = rows[other], rough[other]
        if len(rows) > k:
            cut = np.partition(rough, -k)[-k]
            rows = rows[rough >= cut - 1e-9 * max(1.0, abs(cut))]
        exact = np.add.accumulate(self.vectors[rows] * query, axis=1)[:, -1] + 0.0
        first = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows][first], exact[first]

    def nearest(self, own: np.ndarray, queries: np.ndarray, k: int):
        """``best`` of each query's candidates.  Where queries so far scored a good part of the
        block, one matrix product costs less than picking every query's rows."""
        lo, hi = self.ranges(queries)
        wide = self.scored * WIDE > self.asked * len(self.ids)
        products = queries @ self.vectors.T if wide else [None] * len(own)
        return [self.best(own[i], queries[i], *self._ascend(queries[i], lo[i], hi[i], k + 1, products[i]), k)
                for i in range(len(own))]


#: queries descended at once
QUERY_BLOCK = 64

OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(k: int, dim: int, trees: int, least: int, growth: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, forest = None, None
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            keys = batch.column(0).to_numpy()
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            own = batch.column(2).to_numpy()
            flat = batch.column(3).flatten().to_numpy().reshape(-1, dim)
            scale = batch.column(4).to_numpy()
            # runs of one block, its vectors before its queries
            cuts = np.flatnonzero((np.diff(keys) != 0) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if keys[a] != block:
                    block, forest, ids, vectors = keys[a], None, [], []
                if not asks[a]:
                    ids.append(own[a:b])
                    vectors.append(flat[a:b])
                    continue
                if forest is None:
                    if not ids:
                        continue
                    forest = Forest(np.concatenate(ids), np.concatenate(vectors), scale[a],
                                    trees, least, growth)
                    ids, vectors = [], []
                found = [x for i in range(a, b, QUERY_BLOCK) for x in forest.nearest(
                    own[i:min(b, i + QUERY_BLOCK)], flat[i:min(b, i + QUERY_BLOCK)], k)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own[a:b], [len(f[0]) for f in found])),
                    pa.array(np.concatenate([f[0] for f in found])),
                    pa.array(np.concatenate([f[1] for f in found]))], schema=OUT)
    return run


def usable(vector: Column) -> Column:
    """True for vectors that are not null, empty or zero and hold finite numbers only."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")),
                                                 F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0),
                      F.lit(False))


def search(df: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, trees: int = TREES,
           least: int = LEAST, growth: float = GROWTH, band: float = BAND,
           first_rows: int = FIRST_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` (a condition on the
    id), the ``k`` nearest found among all rows with another id, by inner product in double
    precision, nearest first, ties to the smaller id.

    Rows without an id, and vectors that are null, empty, zero or not finite, take no part,
    neither do vectors of another length than most.  Repeated rows of an id count as one
    (the smallest vector).  With fewer than ``k`` others, all are returned; an empty table
    gives no rows.  Other columns are not read.  Blocks grow in number, not in size; ``least``
    and ``growth`` set recall against work.
    """
    spark = df.sparkSession
    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                      F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("v"))))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    stats = (rows.groupBy(F.size("v").alias("dim"))
             .agg(F.count("*").alias("n"), F.max(length).alias("longest"))
             .orderBy(F.desc("n"), "dim").limit(1).collect())
    none = "query_id long, rank int, vec_id long, score double"
    if not stats:
        return spark.createDataFrame([], none)
    dim, _, longest = stats[0]
    number = F.least(F.floor(F.log(F.lit(longest) / F.col("len")) / math.log(band)), F.lit(BANDS - 1))
    points = (rows.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v"))
              .withColumn("len", length).withColumn("band", F.greatest(number, F.lit(0)).cast("int")))
    points = keep(points, "points")
    bands = points.groupBy("band").agg(F.count("*").alias("n"), F.max("len").alias("longest")).orderBy("band").collect()
    # a band's blocks are numbered after those of the longer ones
    blocks, at, seen, first = [], 0, 0, 0
    for r in bands:
        many = max(1, -(-r["n"] // block_rows))
        blocks.append((r["band"], at, many, r["longest"]))
        first = first if seen >= first_rows else at + many
        at, seen = at + many, seen + r["n"]
    table = F.broadcast(spark.createDataFrame(blocks, "band int, at long, many long, longest double"))
    struct = lambda r: F.struct(F.lit(r[1]).cast("long").alias("at"), F.lit(r[2]).cast("long").alias("many"),
                                F.lit(r[3]).alias("longest"))
    data = points.join(table, "band").select(
        (F.col("at") + F.pmod(F.xxhash64("vec_id"), F.col("many"))).alias("block"),
        F.lit(False).alias("asks"), "vec_id", "v", "longest")
    asked = points.where(is_query).select("vec_id", "v", "len")

    def visit(queries: DataFrame, blocks: Column) -> DataFrame:
        """Best of the blocks for queries (block, vec_id, v)."""
        queries = queries.select("block", F.lit(True).alias("asks"), "vec_id", "v", "longest")
        return (data.where(blocks).unionByName(queries).repartition("block")
                .sortWithinPartitions("block", "asks", "vec_id")
                .mapInArrow(_search(k, dim, trees, least, growth), "query_id long, vec_id long, score double"))

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: (found.withColumn("rank", F.row_number().over(order))
                            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    def each(queries: DataFrame, wanted: Column) -> DataFrame:
        """Queries once for every block of the bands wanted."""
        to = queries.select("vec_id", "v", F.explode(wanted).alias("b")).select("vec_id", "v", "b.*")
        return to.select(F.explode(F.sequence("at", F.col("at") + F.col("many") - 1)).alias("block"),
                         "vec_id", "v", "longest")

    found = visit(each(asked, F.array(*[struct(r) for r in blocks if r[1] < first])), F.col("block") < first)
    if first == at:
        return ranked(found)
    found = keep(ranked(found), "leading")
    bound = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "score")
    rest = F.array(*[struct(r) for r in blocks if r[1] >= first])
    can_win = F.filter(rest, lambda b: F.col("score").isNull()
                       | (F.col("len") * b["longest"] * (1 + 1e-9) >= F.col("score")))
    more = each(asked.join(bound, "vec_id", "left"), can_win)
    return ranked(found.drop("rank").unionByName(visit(more, F.col("block") >= first)))
