"""Ranked lexical search by pipelined term partitioning.

Documents are read once into blocks of postings of the queries' terms.  Terms are dealt to
owners by their document frequency, the rarest to the first, in shares of like size.  A
bundle of items then visits the owners in turn: at each, the accumulators it carries for a
block of documents (item, document, score so far) meet that owner's postings of the block in
a cogroup, contributions are added as integers, and accumulators that cannot reach the block's
``top`` best any more are left behind: what the owners to come can add at most is known, and a
score below the ``top``-th best of its block by more than that is below the ``top``-th best of
all.  Such an accumulator can come up again at a later owner, with too low a score, but then
never among the best.  So results are exact.  The last owner returns the best of each block, and a
window selects the best of all.

A task holds a block (bounded documents and bytes) and a bundle's terms (bounded).  Bundles
are processed one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vigil.llm.store import keep
from vigil.llm.words import splitter, texts

TOP, OWNERS = 10, 4
#: documents and bytes of text of a block
BLOCK_DOCS, BLOCK_BYTES = 2048, 8 << 20
#: bytes of the items' texts in a bundle (expected), which bound its terms
BUNDLE_BYTES = 1 << 20
#: terms that are multiplied out at a time
TILE = 1024

#: A-Z lower-cased, terms [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+
words = splitter(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


class Bundle(NamedTuple):
    """Items and their terms: ``terms[items.indptr[i]:...]`` are the terms of item ``i``."""
    ids: list
    vocabulary: dict[bytes, int]
    item: np.ndarray
    term: np.ndarray


def bundles(items: DataFrame, bundle_bytes: int) -> Iterator[Bundle]:
    """Items (id, text) by a hash, so that a bundle's texts have ``bundle_bytes`` or so."""
    size = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // bundle_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text", F.lit(13)), F.lit(n)) == k).toArrow()
        ids, vocabulary, item, term = part.column("id").to_pylist(), {}, [], []
        for i, text in enumerate(texts(part.column("text").combine_chunks())):
            own = {vocabulary.setdefault(w, len(vocabulary)) for w in words(text)}
            item += [i] * len(own)
            term += sorted(own)
        yield Bundle(ids, vocabulary, np.array(item, np.int64), np.array(term, np.int64))


BLOCKS = pa.schema([("block", pa.int64()), ("docs", pa.int64()), ("terms", pa.int64()),
                    ("doc_id", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
                    ("payload", pa.binary())])
BLOCKS_DDL = "block long, docs long, terms long, doc_id array<long>, n array<long>, payload binary"


def _pack(term: np.ndarray, doc: np.ndarray, times: np.ndarray) -> bytes:
    return b"".join((np.uint64(len(term)).tobytes(), term.astype(np.uint32).tobytes(),
                     doc.astype(np.uint32).tobytes(), times.astype(np.uint32).tobytes()))


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, np.uint64, 1)[0])
    return tuple(np.frombuffer(raw, np.uint32, n, 8 + 4 * n * k).astype(np.int64) for k in range(3))


def _index(bundle):
    """Documents -> blocks: ids, numbers of terms, and postings (term, document, occurrences) of
    the bundle's terms in order of terms.  Documents without terms are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bundle.value.vocabulary
        known, block = vocabulary.get, TaskContext.get().partitionId() << 32
        ids, counts, codes, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            code, times = np.unique(np.concatenate(codes), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([sum(counts)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([counts], pa.list_(pa.int64())),
                 pa.array([_pack(code >> 32, code & 0xFFFFFFFF, times)], pa.binary())],
                schema=BLOCKS)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                own = words(text)
                if not own:
                    continue
                term = np.fromiter(map(known, own, repeat(-1)), np.int64, len(own))
                codes.append(term[term >= 0] << 32 | len(ids))
                ids.append(doc)
                counts.append(len(own))
                size += len(text)
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield out()
                    block += 1
                    ids, counts, codes, size = [], [], [], 0
        if ids:
            yield out()
    return run


def _frequencies(n_terms: int):
    """Blocks -> document frequencies of the terms that a task has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                df += np.bincount(_unpack(raw)[0], minlength=n_terms)
        at = np.flatnonzero(df)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])
    return run


class Plan(NamedTuple):
    """What the owners need: owner, weight (0: adds nothing) of each term; items by term; what
    owners after the k-th can add to each item at most."""
    owner: np.ndarray
    weight: np.ndarray
    item: np.ndarray
    term: np.ndarray
    later: np.ndarray
    items: int
    docs: int
    terms: int


#: no contribution is larger than a term's weight times this
LARGEST = 1_000_000


def weigh(bundle: Bundle, df: np.ndarray, n_docs: int, n_terms: int, owners: int) -> Plan:
    """Weights by document frequency, and owners: the rarest terms first, so that each has a
    like share of the postings."""
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()],
                      np.int64)
    order = np.argsort(df, kind="stable")
    owner = np.empty(len(df), np.int64)
    share = np.cumsum(df[order]) - df[order]
    owner[order] = np.minimum(share * owners // max(1, int(df.sum())), owners - 1)
    live = (df > 0) & (weight > 0)
    owner[~live] = -1
    order = np.argsort(bundle.term, kind="stable")
    item, term = bundle.item[order], bundle.term[order]
    later = np.zeros((owners, len(bundle.ids)), np.int64)
    at = live[term]
    for k in range(owners):
        after = at & (owner[term] > k)
        np.add.at(later[k], item[after], weight[term[after]] * LARGEST)
    return Plan(owner, weight, item, term, later, len(bundle.ids), n_docs, n_terms)


def _owned(plan, k: int):
    """Blocks -> the postings of owner ``k``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = plan.value.owner
        for batch in batches:
            raws = []
            for raw in batch.column(1).to_pylist():
                term, doc, times = _unpack(raw)
                own = owner[term] == k
                raws.append(_pack(term[own], doc[own], times[own]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raws, pa.binary())],
                                             names=["block", "payload"])
    return run


CARRIED = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())),
                     ("n", pa.list_(pa.int64())), ("item", pa.list_(pa.int32())),
                     ("doc", pa.list_(pa.int32())), ("score", pa.list_(pa.int64()))])
CARRIED_DDL = ("block long, doc_id array<long>, n array<long>, item array<int>, doc array<int>, "
               "score array<long>")
BEST = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def add_contributions(score: np.ndarray, plan: Plan, n: np.ndarray, postings) -> None:
    """Adds, to ``score`` (items x documents of a block), what the postings contribute."""
    term, doc, times = postings
    norm = 10 + 90 * n * plan.docs // plan.terms
    weighed = plan.weight[term] * (1_000_000_000 * times // (1000 * times + 8 * norm[doc]))
    terms = np.unique(term)
    for at in range(0, len(terms), TILE):
        tile = terms[at:at + TILE]
        a, b = np.searchsorted(term, (tile[0], tile[-1] + 1))
        added = np.zeros((len(tile), len(n)))
        added[np.searchsorted(tile, term[a:b]), doc[a:b]] = weighed[a:b]
        asks = np.zeros((plan.items, len(tile)))
        c, d = np.searchsorted(plan.term, (tile[0], tile[-1] + 1))
        own = np.searchsorted(tile, plan.term[c:d])
        hit = tile[np.minimum(own, len(tile) - 1)] == plan.term[c:d]
        asks[plan.item[c:d][hit], own[hit]] = 1
        # sums of up to TILE integers below 2 ** 40: exact in doubles
        score += (asks @ added).astype(np.int64)


def _visit(plan, k: int, top: int, last: bool):
    """A bundle at owner ``k``: accumulators and postings of a block -> accumulators that can
    still be among the block's ``top`` best (at the last owner these themselves)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = plan.value
        if not left.num_rows:
            return (BEST if last else CARRIED).empty_table()
        row = left.to_pylist()[0]
        n = np.array(row["n"], np.int64)
        score = np.zeros((own.items, len(n)), np.int64)
        score[row["item"], row["doc"]] = row["score"]
        for raw in right.column("payload").to_pylist():
            add_contributions(score, own, n, _unpack(raw))
        if last:
            ids = np.array([x is None for x in row["doc_id"]])
            order = np.lexsort((np.array([x or 0 for x in row["doc_id"]], np.int64), ids))
            out = []
            for i in range(own.items):
                at = order[np.argsort(-score[i, order], kind="stable")[:top]]
                out += [(i, row["doc_id"][d], int(score[i, d])) for d in at.tolist() if score[i, d] > 0]
            return pa.Table.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out), BEST)],
                                        schema=BEST) if out else BEST.empty_table()
        keep_it = score > 0
        if len(n) > top:
            least = np.partition(score, len(n) - top, axis=1)[:, len(n) - top]
            keep_it &= score + own.later[k][:, None] >= least[:, None]
        item, doc = np.nonzero(keep_it)
        return pa.Table.from_arrays(
            [pa.array([row["block"]], pa.int64()), pa.array([row["doc_id"]], pa.list_(pa.int64())),
             pa.array([row["n"]], pa.list_(pa.int64())), pa.array([item], pa.list_(pa.int32())),
             pa.array([doc], pa.list_(pa.int32())), pa.array([score[item, doc]], pa.list_(pa.int64()))],
            schema=CARRIED)
    return run


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, owners: int = OWNERS,
           id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents with the highest scores above 0
    for every item; equal scores by ascending id (null last).

    Edge cases: null and empty texts have no terms, and count neither as documents nor as
    items with results; repeated documents are ranked each; repeated items (equal ids or
    texts) are ranked each, and rows of one id are numbered together only if the whole row is
    repeated, in which case it is one item; empty tables give no rows; other columns are not
    read; texts of any length are read whole.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    tests = items.select(F.col(f"`{item_id}`").cast("long").alias("id"),
                         F.col(f"`{item_text}`").cast("string").alias("text")).distinct()
    found = None
    for bundle in bundles(tests, bundle_bytes):
        own = _bundle_best(spark, read, bundle, top, owners)
        found = own if found is None else found.unionByName(own)
    return found


def _bundle_best(spark, read: DataFrame, bundle: Bundle, top: int, owners: int) -> DataFrame:
    sc = spark.sparkContext
    blocks = keep(read.mapInArrow(_index(sc.broadcast(bundle)), BLOCKS_DDL), "postings")
    n_docs, n_terms = (x or 0 for x in blocks.agg(F.sum("docs"), F.sum("terms")).first())
    df = np.zeros(len(bundle.vocabulary), np.int64)
    counted = (blocks.select("payload").mapInArrow(_frequencies(len(df)), "term long, df long")
               .groupBy("term").agg(F.sum("df").alias("df")).toArrow())
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    plan = sc.broadcast(weigh(bundle, df, n_docs, n_terms, owners))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    carried = blocks.select("block", "doc_id", "n", none("int").alias("item"), none("int").alias("doc"),
                            none("long").alias("score"))
    for k in range(owners):
        last = k == owners - 1
        posted = blocks.select("block", "payload").mapInArrow(_owned(plan, k), "block long, payload binary")
        carried = carried.groupBy("block").cogroup(posted.groupBy("block")).applyInArrow(
            _visit(plan, k, top, last), "item long, doc_id long, score long" if last else CARRIED_DDL)
    names = spark.createDataFrame(list(enumerate(bundle.ids)), "item long, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = carried.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
