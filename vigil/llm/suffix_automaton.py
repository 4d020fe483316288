"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton of all items' words is walked along a document's words; at every word it knows
the longest run of words ending there that occurs in an item (state and length).  A run of
``window`` words, or a whole item of fewer, is a hit.  Overlapping and adjoining hits make a
span; spans of ``span_limit`` words or more are cut out of the text, and a document in which
hits cover more than ``coverage_limit`` of the words is to go.

Documents are only mapped: no shuffle.  Items are dealt to automata of bounded size
(``SHARD_WORDS``), which are broadcast one at a time; with several, each but the first reads
what the one before wrote.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.store import boxed, keep
from vigil.llm.words import splitter, texts

WINDOW, SPAN_LIMIT, COVERAGE_LIMIT = 10, 20, 0.5
#: words of the items of one automaton (expected)
SHARD_WORDS = 200_000

#: A-Z lower-cased, words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
_JOINED = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
words = splitter(_JOINED)
_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Automaton:
    """Suffix automaton of several word sequences.  ``items`` are (item number, words); longer
    ones are given in pieces that overlap in ``window - 1`` words."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link, self.next = [0], [-1], [{}]
        own = [(n, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in seq])
               for n, seq in items if seq]
        for _, seq in own:
            last = 0
            for w in seq:
                last = self._add(last, w)
        self._mark(own)

    def _add(self, last: int, w: int) -> int:
        """Extends the sequence that ends in ``last``; its new state."""
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, w, known)
        state = self._new(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p < 0:
            self.link[state] = 0
        else:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return state

    def _new(self, length: int, follow: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(0)
        self.next.append(follow)
        return len(self.length) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._new(self.length[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _mark(self, own: list[tuple[int, list[int]]]) -> None:
        """``of_window``: for a state the one on its suffix path that stands for its last
        ``window`` words; ``whole``: lengths of short items that a state stands for, ``above``:
        the next state up the path with such; ``item_of``: the items of a state of either kind."""
        window, n = self.window, len(self.length)
        length, link = self.length, self.link
        self.of_window, self.above = [0] * n, [0] * n
        self.whole: dict[int, list[int]] = {}
        self.item_of: dict[int, set[int]] = {}
        for number, seq in own:
            if len(seq) < window:
                state = 0
                for w in seq:
                    state = self.next[state][w]
                self.whole.setdefault(state, [])
                if len(seq) not in self.whole[state]:
                    self.whole[state].append(len(seq))
                self.item_of.setdefault((state, len(seq)), set()).add(number)
        for s in sorted(range(1, n), key=length.__getitem__):
            if length[s] >= window:
                self.of_window[s] = s if length[link[s]] < window else self.of_window[link[s]]
            up = link[s]
            self.above[s] = up if up in self.whole else self.above[up]
        for number, seq in own:
            state = 0
            for i, w in enumerate(seq):
                state = self.next[state][w]
                if i + 1 >= window:
                    self.item_of.setdefault(self.of_window[state], set()).add(number)
        self.shortest = min([window, *(len(seq) for _, seq in own)])

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of known words that are long enough to hold a hit."""
        known = np.concatenate(([False], ids > 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        first, last = edges[::2], edges[1::2]
        wide = last - first >= self.shortest
        return zip(first[wide].tolist(), last[wide].tolist())

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        """The longest match that ends at each word."""
        out = np.zeros(len(ids), np.int64)
        known = np.concatenate(([False], ids > 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            for i, (_, n) in enumerate(self._walk(ids[first:last].tolist())):
                out[first + i] = n
        return out

    def _walk(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match at each word."""
        follow, link, length = self.next, self.link, self.length
        state = n = 0
        for w in ids:
            to = follow[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = follow[state].get(w)
            if to is None:
                state = n = 0
            else:
                state = to
                n += 1
            yield state, n

    def ids(self, own: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, own, repeat(0)), np.int32, len(own))

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which words lie in a hit, and the items hit."""
        hit = np.zeros(len(ids), bool)
        items: set[int] = set()
        window, whole = self.window, self.whole
        for first, last in self.runs(ids):
            found = set()
            for i, (state, n) in enumerate(self._walk(ids[first:last].tolist()), first + 1):
                if n >= window:
                    hit[i - window:i] = True
                    found.add(self.of_window[state])
                if whole:
                    at = state
                    while at:
                        for m in whole.get(at, ()):
                            if m <= n:
                                hit[i - m:i] = True
                                found.add((at, m))
                        at = self.above[at]
            for f in found:
                items |= self.item_of[f]
        return hit, items


def shards(items: DataFrame, window: int, shard_words: int) -> Iterator[tuple[Automaton, list]]:
    """Automata over all items (``id, text``), each with the ids of its item numbers.  Items are
    dealt by a hash; only one automaton's items are with the driver at a time."""
    count = F.size(F.split("text", _PATTERN)).cast("long") - 1
    total = items.select(F.sum(F.coalesce(count, F.lit(0)))).first()[0] or 0
    n = max(1, -(-total // shard_words))
    shard = F.pmod(F.xxhash64("id", "text", F.lit(12)), F.lit(n))
    for k in range(n):
        part = items.where(shard == k).where("text IS NOT NULL").distinct().toArrow()
        ids = sorted({x for x in part.column("id").to_pylist() if x is not None}) + [None]
        number = {x: i for i, x in enumerate(ids)}
        seqs = []
        for x, text in zip(part.column("id").to_pylist(), texts(part.column("text").combine_chunks())):
            own = words(text)
            for at in range(0, max(1, len(own) - window + 1), shard_words):
                seqs.append((number[x], own[at:at + shard_words + window - 1]))
        if any(seq for _, seq in seqs):
            yield Automaton(seqs, window), ids


OUT = "n_words long, hit binary, items array<string>"


def _scan(shard):
    """(row, text, n_words, hit, items) -> the same, with the hits of one more automaton: a bit
    a word (null: none), and the ids of items hit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, ids = shard.value
        ids = [None if x is None else str(x) for x in ids]
        for batch in batches:
            text_at = batch.schema.get_field_index("__text")
            hit_at = batch.schema.get_field_index("hit")
            counts, hits, items = [], [], []
            for text, before, known in zip(texts(batch.column(text_at)),
                                           batch.column(hit_at).to_pylist(),
                                           batch.column(hit_at + 1).to_pylist()):
                own = words(text)
                hit, found = automaton.hits(automaton.ids(own))
                if before is not None:
                    hit |= np.unpackbits(np.frombuffer(before, np.uint8), count=len(own)).astype(bool)
                counts.append(len(own))
                hits.append(np.packbits(hit).tobytes() if hit.any() else None)
                more = {ids[i] for i in found}
                items.append(sorted({*known, *more}, key=lambda x: (x is None, x or "")) if found else known)
            columns = [c for i, c in enumerate(batch.columns)
                       if i not in (hit_at - 1, hit_at, hit_at + 1)]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(counts, pa.int64()), pa.array(hits, pa.binary()),
                           pa.array(items, pa.list_(pa.string()))], schema=batch.schema)
    return run


SPAN = pa.struct([("word", pa.int64()), ("words", pa.int64()), ("start", pa.int64()),
                  ("end", pa.int64())])
SPANS = "array<struct<word: long, words: long, start: long, end: long>>"


def _spans(limit: int):
    """Hits -> spans (first word, words, code points from and to) and the text without those
    of ``limit`` words or more."""
    import re
    word = re.compile(_PATTERN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit_at = batch.schema.get_field_index("hit")
            text_at = batch.schema.get_field_index("__text")
            n_words = batch.column(hit_at - 1).to_pylist()
            spans, counts, clean = [], [], []
            for i, raw in enumerate(batch.column(hit_at).to_pylist()):
                text = batch.column(text_at)[i].as_py()
                if raw is None:
                    spans.append([])
                    counts.append(0)
                    clean.append(text)
                    continue
                hit = np.unpackbits(np.frombuffer(raw, np.uint8), count=n_words[i])
                counts.append(int(hit.sum()))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])).astype(np.int8)))
                at = [m.span() for m in word.finditer(text)]
                own = [(a, b - a, at[a][0], at[b - 1][1])
                       for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
                spans.append([dict(zip(("word", "words", "start", "end"), s)) for s in own])
                rest, end = [], 0
                for _, n, a, b in own:
                    if n >= limit:
                        rest.append(text[end:a])
                        end = b
                clean.append("".join(rest) + text[end:])
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.columns) if i not in (hit_at, text_at)]
                + [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(SPAN)),
                   pa.array(clean, pa.string())],
                names=[f.name for i, f in enumerate(batch.schema) if i not in (hit_at, text_at)]
                + ["n_hit", "spans", "clean_text"])
    return run


ADDED = {"n_words", "n_hit", "item_ids", "spans", "clean_text", "contaminated", "dropped"}


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = WINDOW,
                  span_limit: int = SPAN_LIMIT, coverage_limit: float = COVERAGE_LIMIT,
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  columns: list[str] | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words in hits), ``item_ids`` (items hit, as sorted
    strings), ``spans`` of hits, ``clean_text`` (without spans of ``span_limit`` words or more),
    ``contaminated`` (any hit) and ``dropped`` (hits cover more than ``coverage_limit``).

    Edge cases: null or wordless texts have no words and no hits; a null text stays null; null
    or wordless items hit nothing; items with one id are one item (a null id is one too, and is
    carried as null, last); empty tables give no rows, or no hits; columns named as one that is
    added are replaced by it; texts are read whole, of any length.
    """
    spark = docs.sparkSession
    kept = docs.select(*[F.col(f"`{c}`") for c in columns]) if columns else docs
    row, out = boxed(kept, ADDED)
    found = docs.select(
        row, F.col(f"`{text_col}`").cast("string").alias("__text"), F.lit(None).cast("long").alias("n_words"),
        F.lit(None).cast("binary").alias("hit"), F.array().cast("array<string>").alias("items"))
    tests = items.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    schema, done = found.schema, False
    for automaton in shards(tests, window, shard_words):
        if done:
            found = keep(found, "hits")
        found = found.mapInArrow(_scan(spark.sparkContext.broadcast(automaton)), schema)
        done = True
    if not done:
        found = found.mapInArrow(_scan(spark.sparkContext.broadcast((Automaton([], window), []))), schema)
    kind = dict(found.dtypes)["__row"]
    spans = found.mapInArrow(_spans(span_limit), f"__row {kind}, n_words long, items array<string>, "
                             f"n_hit long, spans {SPANS}, clean_text string")
    return spans.select(
        *out, "n_words", "n_hit", F.col("items").alias("item_ids"), "spans", "clean_text",
        (F.col("n_hit") > 0).alias("contaminated"),
        (F.col("n_hit") > coverage_limit * F.col("n_words")).alias("dropped"))


def item_digest(ids: Column) -> Column:
    """SHA-256 of sorted item ids, comma-joined."""
    return F.sha2(F.array_join(ids, ",", "").cast("binary"), 256)
