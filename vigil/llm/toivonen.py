"""Phrase collocations by sampling with a negative border (Toivonen).

A sample of the texts' pieces (so that repetition inside a document does not distort it) is
mined level by level with a lowered threshold; what it finds is the set of proposed phrases.  A full pass then counts, exactly, all words, the proposed
phrases and their negative border: phrases that were not proposed, but whose first and last
``k - 1`` words were.  If a phrase of the border is frequent, the proposal was too small: it
grows by the phrases missed, and a further pass counts what that adds to the border.  As a
phrase is never more frequent than a part of it, nothing is missed once a pass misses nothing.

While many phrases are missed, a pass counts the next border only.  Once few are, the last
pass takes all that this border admits for frequent and so admits longer phrases over them
at once: every frequent phrase has parts that are known or admitted, and by induction over
its length is admitted itself, which closes the search.  Up to there phrases are known by
keys only; the sample spells those it proposed, the last pass the others.

The border is not written out (it has a pair for any two frequent words); a pass admits a
window of the text if both parts of it pass a bit filter over the proposed phrases.  The
filter is of bounded size.  Its false positives count phrases for nothing, but each of them
at every occurrence or at none, so counts are exact at any size.  Phrases are compared by
64-bit hashes, salted by language and length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vigil.llm.store import Scratch, keep
from vigil.llm.words import (CHUNK_BYTES, STOP, BitFilter, WordHashes, bit_filter, filter_bits,
                             mix, splitter, texts)

LEAST, MOST_WORDS, TOP = 100, 5, 2000
#: share of the pieces in the sample, and of the scaled threshold that is asked there
SAMPLE, LOWERED = 1 / 8, 0.4
#: share of phrases missed up to which the last pass may follow
FEW = 1 / 16
#: (key, count) pairs held before equal ones are merged, and merged ones before they go out
HELD, MERGED = 1_000_000, 500_000
UNKNOWN = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)
_HASHES = WordHashes()
#: words [^\x20\x09]+ within pieces cut at [.,;:!?\x0A-\x0D]
words = splitter(b" \t", b".,;:!?\n\x0b\x0c\r")


def _salt(lang: str) -> int:
    return _HASHES[b"\xfelang " + lang.encode()]


def key_of(parts: list[bytes], salt: int) -> int:
    """The key of a phrase in the language with this salt."""
    roll = 0
    for w in parts:
        roll = (roll * int(_STEP) + _HASHES[w]) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([roll], np.uint64) + _level(salt, len(parts)))[0])


def _level(salt, k: int) -> np.ndarray:
    """Salts of phrases of ``k`` words."""
    return np.array(salt, np.uint64) + np.uint64(k * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)


def _chunks(batches: Iterator[pa.RecordBatch]):
    """Texts and languages -> words of several texts (a stop after each), hashes, which are no
    stops, salts, and the number of words of each language."""
    stop = _HASHES[STOP]

    def chunk():
        tokens = [w for part, _ in held for w in part]
        h = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))
        salt = np.repeat(np.array([_salt(x) for _, x in held], np.uint64),
                         [len(part) for part, _ in held])
        count: dict[str, int] = {}
        for part, lang in held:
            count[lang] = count.get(lang, 0) + len(part) - part.count(STOP)
        return tokens, h, h != np.uint64(stop), salt, count

    held, size = [], 0
    for batch in batches:
        for text, lang in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
            for part in words.pieces(text):
                part.append(STOP)
                held.append((part, lang))
            size += len(text)
            if size >= CHUNK_BYTES:
                yield chunk()
                held, size = [], 0
    if held:
        yield chunk()


def _windows(h: np.ndarray, valid: np.ndarray, salt: np.ndarray, most: int, new: BitFilter,
             old: BitFilter | None, deep: bool = False):
    """(length, starts, keys, admitted before) of the windows that the filter ``new`` admits:
    all words, and longer windows whose first and last part it has.  ``admitted before`` says
    which of them the filter ``old`` admits.  ``deep``: a part not admitted before will do."""
    roll, at = h.copy(), np.flatnonzero(valid)
    before = np.full(len(at), old is not None)
    for k in range(1, most + 1):
        if k > 1:
            at = np.flatnonzero(mark[:-1] & mark[1:])
            before = was[at] & was[at + 1]
            roll[at] = roll[at] * _STEP + h[at + k - 1]
        key = mix(roll[at] + _level(salt[at], k))
        yield k, at, key, before
        if k == most:
            return
        mark, was = np.zeros(len(h) + 1, bool), np.zeros(len(h) + 1, bool)
        mark[at] = new.has(key) | ~before if deep else new.has(key)
        if old is not None:
            was[at[before]] = old.has(key[before])


class _Tally:
    """Counts of keys, of which only some are held."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        keys, times = np.unique(keys, return_counts=True)
        self.held.append((keys, times))
        self.size += len(keys)

    def take(self, last: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """What has to go out now, merged."""
        if not self.held or not last and self.size < HELD:
            return None
        keys, back = np.unique(np.concatenate([x[0] for x in self.held]), return_inverse=True)
        times = np.bincount(back, weights=np.concatenate([x[1] for x in self.held]),
                            minlength=len(keys)).astype(np.int64)
        out = last or len(keys) >= MERGED
        self.held = [] if out else [(keys, times)]
        self.size = 0 if out else len(keys)
        return (keys, times) if out else None


def _count(most: int, new, old):
    """Texts -> keys of windows that ``new`` admits and ``old`` does not, with partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()

        def out(last: bool = False) -> Iterator[pa.RecordBatch]:
            if (done := tally.take(last)) is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(done[0].view(np.int64)), pa.array(done[1])], names=["h", "n"])

        for _, h, valid, salt, _ in _chunks(batches):
            for _, _, key, before in _windows(h, valid, salt, most, new.value,
                                              old.value if old else None):
                tally.add(key[~before])
            yield from out()
        yield from out(last=True)
    return run


def _spell(tokens: list[bytes], at: np.ndarray, key: np.ndarray, k: int, salt: np.ndarray,
           lang_of: dict[int, str], seen: set[int]) -> list[tuple[str, int, str]]:
    """(language, key, phrase) of the windows that were not seen before."""
    once, first = np.unique(key, return_index=True)
    out = []
    for x, i in zip(once.tolist(), at[first].tolist()):
        if x not in seen:
            seen.add(x)
            out.append((lang_of[int(salt[i])], x - (1 << 64) if x >> 63 else x,
                        b" ".join(tokens[i:i + k]).decode()))
    return out


def _spell_known(most: int, frequent):
    """Texts -> (language, key, phrase) of frequent phrases of two words or more, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for tokens, h, valid, salt, count in _chunks(batches):
            lang_of, spelt = {_salt(x): x for x in count}, []
            for k, at, key, _ in _windows(h, valid, salt, most, frequent.value, None):
                if k > 1:
                    hit = np.flatnonzero(frequent.value.has(key))
                    spelt += _spell(tokens, at[hit], key[hit], k, salt, lang_of, seen)
            if len(seen) > HELD:
                seen.clear()
            if spelt:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*spelt), (pa.string(), pa.int64(), pa.string()))],
                    names=["lang", "h", "phrase"])
    return run


def _count_last(most: int, new, old, missed):
    """Texts -> the last pass: (null, key, null, partial count) of windows not admitted before,
    (language, key, phrase, null) once a task for those and the missed ones, of two words or
    more, and (language, null, null, number of words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, seen, total = _Tally(), set(), {}

        def rows(lang, h, phrase, n, size: int) -> pa.RecordBatch:
            kinds = {"lang": pa.string(), "h": pa.int64(), "phrase": pa.string(), "n": pa.int64()}
            return pa.RecordBatch.from_arrays(
                [pa.nulls(size, kind) if x is None else pa.array(x, kind)
                 for x, kind in zip((lang, h, phrase, n), kinds.values())], names=list(kinds))

        def counts(last: bool = False) -> Iterator[pa.RecordBatch]:
            if (done := tally.take(last)) is not None:
                yield rows(None, done[0].view(np.int64), None, done[1], len(done[0]))

        for tokens, h, valid, salt, count in _chunks(batches):
            for lang, n in count.items():
                total[lang] = total.get(lang, 0) + n
            lang_of, spelt = {_salt(x): x for x in count}, []
            for k, at, key, before in _windows(h, valid, salt, most, new.value, old.value, deep=True):
                tally.add(key[~before])
                if k > 1:
                    wanted = np.flatnonzero(missed.value.has(key) | ~before)
                    spelt += _spell(tokens, at[wanted], key[wanted], k, salt, lang_of, seen)
            if spelt:
                yield rows(*zip(*spelt), None, len(spelt))
            if len(seen) > HELD:
                seen.clear()
            yield from counts()
        yield from counts(last=True)
        if total:
            yield rows(list(total), None, None, list(total.values()), len(total))
    return run


def propose(docs: DataFrame, least: int, most: int, bits: int, write=keep) -> DataFrame:
    """``h`` of every phrase that occurs ``least`` times in ``docs`` (text, lang), level by level."""
    sc = docs.sparkSession.sparkContext
    known, old = None, None
    for _ in range(most):
        new = sc.broadcast(bit_filter(known, "h", bits) if known is not None else BitFilter(bits))
        found = write(_frequent(docs.mapInArrow(_count(most, new, old), "h long, n long"), least)
                      .select("h"), "proposed")
        if found.isEmpty():
            break
        known = found if known is None else known.unionByName(found)
        old = new
    return found if known is None else known


def _frequent(partial: DataFrame, least: int) -> DataFrame:
    return partial.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def count(docs: DataFrame, proposed: DataFrame, least: int, most: int, bits: int,
          few: float = FEW, write=keep) -> tuple[DataFrame, DataFrame]:
    """(``h, n`` of every phrase with ``n >= least`` in ``docs`` (text, lang); the last pass's
    rows, which spell those that were not proposed), in two passes and as many more as it takes until the phrases
    missed are at most a share ``few`` of those known."""
    sc = docs.sparkSession.sparkContext
    known, old, found, fresh = proposed, None, None, None
    while True:
        new = sc.broadcast(bit_filter(known, "h", bits))
        counted = _frequent(docs.mapInArrow(_count(most, new, old), "h long, n long"), least)
        counted = write(counted.join(known.withColumn("was", F.lit(True)), "h", "left"), "counts")
        found = counted.select("h", "n") if found is None else found.unionByName(counted.select("h", "n"))
        missed = counted.where("was IS NULL").select("h")
        known, old = known.unionByName(missed), new
        fresh = missed if fresh is None else fresh.unionByName(missed)
        if missed.count() <= few * found.count():
            break
    new = sc.broadcast(bit_filter(known, "h", bits))
    fresh = sc.broadcast(bit_filter(fresh, "h", bits))
    last = write(docs.mapInArrow(_count_last(most, new, old, fresh), SPELT), "last")
    more = _frequent(last.where("n IS NOT NULL AND h IS NOT NULL"), least)
    return keep(found.unionByName(more), "frequent"), last


SPELT = "lang string, h long, phrase string, n long"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases -> a row for each cut after the first k words, with the keys of both parts."""
    for batch in batches:
        rows = []
        for i, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(),
                                               batch.column(1).to_pylist())):
            parts, salt = phrase.encode().split(b" "), _salt(lang)
            rows += [(i, k, len(parts), key_of(parts[:k], salt), key_of(parts[k:], salt))
                     for k in range(1, len(parts))]
        at, k, size, first, rest = (np.array(x, np.uint64) for x in zip(*rows)) if rows else (
            np.empty(0, np.uint64),) * 5
        own = batch.take(pa.array(at.astype(np.int64)))
        yield pa.RecordBatch.from_arrays(
            own.columns + [pa.array(x.view(np.int64)) for x in (k, size, first, rest)],
            names=["lang", "phrase", "h", "a", "k", "size", "first", "rest"])


def _pieces(share: float):
    """Texts -> a share of the pieces of each, chosen by a hash of the row's seed and the
    piece's place, one to a line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, out = [], []
            for text, own, seed in zip(texts(batch.column(0)), *(c.to_pylist() for c in batch.columns[1:])):
                cut = words.cut(text)
                drawn = mix(np.arange(len(cut), dtype=np.uint64) * _STEP + np.uint64(seed & (1 << 63) - 1))
                at = np.flatnonzero(drawn < np.uint64(int(share * (1 << 63)) * 2))
                if len(at):
                    lang.append(own)
                    out.append(b"\n".join([cut[i] for i in at.tolist()]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(lang, pa.string())],
                                             names=["text", "lang"])
    return run


def mine(df: DataFrame, *, least: int = LEAST, most: int = MOST_WORDS, sample: float = SAMPLE,
         lowered: float = LOWERED, text_col: str = "text", lang_col: str = "lang",
         id_col: str | None = "doc_id") -> DataFrame:
    """``lang, phrase, size, a, k, l, r, n, score`` of every phrase of 2 to ``most`` words that
    occurs ``least`` times or more in the texts of its language, but lies in no longer one as
    frequent.  ``a``, ``l``, ``r`` count the phrase and the parts of its weakest cut (after
    ``k`` words), ``n`` all words; ``score`` is floor(1000 a n / (l r)).

    A-Z are lower-cased; pieces end at ``. , ; : ! ?`` and line breaks, words at blanks and
    tabs.  ``sample`` is the share of pieces that are mined first, with ``lowered`` of the
    threshold that share implies; both steer costs, not results.

    Edge cases: a null text is empty; a null language is ``und``, also where that is a
    language; repeated rows and ids count as often as they stand there; an empty table, or
    one without frequent phrases, gives no rows; other columns are not read.
    """
    scratch = Scratch()
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang")
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    docs = df.select(text, lang)
    seed = F.xxhash64(F.col(f"`{id_col}`") if id_col else text, F.lit(11)).alias("seed")
    size = df.select(F.sum(F.octet_length(text))).first()[0] or 0
    bits = filter_bits(size / 64)  # bounded; a phrase for every 64 bytes is plenty
    some = scratch.keep(df.select(text, lang, seed).mapInArrow(_pieces(sample), "text string, lang string"), "sample")
    proposed = propose(some, max(2, int(least * sample * lowered)), most, bits, scratch.keep)
    frequent, last = count(docs, proposed, least, most, bits, write=scratch.keep)
    total = keep(last.where("h IS NULL").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    spell = _spell_known(most, df.sparkSession.sparkContext.broadcast(bit_filter(frequent, "h", bits)))
    spelt = scratch.keep(some.mapInArrow(spell, "lang string, h long, phrase string"), "spelt")
    named = (last.where("phrase IS NOT NULL").select("lang", "h", "phrase").unionByName(spelt)
             .dropDuplicates(["h"]).join(frequent.withColumnRenamed("n", "a"), "h"))
    cuts = keep(named.select("lang", "phrase", "h", "a").mapInArrow(
        _cut, "lang string, phrase string, h long, a long, k long, size long, first long, rest long"),
        "cuts")
    scratch.release()
    # a longer phrase as frequent is enough to know by one word more: parts are not rarer
    inside = (cuts.where("size > 2").where((F.col("k") == 1) | (F.col("k") == F.col("size") - 1))
              .select(F.explode(F.array(F.when(F.col("k") == 1, F.col("rest")),
                                        F.when(F.col("k") == F.col("size") - 1, F.col("first"))))
                      .alias("h"), "a").where("h IS NOT NULL").distinct())
    parts = lambda h, n: frequent.select(F.col("h").alias(h), F.col("n").alias(n))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("(cast(1000 as decimal(4,0)) * a * n) div (l * r)")
    scored = (cuts.join(inside, ["h", "a"], "left_anti").join(parts("first", "l"), "first")
              .join(parts("rest", "r"), "rest").join(total, "lang")
              .select("lang", "phrase", "size", "k", *[wide(c).alias(c) for c in "alrn"])
              .withColumn("score", score))
    best = scored.groupBy("lang", "phrase", "size", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "size", F.col("a").cast("long").alias("a"), "cut.k",
                       F.col("cut.l").cast("long").alias("l"), F.col("cut.r").cast("long").alias("r"),
                       F.col("n").cast("long").alias("n"), "cut.score")


def ranked(mined: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: highest score, most frequent, then by bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .withColumn("rank", F.col("rank").cast("long")))
