"""Hashed words of whole texts, and a filter of bounded size over 64-bit keys."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: words kept in a worker's cache of hashes
CACHE_WORDS = 300_000
#: bytes of text that are tokenised at a time
CHUNK_BYTES = 1 << 20
#: the largest filter: 2 ** 27 bits are 16 MB
LEAST_BITS, MOST_BITS = 16, 27


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words (bytes), the latest ``CACHE_WORDS`` or fewer of them kept."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def splitter(joined: bytes, stops: bytes = b""):
    """A function from a text (UTF-8 bytes) to its words: A-Z become lower case, bytes of
    ``joined`` end a word, bytes of ``stops`` do so and become a word of their own, ``STOP``.
    ASCII white space has to be in one of the two."""
    table = bytearray(range(256))
    for b in joined:
        table[b] = 0x20
    for b in stops:
        table[b] = STOP[0]
    for b in range(0x41, 0x5B):
        if table[b] == b:
            table[b] = b + 0x20
    table = bytes(table)

    def words(text: bytes) -> list[bytes]:
        text = text.translate(table)
        return (text.replace(STOP, b" " + STOP + b" ") if stops else text).split()

    def pieces(text: bytes) -> Iterator[list[bytes]]:
        """The words of a long text in lists of bounded size, cut at stops if it has any."""
        if len(text) <= 2 * CHUNK_BYTES:
            yield words(text)
            return
        text = text.translate(table)
        at = 0
        while at < len(text):
            end = text.find(STOP, at + CHUNK_BYTES) + 1 or len(text)
            yield text[at:end].replace(STOP, b" " + STOP + b" ").split()
            at = end
    words.pieces = pieces
    words.cut = lambda text: text.translate(table).split(STOP)  # at stops only
    return words


#: never part of UTF-8
STOP = b"\xff"


def texts(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8, a null as an empty text."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


class BitFilter:
    """A set of 64-bit keys with false positives: two probes, by the highest and the lowest
    bits of a key, into ``2 ** bits`` bits."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        words = np.zeros(1 << (bits - 6), np.int64) if words is None else words
        self.table = words.astype("<i8").view(np.uint8)

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], np.uint64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = self._probe(keys >> np.uint64(64 - self.bits))
        at = np.flatnonzero(out)
        out[at] = self._probe(keys[at] & np.uint64((1 << self.bits) - 1))
        return out

    def _probe(self, slot: np.ndarray) -> np.ndarray:
        return (self.table[(slot >> np.uint64(3)).astype(np.int64)]
                >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def filter_bits(expected: float) -> int:
    """Bits (their logarithm) for so many keys: 16 a key, within the bounds."""
    return int(min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1.0, 16 * expected))))))


def bit_filter(keys: DataFrame, column: str, bits: int) -> BitFilter:
    """The filter over a column of longs.  Executors gather the bits by 64-bit words; only
    words with a bit set come to the driver, 32 MB of them at most."""
    high = F.shiftrightunsigned(F.col(column), 64 - bits)
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    slots = keys.select(F.explode(F.array(high, low)).alias("slot"))
    word = F.shiftrightunsigned("slot", 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    found = slots.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return BitFilter(bits, words)
