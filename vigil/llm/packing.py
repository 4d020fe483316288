"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every scan partition is packed where it is read: one pass, no shuffle, no skew.  A
document's ids are cut into whole windows and a rest; the rest goes into the fill level
``h`` for which the sum over levels of (number of partially filled windows)^2 becomes
smallest, which a level array gives without looking at single windows.  When a partition
ends (or ``max_open`` windows are open) the emptiest open windows are cut to fill the
fullest ones, and the very last window is cut at powers of two, so next to nothing is
padded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

PIECE_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
                "offset long, ids binary")

#: words kept in a worker's cache (some 220 bytes each) before it is emptied
CACHE_WORDS = 250_000
#: closed pieces held before they are given out: rows, bytes of their ids
FLUSH_ROWS, FLUSH_BYTES = 4096, 4 << 20

#: chunks whose normalised form and word split are the same in Python and in the tokenizer
_PLAIN = re.compile("[!-~¡-įı-ɏ]+")
#: of these, one word and the punctuation after it
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?]*)")


class WordCache(dict):
    """Chunk between blanks -> ids as little-endian uint32 bytes.

    The vocabulary drops white space and never merges across it, so a text's ids are the
    ids of its blank-separated chunks in order.  Chunks are split further into the
    vocabulary's own words, whose ids are cached too; only unseen words are encoded.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.split = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        # the vocabulary writes a byte as a character: printable ones as themselves, the
        # others as those from 256 on, in order
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.letters = "".join(chr(b) if b in plain else chr(next(other)) for b in range(256))
        self.model = self.tokenizer.model
        self[""] = b""

    def _encode(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, chunks: set[str]) -> None:
        """Fill the cache with these chunks, encoding the words they add in one go."""
        if len(self) + len(self.words) > CACHE_WORDS:
            self.clear()
            self.words.clear()
            self[""] = b""
        parts: dict[str, list[str]] = {}
        new: set[str] = set()
        for c in chunks:
            if simple := _WORD.fullmatch(c):
                word, tail = simple.groups()
                parts[c] = own = [word.lower(), tail] if tail else [word.lower()]
            elif _PLAIN.fullmatch(c) and "<|" not in c:
                parts[c] = own = self.split(c.lower())
            else:
                self[c] = self._encode(c).tobytes()
                continue
            for w in own:
                if w not in self.words:
                    new.add(w)
        tokenize, letters = self.model.tokenize, self.letters
        for w in new:
            text = w if w.isascii() else w.encode().decode("latin-1").translate(letters)
            self.words[w] = np.asarray([t.id for t in tokenize(text)], "<u4").tobytes()
        words = self.words
        for c, own in parts.items():
            self[c] = b"".join([words[w] for w in own])

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; memory for one text at a time besides the cache."""
        for text in texts:
            chunks = text.replace("\n", " ").split(" ")
            got = [*map(self.get, chunks)]
            if None in got:
                self.learn({c for c, g in zip(chunks, got) if g is None})
                got = [self[c] if c in self else self._encode(c).tobytes() for c in chunks]
            yield b"".join(got)


_CACHES: dict[str, WordCache] = {}


def word_cache(path: str) -> WordCache:
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


class Windows:
    """Partially filled windows by fill level, and the level array that picks one.

    A window is a list of pieces ``(doc_id, start, doc_tokens, bytes)``; ``close(window,
    fill)`` receives each finished one.
    """

    def __init__(self, size: int, close, max_open: int):
        self.size, self.close, self.max_open = size, close, max_open
        # twice the number of open windows at each level: what one more there adds to the
        # sum of squares, less 1; and the same as a gain from leaving, none where none is
        self.cost = np.zeros(size + 1, dtype=np.int32)
        self.gain = np.full(size + 1, -(1 << 30), dtype=np.int32)
        self.stacks: dict[int, list[list]] = {}
        self.n_open = 0

    def _count(self, level: int, change: int) -> None:
        n = self.cost[level] + 2 * change
        self.cost[level] = n
        self.gain[level] = n if n else -(1 << 30)

    def best_level(self, length: int) -> int:
        """The level whose window, given ``length`` more, leaves the smallest sum of
        squares; ties go to the fuller window, 0 is a new window."""
        top = self.size - length
        if top:
            # (n-1)^2 - n^2 at the level left and (n+1)^2 - n^2 at the level reached
            change = self.cost[length + 1:] - self.gain[1:top + 1]
            change[-1] = -1 - self.gain[top]  # it fills up: no level is reached
            at = top - int(np.argmin(change[::-1]))
            if change[at - 1] + 2 <= self.cost[length] + 1:
                return at
        return 0

    def add(self, piece: tuple, length: int) -> None:
        if length == self.size:
            self.close([piece], length)
            return
        level = self.best_level(length)
        window = []
        if level:
            window = self.stacks[level].pop()
            self._count(level, -1)
            self.n_open -= 1
        window.append(piece)
        self._put(window, level + length)
        if self.n_open > self.max_open:
            self.drain(self.max_open // 2)

    def _put(self, window: list, fill: int) -> None:
        if fill == self.size:
            self.close(window, fill)
        elif fill:
            self.stacks.setdefault(fill, []).append(window)
            self._count(fill, 1)
            self.n_open += 1

    def drain(self, keep: int) -> None:
        """Cut the emptiest windows to fill the fullest until at most ``keep`` are open
        (one stays open if none is to be kept)."""
        opened = [(fill, w) for fill in sorted(self.stacks) for w in self.stacks[fill]]
        self.stacks, self.n_open = {}, 0
        self.cost[:] = 0
        self.gain[:] = -(1 << 30)
        low, high = 0, len(opened) - 1
        while low < high and high - low + 1 > keep:
            fill, full = opened[high]
            spare, donor = opened[low]
            while fill < self.size and donor:
                piece = donor.pop()
                n = len(piece[3]) // 4
                if n > self.size - fill:
                    cut = n - (self.size - fill)
                    donor.append((piece[0], piece[1], piece[2], piece[3][:4 * cut]))
                    piece = (piece[0], piece[1] + cut, piece[2], piece[3][4 * cut:])
                    n -= cut
                full.append(piece)
                fill, spare = fill + n, spare - n
            opened[low], opened[high] = (spare, donor), (fill, full)
            if fill == self.size:
                self.close(full, fill)
                high -= 1
            if not donor:
                low += 1
        for fill, window in opened[low:high + 1]:
            self._put(window, fill)

    def finish(self) -> None:
        """Close everything; the last window is cut at powers of two."""
        self.drain(0)
        for fill, stack in self.stacks.items():
            for window in stack:
                while fill:
                    part = 1 << (fill.bit_length() - 1)
                    taken, room = [], part
                    while room:
                        piece = window.pop()
                        n = len(piece[3]) // 4
                        if n > room:
                            cut = n - room
                            window.append((piece[0], piece[1], piece[2], piece[3][:4 * cut]))
                            piece = (piece[0], piece[1] + cut, piece[2], piece[3][4 * cut:])
                            n = room
                        taken.append(piece)
                        room -= n
                    self.close(taken, part)
                    fill -= part
        self.stacks = {}


def _pack_partition(path: str, size: int, end_id: int, max_open: int):
    end = np.asarray([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                        ("offset", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        held = 0

        def close(window: list, fill: int) -> None:
            nonlocal sequence, held
            offset = 0
            for doc, start, total, raw in window:
                n = len(raw) // 4
                rows.append((doc, start, n, total, sequence, offset, raw))
                offset += n
            held += 4 * fill
            sequence += 1

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            held = 0
            return out

        windows = Windows(size, close, max_open)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            texts = (t.as_py() or "" for t in batch.column(1))
            for doc, ids in zip(docs, cache.ids(texts)):
                ids += end
                total = len(ids) // 4
                for at in range(0, total, size):
                    piece = ids[4 * at:4 * (at + size)]
                    windows.add((doc, at, total, piece), len(piece) // 4)
                if len(rows) >= FLUSH_ROWS or held >= FLUSH_BYTES:
                    yield flush()
        windows.finish()
        if rows:
            yield flush()
    return run


def pack(df: DataFrame, tokenizer_path: str, *, window: int = 4096, end_id: int = 2,
         max_open: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens.

    Returns one row per piece: ``doc_id, start`` (the document's tokens before it),
    ``length, doc_tokens, sequence_id, offset`` (place in the sequence, gapless from 0) and
    ``ids`` (little-endian uint32).  A document's tokens are its text's ids and ``end_id``.

    Sequences shorter than ``window`` occur only at powers of two, at most
    ``log2(window)`` of them for each scan partition.  Open windows are bounded by
    ``max_open``, so memory is bounded whatever the lengths are.

    Edge cases: a null or empty text is the single id ``end_id``; a text longer than a
    window is cut into whole windows and a rest; repeated rows (also with the same id) are
    packed each on their own; a null id is carried as null; an empty table gives no rows;
    other columns of ``df`` (whatever their names) are not read.
    """
    if not 1 <= window or window & (window - 1):
        raise ValueError("window must be a power of two")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_pack_partition(tokenizer_path, window, end_id, max_open),
                           PIECE_SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with their ids replaced by the CRC-32 of their bytes."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
