"""Quality rules: base counts of a text and zstandard compression bands.

Ratios (compressed / raw bytes) are taken over the whole document and over fixed chunks.
How far prose compresses depends on its length, so each length band has its own limits:
below the low one a text repeats itself, above the high one it is noise (keys, encoded
data).  One pass over the scan, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from vigil.llm.store import boxed

LEVEL = 3
CHUNK_BYTES = 4096
#: (shortest length in bytes, lowest ratio, highest ratio); None: not judged
BANDS = ((0, None, None), (100, 0.32, 1.30), (250, 0.27, 0.98), (500, 0.24, 0.90),
         (1000, 0.21, 0.84), (2000, 0.19, 0.78), (4000, 0.17, 0.74), (16000, 0.14, 0.72))
#: part of the chunks that may lie outside the band of their length
CHUNK_SHARE = 0.3

MIN_WORDS, MAX_REPEAT = 50, 50  # words; per cent of words in repeated windows

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOL = re.compile(r"[#*$%&|<>]")

SCHEMA = pa.schema([("n_words", pa.int64()), ("word_chars", pa.int64()),
                    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                    ("n_repeat_words", pa.int64()), ("ratio", pa.float64()),
                    ("chunks", pa.int64()), ("low_chunks", pa.int64()),
                    ("high_chunks", pa.int64())])


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more (every occurrence counts)."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    a = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    _, pair = np.unique(a[:-1] * len(codes) + a[1:], return_inverse=True)
    _, three, count = np.unique(pair[:-1].astype(np.int64) * len(codes) + a[2:],
                                return_inverse=True, return_counts=True)
    again = count[three] > 1
    inside = np.zeros(n, dtype=bool)
    for k in range(3):
        inside[k:n - 2 + k] |= again
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated windows."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return (len(words), len(text) - sum(text.count(c) for c in _BLANKS),
            len(_SYMBOL.findall(text)), len(lines) - len(set(lines)), repeat_words(words))


def band(length: int) -> tuple[float | None, float | None]:
    """The limits for a length in bytes."""
    return next((lo, hi) for least, lo, hi in reversed(BANDS) if length >= least)


def ratios(compressor, raw: bytes) -> tuple[float | None, int, int, int]:
    """Ratio of the whole, number of chunks, chunks below and above their band.  A last
    chunk shorter than half is joined to the one before."""
    if not raw:
        return None, 0, 0, 0
    whole = len(compressor.compress(raw)) / len(raw)
    n = max(1, (len(raw) + CHUNK_BYTES // 2 - 1) // CHUNK_BYTES)
    if n == 1:
        part = [(len(raw), whole)]
    else:
        view, part = memoryview(raw), []
        for k in range(n):
            own = view[k * CHUNK_BYTES:(k + 1) * CHUNK_BYTES if k < n - 1 else len(raw)]
            part.append((len(own), len(compressor.compress(own)) / len(own)))
    low = sum(1 for size, r in part if (lim := band(size)[0]) is not None and r < lim)
    high = sum(1 for size, r in part if (lim := band(size)[1]) is not None and r > lim)
    return whole, n, low, high


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        rows = []
        for value in batch.column(1):
            text = value.as_py()
            raw = (text or "").encode()
            rows.append((*base_counts(text or ""), *ratios(compressor, raw),
                         None if text is None else len(raw)))
        if rows:
            made = [pa.array(c, t) for c, t in zip(zip(*rows), [*SCHEMA.types, pa.int64()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made],
                                             names=["__row", *SCHEMA.names, "n_bytes"])


def measure(df: DataFrame, keep_cols: list[str], *, text_col: str = "text") -> DataFrame:
    """``keep_cols`` and, for each row's whole text, the base counts, ``ratio`` (null for
    an empty text), ``chunks``, ``low_chunks``, ``high_chunks`` and ``n_bytes``.  A kept
    column with one of these names is replaced."""
    box, own = boxed(df.select(*[F.col(f"`{c}`") for c in keep_cols]),
                     {*SCHEMA.names, "n_bytes"})
    rows = df.select(box, F.col(f"`{text_col}`").cast("string").alias("__text"))
    made = [T.StructField(f.name, T.DoubleType() if f.type == pa.float64() else T.LongType())
            for f in [*SCHEMA, pa.field("n_bytes", pa.int64())]]
    return (rows.mapInArrow(_measure, T.StructType([rows.schema["__row"], *made]))
            .select(*own, *[f.name for f in made]))


def judge(measured: DataFrame) -> DataFrame:
    """Adds ``base_failed`` (too few words, or too many in repeated windows),
    ``repetitive``, ``incompressible`` and ``kept``.

    A text is repetitive (incompressible) if its ratio lies below (above) its length's
    band, or more than ``CHUNK_SHARE`` of its chunks do.  A null, empty or very short text
    fails the base rule.  Each row is judged on its own, so repeated rows agree.
    """
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for least, lo, hi in BANDS:  # the last band that fits wins
        low = F.when(F.col("n_bytes") >= least, F.lit(lo).cast("double")).otherwise(low)
        high = F.when(F.col("n_bytes") >= least, F.lit(hi).cast("double")).otherwise(high)
    outside = lambda c: F.col(c) > CHUNK_SHARE * F.col("chunks")
    return (measured
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
                100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
            .withColumn("repetitive", F.coalesce(F.col("ratio") < low, F.lit(False))
                        | outside("low_chunks"))
            .withColumn("incompressible", F.coalesce(F.col("ratio") > high, F.lit(False))
                        | outside("high_chunks"))
            .withColumn("kept", ~(F.col("base_failed") | F.col("repetitive")
                                  | F.col("incompressible"))))
