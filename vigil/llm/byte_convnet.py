"""Language identification by a byte convolutional network.

Texts are cut into windows of fixed length (all of them, to the end).  Filters of several
widths run over a window's bytes; the first layer takes one-hot bytes, so a filter tap is
a table of 256 rows and a convolution a sum of table rows.  Each filter's largest response
is pooled, a dense softmax layer gives language probabilities, and a document's are the
mean over its windows, weighted by their letters' bytes.  Trained in numpy with Adam on a
bounded sample of labelled windows; applied to batches of windows in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vigil.llm.store import boxed, keep

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
#: bounds of the training sample: documents of a language, windows of a document
DOCS_PER_LANG, WINDOWS_PER_DOC = 400, 3
#: languages up to which their list is broadcast, else joined by a shuffle
FEW_LANGS = 100_000
EPOCHS, BATCH, RATE, SEED = 10, 64, 0.02, 7
#: windows scored at once
BLOCK = 512

UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")
#: bytes that make up letters: ASCII letters and all bytes of longer UTF-8 sequences
_IS_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])


def has_letter(text: str) -> bool:
    """Whether a text has a letter (Unicode category L; superscripts, circled and Roman
    numerals are none)."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


class Model(NamedTuple):
    langs: list[str]
    taps: list[list[np.ndarray]]  # by width, by tap: 256 x FILTERS
    bias: list[np.ndarray]        # by width
    dense: np.ndarray             # pooled features x languages
    dense_bias: np.ndarray


def windows_of(raw: bytes) -> np.ndarray:
    """All windows of a text's bytes, the last padded with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


def _responses(model: Model, k: int, x: np.ndarray) -> np.ndarray:
    """Windows x positions x filters for one width."""
    width = WIDTHS[k]
    span = WINDOW - width + 1
    out = model.taps[k][0].take(x[:, :span], axis=0)
    for t in range(1, width):
        out += model.taps[k][t].take(x[:, t:t + span], axis=0)
    return out


def probabilities(model: Model, x: np.ndarray) -> np.ndarray:
    """Softmax over languages for each window."""
    pooled = np.concatenate([np.maximum(_responses(model, k, x).max(axis=1) + model.bias[k], 0)
                             for k in range(len(WIDTHS))], axis=1)
    z = pooled @ model.dense + model.dense_bias
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, langs: list[str]) -> Model:
    """Fit on windows ``x`` with language indices ``y``.  Gradients reach a filter's taps
    only at the pooled position, so they are sums over few table rows."""
    rng = np.random.default_rng(SEED)
    f32 = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    model = Model(langs, [[f32(256, FILTERS, s=0.3 / w ** 0.5) for _ in range(w)] for w in WIDTHS],
                  [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                  f32(len(WIDTHS) * FILTERS, len(langs), s=0.3),
                  np.zeros(len(langs), np.float32))
    params = [t for taps in model.taps for t in taps] + model.bias + [model.dense,
                                                                     model.dense_bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step, cols = 0, np.arange(FILTERS)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            xb, yb = x[order[at:at + BATCH]], y[order[at:at + BATCH]]
            n, peaks, raw = len(xb), [], []
            for k in range(len(WIDTHS)):
                r = _responses(model, k, xb)
                peaks.append(r.argmax(axis=1))
                raw.append(np.take_along_axis(r, peaks[k][:, None, :], 1)[:, 0] + model.bias[k])
            pooled = np.concatenate([np.maximum(r, 0) for r in raw], axis=1)
            z = pooled @ model.dense + model.dense_bias
            z -= z.max(axis=1, keepdims=True)
            e = np.exp(z)
            d = e / e.sum(axis=1, keepdims=True)
            d[np.arange(n), yb] -= 1
            d /= n
            back = (d @ model.dense.T) * (pooled > 0)
            tap_grads, bias_grads = [], []
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                bias_grads.append(g.sum(axis=0))
                for t in range(width):
                    byte = np.take_along_axis(xb, peaks[k] + t, axis=1).astype(np.int64)
                    tap_grads.append(np.bincount(
                        (byte * FILTERS + cols).ravel(), weights=g.ravel(),
                        minlength=256 * FILTERS).reshape(256, FILTERS).astype(np.float32))
            grads = tap_grads + bias_grads + [pooled.T @ d, d.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (RATE / (1 + step / 200)) * (m / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)
    return model


def held_out(key: Column) -> Column:
    """True for the quarter of ids (CRC-32 of the id as text, modulo 4, is 2) never learnt
    from; a null id is not held out, and not learnt from either."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for lang, spot, text in zip(*(c.to_pylist() for c in batch.columns)):
            raw = text.encode()
            room = max(0, len(raw) - WINDOW)
            # starts spread over the text, the first by the document's hash
            starts = sorted({(spot + k * (room // WINDOWS_PER_DOC + 1)) % (room + 1)
                             for k in range(WINDOWS_PER_DOC)})
            rows += [(lang, spot, raw[s:s + WINDOW].ljust(WINDOW, b"\0")) for s in starts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in
             enumerate((pa.string(), pa.int64(), pa.binary()))], names=["lang", "spot", "raw"])


def fit(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model | None:
    """Model learnt from text and language of rows that are not held out; None if there are
    none.

    All labelled languages are learnt.  The sample of each is bounded: about
    ``DOCS_PER_LANG`` documents, chosen by a hash of the id, ``WINDOWS_PER_DOC`` windows each,
    and at most twice as many windows, those of the smallest hashes (a repeated id may stand
    for many rows).
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    lang = F.col(f"`{lang_col}`").cast("string")
    known = df.where(key.isNotNull() & lang.isNotNull() & ~held_out(key)).select(
        lang.alias("lang"), F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1 << 40)).alias("spot"),
        text.cast("string").alias("text"))
    share = F.least(F.lit(1.0), 1.3 * DOCS_PER_LANG / F.count(F.lit(1)))
    limits = keep(known.groupBy("lang").agg((share * (1 << 40)).cast("long").alias("limit")), "languages")
    if limits.count() <= FEW_LANGS:
        limits = F.broadcast(limits)
    windows = (known.join(limits, "lang").where("spot < limit AND trim(text) != ''")
               .select("lang", "spot", "text")
               .mapInArrow(_sample_windows, "lang string, spot long, raw binary"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("spot", "raw"))
    rows = (windows.withColumn("first", first)
            .where(F.col("first") <= 2 * DOCS_PER_LANG * WINDOWS_PER_DOC).drop("first").collect())
    rows = sorted((r["lang"], r["spot"], bytes(r["raw"])) for r in rows)
    langs = sorted({r[0] for r in rows})
    if not langs:
        return None
    place = {name: i for i, name in enumerate(langs)}
    x = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([place[r[0]] for r in rows]), langs)


def _predict(model: Model | None, inside: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            best, score = [UNKNOWN] * n, [0.0] * n
            sums = np.zeros((n, len(model.langs) if model else 1))
            weight = np.zeros(n)
            owners: list[int] = []
            block: list[np.ndarray] = []

            def apply() -> None:
                x, own = np.concatenate(block), np.repeat(owners, [len(b) for b in block])
                for at in range(0, len(x), BLOCK):
                    part, who = x[at:at + BLOCK], own[at:at + BLOCK]
                    w = _IS_LETTER[part].sum(axis=1).astype(np.float64)
                    p = probabilities(model, part) * w[:, None]
                    np.add.at(sums, who, p)
                    np.add.at(weight, who, w)
                block.clear()
                owners.clear()

            if model:
                texts = batch.column(0).field(inside) if inside else batch.column(1)
                for i, value in enumerate(texts):
                    text = value.as_py()
                    if text and has_letter(text):
                        owners.append(i)
                        block.append(windows_of(text.encode()))
                        if sum(map(len, block)) >= BLOCK:
                            apply()
                if block:
                    apply()
                for i in np.flatnonzero(weight):
                    k = int(sums[i].argmax())
                    best[i], score[i] = model.langs[k], float(min(1.0, sums[i, k] / weight[i]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=["__row", "lang_pred", "score"])
    return run


def predict(df: DataFrame, model: Model | None, *, columns: list[str] | None = None,
            text_col: str = "text") -> DataFrame:
    """``df`` (all columns, or the given ones) with ``lang_pred`` and ``score`` (mean
    probability, 0 to 1) of each whole text.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if
    the model is None (nothing to learn from); equal probabilities go to the first language
    by name.  Each row is judged on its own text.  Columns of ``df`` with these names are
    replaced.
    """
    box, own = boxed(df.select(*columns) if columns else df, {"lang_pred", "score"})
    rows = df.select(box, F.col(f"`{text_col}`").cast("string").alias("__text"))
    inside = text_col if columns is None and dict(df.dtypes).get(text_col) == "string" else None
    if inside:  # the text is in the row already
        rows = rows.select("__row")
    schema = T.StructType([rows.schema["__row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return (rows.mapInArrow(_predict(model, inside), schema).select(*own, "lang_pred", "score"))
