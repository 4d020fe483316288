"""Scalar helpers: keyed hashes, guarded division, formatting, run clocks."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

TWO_32 = 4294967296  # 2**32


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: session setting that picks the keyed hash: "md5" (default) or "xxhash64"
HASH_CONF = "vigil.keyedHash"


def _hash_algo() -> str:
    spark = SparkSession.getActiveSession()
    return spark.conf.get(HASH_CONF, "md5") if spark is not None else "md5"


def keyed_u32(seed, *keys: str | Column) -> Column:
    """A uniform 32-bit integer from ``md5(seed|k1|k2…)`` (first 8 hex digits).

    Every random choice in this package (splits, folds, flips, SMOTE draws) is derived
    from this hash of the row key, so results do not depend on partitioning or on task
    retries, and any SQL engine with ``md5`` reproduces them.  With the session setting
    ``vigil.keyedHash=xxhash64`` the low 32 bits of Spark's ``xxhash64`` are used
    instead: several times cheaper per row, still deterministic, but Spark-specific."""
    if _hash_algo() == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(str(seed)), *[_c(k) for k in keys]), F.lit(TWO_32))
    parts = [F.lit(str(seed))] + [_c(k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def keyed_uniform(seed, *keys: str | Column) -> Column:
    """A double in [0, 1) from :func:`keyed_u32`."""
    return keyed_u32(seed, *keys) / F.lit(float(TWO_32))


def safe_div(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    """``num / den`` or ``default`` when ``den`` is 0 or null."""
    n, d = _c(num), _c(den)
    return F.when(d.isNotNull() & (d != 0), n.cast("double") / d.cast("double")).otherwise(F.lit(default))


def fixed4(col: str | Column) -> Column:
    """text with four decimals."""
    return F.format_string("%.4f", _c(col).cast("double"))


def stamp(ts: str | Column) -> Column:
    """``yyyy-MM-dd-HH-mm-ss`` text of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM-dd-HH-mm-ss")


def complement(col: str | Column) -> Column:
    """``1 - x`` of a 0/1 column."""
    return (F.lit(1) - _c(col)).cast("int")


def index_of(arr: str | Column, value) -> Column:
    """F8: 0-based position of ``value`` in ``arr``; -1 when absent."""
    return (F.array_position(_c(arr), F.lit(value)) - 1).cast("int")


def sign01(col: str | Column) -> Column:
    """L2 normalisation of a width-1 vector is its sign (0 stays 0)."""
    return F.signum(_c(col).cast("double"))


def round_half_away(col: str | Column, digits: int) -> Column:
    """Round to ``digits`` decimals, half away from zero, as ``x·10^d`` rounded and divided
    back: plain double arithmetic inside codegen (Spark's ``round`` on doubles goes
    through BigDecimal, an order of magnitude slower), and the same bits — signed zero
    included — as SQL engines that round this way."""
    c = _c(col).cast("double")
    m = float(10 ** digits)
    rounded = F.signum(c) * F.floor(F.abs(c) * F.lit(m) + F.lit(0.5)) / F.lit(m)
    # beyond 2^53 a double has no such decimals; infinities and NaN stay as they are
    return F.when(F.abs(c) * F.lit(m) < F.lit(2.0 ** 53), rounded).otherwise(c)
