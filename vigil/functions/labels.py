"""Label expressions: binary collapse, taxonomy regrouping, indicators, thresholds,
arg-max, decoding and hit flags.  All are native Column expressions (no Python UDF)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The attack taxonomy of the connection records.  These must equal
# the source data's class names exactly (including the spelling "guess_password").
# ---------------------------------------------------------------------------
DOS_ATTACKS = ["apache2", "smurf", "neptune", "back", "teardrop", "pod", "land",
               "mailbomb", "processtable", "udpstorm"]
R2L_ATTACKS = ["warezclient", "guess_password", "warezmaster", "imap", "ftp_write", "named",
               "multihop", "phf", "spy", "sendmail", "snmpgetattack", "snmpguess", "worm",
               "xsnoop", "xlock"]
U2R_ATTACKS = ["buffer_overflow", "httptunnel", "rootkit", "loadmodule", "perl", "xterm",
               "ps", "sqlattack"]
PROBE_ATTACKS = ["satan", "saint", "ipsweep", "portsweep", "nmap", "mscan"]
NORMAL = "normal"
ATTACK = "attack"
UNKNOWN = "unknown"

# Group order matters: the first group that lists a name wins.
ATTACK_TAXONOMY: dict[str, list[str]] = {
    "dos": DOS_ATTACKS,
    "r2l": R2L_ATTACKS,
    "u2r": U2R_ATTACKS,
    "probe": PROBE_ATTACKS,
}


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def binary_label(col: str | Column, keep: str = NORMAL, other: str = ATTACK) -> Column:
    """P5: every value except ``keep`` becomes ``other``.  Null-safe: a missing label
    is "not keep", so it becomes ``other`` (a plain ``!=`` would leave it null)."""
    c = _c(col)
    return F.when(c.eqNullSafe(F.lit(keep)), F.lit(keep)).otherwise(F.lit(other))


def taxonomy_label(col: str | Column, taxonomy: Mapping[str, Iterable[str]] = ATTACK_TAXONOMY,
                   keep: Iterable[str] = (NORMAL,), default: str = UNKNOWN) -> Column:
    """Map names to their group; names in ``keep`` map to themselves; anything
    else (null included) maps to ``default``.  A CASE chain, evaluated in codegen."""
    c = _c(col)
    expr = None
    for group, names in taxonomy.items():
        cond = c.isin(list(names))
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    for name in keep:
        cond = c == F.lit(name)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def taxonomy_frame(spark: SparkSession, taxonomy: Mapping[str, Iterable[str]] = ATTACK_TAXONOMY,
                   keep: Iterable[str] = (NORMAL,)) -> DataFrame:
    """The taxonomy as a ``(name, category)`` dimension, first group winning on repeats."""
    rows, seen = [], set()
    for group, names in taxonomy.items():
        for name in names:
            if name not in seen:
                seen.add(name)
                rows.append((name, group))
    for name in keep:
        if name not in seen:
            seen.add(name)
            rows.append((name, name))
    return spark.createDataFrame(rows, "name string, category string")


def taxonomy_join(df: DataFrame, col: str, dim: DataFrame, out: str,
                  default: str = UNKNOWN, broadcast_rows: int = 1_000_000) -> DataFrame:
    """P6 for large taxonomies: left join to the ``(name, category)`` dimension.

    The dimension is broadcast only when its row count is at most ``broadcast_rows``
    (checked once); otherwise Spark plans a shuffle join."""
    n = dim.limit(broadcast_rows + 1).count()
    right = dim.select(F.col("name").alias("__tx_name"), F.col("category").alias("__tx_cat"))
    if n <= broadcast_rows:
        right = F.broadcast(right)
    joined = df.join(right, F.col(col) == F.col("__tx_name"), "left")
    return joined.withColumn(out, F.coalesce(F.col("__tx_cat"), F.lit(default))).drop("__tx_name", "__tx_cat")


def indicator(col: str | Column, value) -> Column:
    """1 where ``col == value`` else 0 (null compares as 0)."""
    return F.coalesce((_c(col) == F.lit(value)).cast("int"), F.lit(0))


def threshold(col: str | Column, t: float = 0.5) -> Column:
    """Strict ``> t`` as 0/1 (exactly ``t`` gives 0)."""
    return (_c(col) > F.lit(t)).cast("int")


def argmax(arr: str | Column) -> Column:
    """0-based index of the largest element; ties go to the first."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def decode(code: str | Column, labels: list[str]) -> Column:
    """Code -> label through a literal label array (0-based codes)."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), _c(code).cast("int") + 1)


def hit(actual: str | Column, predicted: str | Column) -> Column:
    """1 where the two labels are equal."""
    return (_c(actual) == _c(predicted)).cast("int")
