"""Headerless CSV of connection records.

Types are declared, never inferred: inference costs a full extra pass over the data
and silently changes with the sample.  ``FAILFAST`` makes a malformed number an error
instead of a silent null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The 43 field names of a connection record, in file order.
# ---------------------------------------------------------------------------
CONNECTION_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land",
    "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in", "num_compromised",
    "root_shell", "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate", "class",
    "difficulty",
]
CATEGORICAL = ["protocol_type", "service", "flag"]
FLAGS = {"land", "logged_in", "root_shell", "su_attempted", "is_host_login", "is_guest_login"}
LABEL = "class"
DIFFICULTY = "difficulty"


def _type(name: str) -> T.DataType:
    if name in CATEGORICAL or name == LABEL:
        return T.StringType()
    if name in FLAGS or name == DIFFICULTY:
        return T.IntegerType()
    if name.endswith("_rate"):
        return T.DoubleType()
    return T.LongType()


def connection_schema(with_difficulty: bool = True) -> T.StructType:
    """S1 (43 fields) or S2 (42 fields, no ``difficulty``)."""
    names = CONNECTION_COLUMNS if with_difficulty else CONNECTION_COLUMNS[:-1]
    return T.StructType([T.StructField(n, _type(n), True) for n in names])


def feature_columns(with_difficulty: bool = True) -> list[str]:
    """Every field but the label (and ``difficulty``)."""
    return [c for c in connection_schema(with_difficulty).names if c not in (LABEL, DIFFICULTY)]


def read_connections(spark: SparkSession, path: str, with_difficulty: bool = True,
                     mode: str = "FAILFAST") -> DataFrame:
    """Headerless CSV with declared names and types."""
    return spark.read.csv(path, schema=connection_schema(with_difficulty), header=False, mode=mode)


def read_with_header(spark: SparkSession, path: str) -> DataFrame:
    """S3: first record as header, types inferred (opt-in only: on headerless data the
    first record is lost, and inference scans the input once more)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                   mode: str = "FAILFAST") -> DataFrame:
    """A CSV written by :func:`vigil.sources.sinks.write_csv`, read back with its schema."""
    return (spark.read.schema(schema).option("header", header).option("mode", mode)
                 .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path))
