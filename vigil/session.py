"""Session helpers: the settings every job in this package relies on."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "vigil",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (a cluster brings its own session)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = {**BASE_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": driver_memory,
            **(extra or {})}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session without that
    setting (tests) gets a fresh scratch folder; a cluster must name a shared one.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(id(sc))
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = _LOCAL_DIRS.setdefault(id(sc), tempfile.mkdtemp(prefix="vigil-ckpt-"))
    sc.setCheckpointDir(path)
    return path


_LOCAL_DIRS: dict[int, str] = {}


#: session setting: shuffle files of an execution go when it ends (else when the driver collects garbage)
DROP_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROPPING: dict[int, tuple[int, str | None]] = {}   # by JVM session: who is inside, the setting before
_DROPPING_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executions begun inside leave no shuffle files behind.  For writes of tables that are read
    again instead: nothing reads such shuffles twice, and they would take disk until the driver
    happens to collect its garbage."""
    key = spark._jsparkSession.hashCode()
    with _DROPPING_LOCK:
        inside, before = _DROPPING.get(key, (0, spark.conf.get(DROP_SHUFFLES_CONF, None)))
        _DROPPING[key] = inside + 1, before
        spark.conf.set(DROP_SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            inside, before = _DROPPING.pop(key)
            if inside > 1:
                _DROPPING[key] = inside - 1, before
            elif before is None:
                spark.conf.unset(DROP_SHUFFLES_CONF)
            else:
                spark.conf.set(DROP_SHUFFLES_CONF, before)
