"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# What a write has shuffled is of no use once it is written.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths staged inside each open ``scratch``.
_OPEN: list[list[str]] = []


def build_session(app_name: str = "loanweave", cores: int | str = "*", **conf: object) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` has set.

    Local mode may fall back to a temporary folder. On a cluster a missing setting
    is an error: a machine-local folder would be lost together with its executor. Whether a ``file:`` path is a
    shared mount cannot be seen from here; it is taken as named.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="loanweave-")
    spark.conf.set(CHECKPOINT_CONF, fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, known to ``scratch``."""
    path = f"{shared_dir(spark).rstrip('/')}/loanweave/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end; results must have been written elsewhere by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _OPEN.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(hadoop).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor re-reads files instead of recomputing, and
    the later passes over the result read only the columns they need. Shuffle files of the write are
    removed at its end, so a chain of stages holds those of one stage at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)
