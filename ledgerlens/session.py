"""Session and shared-storage helpers.

Operators never create sessions; these helpers are for tests, the bench
and command-line runs.  On a cluster the session comes from the caller and
``spark.checkpoint.dir`` names a shared folder, which is honoured as is.
"""

from __future__ import annotations

import contextlib
import itertools
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession


def _driver_memory() -> str:
    """60 % of physical memory, at most 8 GiB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(8, int(total * 0.6 / 2**30)))}g"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "ledgerlens") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # HotSpot leaves longer methods uncompiled: wide cleaning projections run faster split up
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", _driver_memory())
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    The cluster's shared folder (``spark.checkpoint.dir``) wins.  A private
    temporary folder is created only in local mode with nothing configured
    (tests); on a cluster a machine-local folder would not be visible to the
    other executors, so an unset folder is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{base}/{name}-{os.getpid()}-{next(_SEQ)}"


_SEQ = itertools.count(1)  # thread-safe in CPython (next() is atomic)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run meanwhile remove their shuffle files when they end.

    Otherwise a long job keeps those of all its steps until the driver happens
    to collect garbage.  For steps whose result is written: a DataFrame that is
    run a second time would shuffle anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
