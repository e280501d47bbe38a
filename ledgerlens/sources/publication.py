"""Several tables published as one version.

Overwriting eight tables one after the other leaves a reader, or a job that
fails in the fifth, with half a star.  Here every run writes into a folder of
its own; when all tables are there, one small manifest file is added that names
them.  Spark's committer puts that file in place by a single rename (or a
single upload), so the version exists whole or not at all.  A reader takes the
paths from the newest manifest and keeps them: a later publication changes no
file it reads.

Two runs at once both publish; the one with the higher version (then the later
time, then the id) is read.  A folder without a manifest belongs to a run that
failed or is under way, and is never read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, published_at double, run string, table_name string, folder string, ddl string, row_count long"


class Entry(NamedTuple):
    table_name: str
    folder: str  # below the root
    ddl: str
    row_count: int


def _manifests(spark: SparkSession, root: str) -> list:
    """All manifest rows: as many as there are published tables."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def versions(spark: SparkSession, root: str) -> list[tuple[int, float, str]]:
    """(version, time, run) of what was published, in reading order."""
    return sorted({(r["version"], r["published_at"], r["run"]) for r in _manifests(spark, root.rstrip("/"))})


class Publication:
    """One run: ``write`` the tables, then ``commit`` them together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        published = versions(spark, self.root)
        self.version = (published[-1][0] if published else 0) + 1
        self.run = uuid.uuid4().hex
        self.entries: dict[str, Entry] = {}

    def write(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
        """Write a table of the version and read it back.  Its rows are counted while they are written.

        ``cluster_by`` deals the rows to files by ranges and sorts each file, so
        that the statistics of its row groups let a filter skip most of them.
        """
        if name in self.entries:
            raise ValueError(f"{name} is already in this version")
        folder = f"versions/v{self.version:08d}-{self.run}/{name}"
        seen = Observation()
        out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by) if cluster_by else df
        writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/{folder}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        self.entries[name] = Entry(name, folder, ddl, seen.get["rows"])
        return _read(self.spark, self.root, self.entries[name])

    def paths(self) -> dict[str, str]:
        return {e.table_name: f"{self.root}/{e.folder}" for e in self.entries.values()}

    def commit(self) -> int:
        """Publish the tables that were written; the version's number."""
        if not self.entries:
            raise ValueError("nothing was written")
        now = time.time()
        rows = [(self.version, now, self.run, *e) for e in self.entries.values()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return self.version


def _read(spark: SparkSession, root: str, entry: Entry) -> DataFrame:
    df = spark.read.schema(entry.ddl).parquet(f"{root}/{entry.folder}")
    return df.select(*[F.col(f"`{f.name}`") for f in spark.createDataFrame([], entry.ddl).schema.fields])


def read_published(spark: SparkSession, root: str, version: int | None = None, names: Sequence[str] | None = None,
                   register_views: bool = False) -> dict[str, DataFrame]:
    """The tables of the newest (or the given) version, all of one run."""
    root = root.rstrip("/")
    rows = [r for r in _manifests(spark, root) if version is None or r["version"] == version]
    if not rows:
        raise LookupError(f"{root}: no version{'' if version is None else f' {version}'} is published")
    newest = max((r["version"], r["published_at"], r["run"]) for r in rows)
    found = {r["table_name"]: Entry(r["table_name"], r["folder"], r["ddl"], r["row_count"]) for r in rows
             if (r["version"], r["published_at"], r["run"]) == newest}
    if missing := [n for n in names or () if n not in found]:
        raise LookupError(f"{root}: version {newest[0]} has no {missing}")
    out = {}
    for name in names or found:
        out[name] = _read(spark, root, found[name])
        if register_views:
            out[name].createOrReplaceTempView(name)
    return out


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders of all but the newest ``keep`` versions, and of failed runs as old; their names.

    A reader that still holds an expired version fails on its next file; a run
    that is under way is newer than what is published and is left alone.
    """
    if keep < 1:
        raise ValueError("keep at least the version that is read")
    published = versions(spark, root)
    if len(published) <= keep:
        return []
    kept = published[-keep:]
    names = {f"v{v:08d}-{run}" for v, _, run in kept}
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/versions")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name not in names and int(name[1:9]) <= kept[-1][0]:
            files.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
