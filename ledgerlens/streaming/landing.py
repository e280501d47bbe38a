"""Pick up newly landed raw exports exactly once, then refresh the star.

The source runs its job periodically over a landing folder.  Here each
source folder is a Structured Streaming file source with the declared raw
schema: ``trigger(availableNow=True)`` processes every file that arrived
since the last run and stops, and the checkpoint records which files were
taken, so a rerun (or a run after an executor / driver loss) neither skips
nor repeats a file.  The checkpoint is the caller's to name and must be the
same folder in every application: one below the session's checkpoint folder
is new each time, and the file sink would drop what a fresh one hands it.  Landed rows are appended to a Parquet "landed" table
per source; the star is then rebuilt from those tables (full rebuild, the
same semantics as the batch job).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import etl
from ..sources import files
from ..sources.schemas import RAW_SOURCES


def land_new_exports(spark: SparkSession, landing: Mapping[str, str], landed_root: str,
                     checkpoint_root: str) -> dict[str, int]:
    """Append rows of files not seen before; returns rows taken per source."""
    if not checkpoint_root:
        raise ValueError("name a checkpoint folder that stays the same between runs")
    ckpt = checkpoint_root.rstrip("/")
    taken = {}
    for name, path in landing.items():
        stream = (
            # enforceSchema off: a file whose header names other columns fails instead of shifting values
            spark.readStream.schema(RAW_SOURCES[name]).options(**files.CSV_OPTIONS, enforceSchema="false").csv(path)
            .withColumn("_source_file", F.input_file_name())
        )
        q = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", f"{ckpt}/landing/{name}")
            .outputMode("append")
            .trigger(availableNow=True)
            .start(f"{landed_root.rstrip('/')}/{name}")
        )
        q.awaitTermination()
        taken[name] = sum(p.get("numInputRows", 0) for p in q.recentProgress)
    return taken


def read_landed(spark: SparkSession, landed_root: str) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(schema).parquet(f"{landed_root.rstrip('/')}/{name}")
        for name, schema in RAW_SOURCES.items()
    }


def refresh_star(spark: SparkSession, landed_root: str, out_root: str, cfg: etl.ProgramConfig) -> dict[str, str]:
    """Rebuild all eight star tables from everything landed so far, as one new version."""
    done = etl.publish(spark, read_landed(spark, landed_root), out_root, cfg)
    return done.paths()
