"""Small derived sides of a join: written once, then sized in bytes by Spark.

A side that is derived from big data (a distinct-name map, a dimension) has
no known size when the join is planned, so the big side would be shuffled to
meet it.  Written as Parquet it has one: Spark broadcasts it below its own
byte limit (``spark.sql.autoBroadcastJoinThreshold``) and shuffles it above.
Nothing is hinted here, and no row count stands in for bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again."""
    return staged_at(df, scratch_path(df.sparkSession, name))


def staged_at(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``df`` written at ``path`` and read again; who names the path may remove it."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
