"""Tables stored in hash buckets of a key: joins on that key leave them where they are.

For a dimension above the broadcast limit: it is shuffled once, when it is
written, and every later join moves only the other side.  The files lie in an
ordinary folder; the session's catalog holds their layout, which ``open_bucketed``
declares again in another session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _declare(spark: SparkSession, name: str, path: str, ddl: str, keys: Sequence[str], buckets: int) -> DataFrame:
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE `{name}` ({ddl}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(f"`{name}`")


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` below ``path`` as ``buckets`` buckets of ``keys`` and read it as table ``name``.

    One shuffle by the keys, so that each bucket is one file: meant for
    dimensions, whose keys are (nearly) unique.  A fact with a hot key should be
    aggregated before the join instead (``star_slices.star_cost_report_bucketed``).
    """
    if buckets < 1 or not keys:
        raise ValueError("at least one bucket and one key")
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    dealt.write.mode("errorifexists").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option(
        "path", path).saveAsTable(f"`{name}`")
    return df.sparkSession.table(f"`{name}`")


def open_bucketed(spark: SparkSession, name: str, path: str, ddl: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The table that ``write_bucketed`` left below ``path``, under its declared columns and layout."""
    return _declare(spark, name, path, ddl, keys, buckets)
