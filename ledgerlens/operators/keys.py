"""Dense sequential keys without a single-partition window.

``row_number().over(Window.orderBy(...))`` with no partition drags the
whole table into one task.  ``dense_surrogate_key`` numbers rows 1..N in
the same order, in parallel:

1. range-partition on the order keys and sort within partitions, then
   materialise that layout once with ``checkpoint()`` (reliable storage in
   the session's checkpoint folder), so partition contents are fixed even
   if executors are lost and tasks recomputed;
2. count rows per partition -- one tiny row per partition, the only data
   that reaches a single task -- and turn the counts into start offsets
   with a running-sum window;
3. number each row as ``offset[partition] + position in partition``, the
   position coming from ``monotonically_increasing_id`` (its low 33 bits are
   the record index within the partition).  The offsets table has one row
   per partition, so broadcasting it is bounded by the partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def dense_surrogate_key(df: DataFrame, order_by: Sequence[str | Column], key: str = "surrogate_key",
                        num_partitions: int | None = None) -> DataFrame:
    """Append ``key`` = 1..N following ``order_by`` (ascending, nulls first).

    Ties in ``order_by`` are numbered in an arbitrary (hash) order; pass a
    total order for reproducible keys.  Only exact duplicate rows share a
    range partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    # A hash of the whole row as last key spreads rows that tie on ``order_by``
    # over partitions, so a hot key cannot pile into one range partition.
    spread = cols + [F.xxhash64(*[F.col(c) for c in df.columns])]
    # Without an explicit count AQE sizes the range exchange from the data
    # (a 26-row dimension gets one partition, not spark.sql.shuffle.partitions);
    # it merges only adjacent ranges, so the global order is kept.
    ranged = df.repartitionByRange(num_partitions, *spread) if num_partitions else df.repartitionByRange(*spread)
    laid_out = ranged.sortWithinPartitions(*spread).checkpoint(eager=True)
    tagged = laid_out.select(
        "*",
        F.spark_partition_id().alias("__pid"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))).alias("__pos"),
    )
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).fillna(0, subset=["__off"])
    numbered = tagged.join(F.broadcast(offsets), "__pid")
    out_cols = [c for c in df.columns]
    return numbered.select(
        (F.col("__off") + F.col("__pos") + F.lit(1)).cast("bigint").alias(key), *out_cols
    )
