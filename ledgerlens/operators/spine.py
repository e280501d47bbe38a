"""Reports on every calendar month, billed or not.

A report that groups what was billed has no row for a month without a bill, so
a curve jumps over it and a change has nothing to compare with.  ``month_spine``
makes the months of every group (from its first to its last, or to a planned
end), ``on_spine`` puts sums on them, and ``carry_forward`` gives a month the
last value known before it.  All of it runs on the (group, month) grain, after
the aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import normalize_period
from .evm import evm_trend_on, summed_components
from .reports import planned_curve


def month_spine(df: DataFrame, keys: Sequence[str], month: str, end: Column | None = None) -> DataFrame:
    """One row per group and calendar month (a date) from its first month to its last, or to ``end`` if that is later."""
    spans = df.where(F.col(month).isNotNull()).groupBy(*keys).agg(F.min(month).alias("__lo"), F.max(month).alias("__hi"))
    last = F.col("__hi") if end is None else F.greatest("__hi", F.trunc(end, "month"))
    months = F.sequence(F.trunc("__lo", "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return spans.select(*keys, F.explode(months).alias(month))


def on_spine(df: DataFrame, keys: Sequence[str], month: str, end: Column | None = None) -> DataFrame:
    """The rows of ``df`` (one per group and month) on the spine: months without one have nulls.

    Rows whose month is null stay as they are; a null group is a group.
    """
    spine = month_spine(df, keys, month, end).select(*[F.col(c).alias(f"__{c}") for c in [*keys, month]])
    same = None
    for c in [*keys, month]:
        equal = F.col(f"__{c}").eqNullSafe(F.col(c))
        same = equal if same is None else same & equal
    known = df.where(F.col(month).isNotNull())
    filled = spine.join(known, same, "left").select(
        *[F.col(f"__{c}").alias(c) if c in (*keys, month) else F.col(c) for c in df.columns])
    return filled.unionByName(df.where(F.col(month).isNull()))


def carry_forward(df: DataFrame, keys: Sequence[str], month: str, columns: Sequence[str]) -> DataFrame:
    """Nulls of ``columns`` replaced by the last known value of an earlier month of the group."""
    so_far = Window.partitionBy(*keys, F.col(month).isNull()).orderBy(month).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.coalesce(F.col(c), F.last(c, ignorenulls=True).over(so_far)) for c in columns})


def scurve_every_month(fact_pay: DataFrame, shape: str = "linear", planned_end: str | None = None) -> DataFrame:
    """The planned and the actual curve for every month of a building, to ``planned_end`` at least.

    ``billed`` tells whether the month had a bill; ``monthly_spend`` is 0 where
    it had none.  ``reported_to_date`` adds up the last to-date amount that each
    contractor reported, in that month or before: a contractor without a bill
    keeps its amount.  Spend whose period cannot be read is a row of its own,
    outside both.
    """
    norm = fact_pay.withColumn("month", normalize_period("period"))
    end = None if planned_end is None else F.to_date(F.lit(planned_end), "yyyy-MM")
    monthly = norm.groupBy("building_id", "month").agg(F.sum("work_completed_this_period").alias("monthly_spend"),
                                                       F.lit(True).alias("billed"))
    contractors = norm.groupBy("building_id", "contractor_name", "trade").agg(F.max("scheduled_value").alias("sv"))
    budget = contractors.groupBy("building_id").agg(F.sum("sv").alias("budget"))
    full = on_spine(monthly, ["building_id"], "month", end).withColumns({
        "billed": F.coalesce("billed", F.lit(False)),
        "monthly_spend": F.when(F.col("billed").isNull(), F.lit(0)).otherwise(F.col("monthly_spend"))})

    last = norm.groupBy("building_id", "contractor_name", "month").agg(
        F.max_by("work_completed_to_date", F.struct("period_sequence", "pay_app_id")).alias("to_date"))
    ends = full.groupBy(F.col("building_id").alias("__of")).agg(F.max("month").alias("__end"))
    # a contractor's months go on to the building's last one
    last = last.where("month is not null").join(ends, F.col("building_id").eqNullSafe(F.col("__of"))).drop("__of")
    tops = last.groupBy("building_id", "contractor_name").agg(F.max("__end").alias("month")).select(
        "building_id", "contractor_name", "month", F.lit(None).cast("bigint").alias("to_date"))
    grid = last.drop("__end").unionByName(tops).groupBy("building_id", "contractor_name", "month").agg(
        F.max("to_date").alias("to_date"))
    grid = carry_forward(on_spine(grid, ["building_id", "contractor_name"], "month"),
                         ["building_id", "contractor_name"], "month", ["to_date"])
    reported = grid.groupBy(F.col("building_id").alias("__b"), F.col("month").alias("__m")).agg(
        F.sum("to_date").alias("reported_to_date"))
    both = full.join(reported, F.col("building_id").eqNullSafe(F.col("__b")) & (F.col("month") == F.col("__m")),
                     "left").drop("__b", "__m")
    return planned_curve(both.withColumn("period", F.date_format("month", "yyyy-MM")).drop("month"), budget, shape, planned_end,
                         ["billed", "reported_to_date"])


def evm_trend_every_month(fact: DataFrame, period: str = "period", key: str = "building_id") -> DataFrame:
    """The monthly trend with a row for every calendar month between a building's first and last.

    A month without cost rows repeats the totals and ratios of the month before
    (``has_rows`` is false, the change 0), so every change is against the month
    before.  Rows whose period cannot be read are one row of their own.
    """
    monthly = summed_components(fact, [key, period]).withColumn("month", normalize_period(period)).withColumn("has_rows", F.lit(True))
    full = on_spine(monthly.drop(period), [key], "month").withColumn("has_rows", F.coalesce("has_rows", F.lit(False)))
    return evm_trend_on(full.withColumn(period, F.date_format("month", "yyyy-MM")).drop("month"), period, key, ["has_rows"])
