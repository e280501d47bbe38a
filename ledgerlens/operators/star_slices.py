"""Star joins that leave most of the star unread or unmoved.

``star_quarter_report`` filters a dimension and lets Spark prune the fact's
partitions by what the filter leaves; ``star_cost_report_bucketed`` joins the
aggregated fact with a dimension that is stored in buckets of the join's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import money_sum
from .evm import ratios_from_totals, summed_components

MONTH = "submitted_month"


def month_key(date: Column | str) -> Column:
    """yyyyMM as an integer: the partition of a change order, found in the date dimension too."""
    return F.year(date) * 100 + F.month(date)


def with_month(fact_co: DataFrame) -> DataFrame:
    """Change orders with the month they were submitted in, to be partitioned by.  No date: month null."""
    return fact_co.withColumn(MONTH, month_key("submitted_date"))


def star_quarter_report(fact_co: DataFrame, dim_date: DataFrame, when: Column) -> DataFrame:
    """Change orders per year, quarter, building and status, of the days that ``when`` picks in the date dimension.

    ``fact_co`` is partitioned by ``submitted_month``.  The filter is on the
    dimension alone, so no literal reaches the fact; its months do, at run time:
    the scan lists only the partitions that the filtered dimension still has
    (dynamic partition pruning).  Orders without a date match no day.
    """
    days = dim_date.where(when).select(month_key("full_date").alias(MONTH), F.col("full_date").alias("submitted_date"),
                                       "year", "quarter")
    rows = fact_co.select(MONTH, "submitted_date", "building_id", "status", "cost_impact")
    return rows.join(days, [MONTH, "submitted_date"]).groupBy("year", "quarter", "building_id", "status").agg(
        F.count(F.lit(1)).alias("co_count"), money_sum("cost_impact").alias("total_cost_impact"))


def star_cost_report_bucketed(fact_cost: DataFrame, dim_building: DataFrame, dim_wbs: DataFrame) -> DataFrame:
    """Earned value per campus, building and WBS level 1 and 2, like ``reports.star_cost_report``.

    ``dim_wbs`` is stored in buckets of (wbs_code, wbs_level_1) and is not
    moved.  The fact is summed per building and code first, map-side, so a code
    that holds a third of all rows meets its bucket as one row per building.
    Each fact row meets the same dimension rows either way, so the sums are the
    same.
    """
    fine = summed_components(fact_cost, ["building_id", "cost_code", "wbs_level_1"])
    codes = dim_wbs.select(F.col("wbs_code").alias("cost_code"), "wbs_level_1", "wbs_level_2")
    j = fine.join(codes, ["cost_code", "wbs_level_1"], "left").join(
        dim_building.select("building_id", "campus"), "building_id", "left")
    totals = ("total_budget", "total_actual_cost", "total_earned_value", "total_planned_value")
    return ratios_from_totals(j.groupBy("campus", "building_id", "wbs_level_1", "wbs_level_2").agg(
        *[F.sum(t).alias(t) for t in totals]))
