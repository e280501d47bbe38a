"""The test inputs themselves: dirt residues and shapes the oracle relies on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.functions.dates import layout_index
from ledgerlens.sources import bindings as B


def test_change_order_dirt(spark):
    co = B.change_orders(spark, SF_SMALL).withColumn("k", F.regexp_extract("change_order_id", r"(\d+)", 1).cast("long"))
    r = co.agg(
        F.count_if((F.col("k") % B.BLANK_MOD == 0) != F.col("submitted_date").isNull()).alias("blank_mismatch"),
        F.count_if(F.col("status").isin("Pending", "Under Review") & F.col("approved_date").isNotNull()).alias("open_dated"),
        F.count_if((F.col("k") % B.BLANK_MOD != 0) & (F.col("k") % B.JUNK_MOD != 0)
                   & (layout_index("submitted_date") != F.col("k") % 4)).alias("layout_mismatch"),
    ).collect()[0]
    assert (r.blank_mismatch, r.open_dated, r.layout_mismatch) == (0, 0, 0)


def test_cost_ledger_dirt_and_money(spark):
    cost = B.cost_ledger(spark, SF_SMALL)
    r = cost.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("variance").isNull()).alias("blank_variance"),
        F.count_if(F.col("variance").isNotNull()
                   & (F.col("variance") != F.col("approved_budget") - F.col("forecasted_final_cost"))).alias("bad"),
        F.count_if(F.col("period_month").rlike(r"^[A-Z][a-z]{2}-\d{4}$")).alias("alt_periods"),
    ).collect()[0]
    assert r.bad == 0 and 0 < r.blank_variance < r.n / 8 and 0 < r.alt_periods < r.n / 3


def test_pay_applications_are_cumulative(spark):
    pay = B.pay_applications(spark, SF_SMALL)
    r = pay.agg(
        F.count_if(F.col("total_earned") != F.col("work_completed_to_date") + F.col("stored_materials")).alias("earned"),
        F.count_if(F.col("work_completed_to_date") > F.col("scheduled_value")).alias("over"),
    ).collect()[0]
    assert r.earned == 0 and r.over == 0
