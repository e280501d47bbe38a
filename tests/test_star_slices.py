"""Star joins: partitions pruned at run time, and a bucketed dimension that stays where it is."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import reports, star, star_slices
from ledgerlens.operators.sizing import staged
from ledgerlens.plans import catalog as C
from ledgerlens.sources.bucketed import open_bucketed, write_bucketed
from ledgerlens.sources.publication import Publication


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_filtered_dimension_prunes_the_facts_partitions(spark, tmp_path):
    fact = star_slices.with_month(C.co_fact(spark, SF_SMALL))
    out = Publication(spark, str(tmp_path))
    stored = out.write("fact_change_orders", fact, partition_by=[star_slices.MONTH])
    out.commit()
    days = staged(star.calendar_spanning(fact, ["submitted_date"]), "dim-date")
    when = (F.col("year") == 1996) & (F.col("quarter") == 2)
    report = star_slices.star_quarter_report(stored, days, when)
    plan = plan_of(report)
    assert "dynamicpruningexpression(submitted_month" in plan.replace("cast(", "")
    assert stored.select(star_slices.MONTH).distinct().count() > 12
    want = fact.where(F.col("submitted_date").between("1996-04-01", "1996-06-30"))
    assert sum(r["co_count"] for r in report.collect()) == want.count() > 0


def test_orders_without_a_date_match_no_day(spark):
    ddl = "submitted_date date, building_id string, status string, cost_impact double"
    fact = star_slices.with_month(spark.sql(
        "SELECT * FROM VALUES (DATE'2024-01-31', 'B', 'Approved', 1.25D), (CAST(NULL AS DATE), 'B', 'Approved', 8D), "
        "(DATE'2024-01-31', NULL, NULL, NULL) AS t(submitted_date, building_id, status, cost_impact)"))
    days = star.calendar(spark, "2024-01-01", "2024-03-31")
    got = star_slices.star_quarter_report(fact, days, F.col("quarter") == 1).collect()
    assert sorted((r["building_id"] or "", r["co_count"], r["total_cost_impact"]) for r in got) == [("", 1, None), ("B", 1, 1.25)]
    empty = star_slices.with_month(spark.createDataFrame([], ddl))
    assert star_slices.star_quarter_report(empty, days, F.lit(True)).collect() == []


def test_a_bucketed_dimension_is_not_moved(spark, tmp_path):
    fact, buildings = C.cost_fact(spark, SF_SMALL), staged(C.q_dim_building(spark, SF_SMALL), "dim-building")
    wbs = C.q_dim_wbs(spark, SF_SMALL)
    path, keys = str(tmp_path / "wbs"), ["wbs_code", "wbs_level_1"]
    stored = write_bucketed(wbs, "wbs_buckets_test", path, keys, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as above the broadcast limit
    try:
        report = star_slices.star_cost_report_bucketed(fact, buildings, stored)
        plan = plan_of(report)
        plain = star_slices.star_cost_report_bucketed(fact, buildings, staged(wbs, "dim-wbs"))
        to_codes = r"Exchange hashpartitioning\(cost_code#\d+, wbs_level_1#\d+, \d+\)"
        assert len(re.findall(to_codes, plan_of(plain))) == 2  # both sides
        assert "Bucketed: true" in plan and len(re.findall(to_codes, plan)) == 1  # the summed fact alone
        expected = rows(reports.star_cost_report(fact, buildings, staged(wbs, "dim-wbs")))
        assert rows(report) == expected
        again = open_bucketed(spark, "wbs_buckets_again", path, "wbs_code string, wbs_level_1 string, wbs_level_2 string", keys, 8)
        second = star_slices.star_cost_report_bucketed(fact, buildings, again)
        assert "Bucketed: true" in plan_of(second) and rows(second) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("wbs_buckets_test", "wbs_buckets_again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_hot_code_meets_its_bucket_summed(spark, tmp_path):
    fact = spark.range(3000).select(
        F.lit("B").alias("building_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("cost_code"),
        F.lit("L").alias("wbs_level_1"), F.lit(1).cast("bigint").alias("approved_budget"), F.lit(2).cast("bigint").alias("actual_cost_to_date"),
        F.lit(3).cast("bigint").alias("earned_value"), F.lit(4).cast("bigint").alias("planned_value"))
    wbs = fact.select(F.col("cost_code").alias("wbs_code"), "wbs_level_1").distinct().withColumn("wbs_level_2", F.col("wbs_code"))
    stored = write_bucketed(wbs, "wbs_buckets_hot", str(tmp_path / "wbs"), ["wbs_code", "wbs_level_1"], 4)
    buildings = spark.createDataFrame([("B", "C")], "building_id string, campus string")
    try:
        got = star_slices.star_cost_report_bucketed(fact, buildings, stored).where("wbs_level_2 = 'hot'").collect()
    finally:
        spark.sql("DROP TABLE IF EXISTS wbs_buckets_hot")
    assert [(r["campus"], r["total_budget"], r["total_planned_value"], r["cpi"]) for r in got] == [("C", 1000, 4000, 1.5)]
