"""Empty inputs and null keys through the operators that materialise or number data."""

from ledgerlens.operators import evm, reports, star
from ledgerlens.operators.keys import dense_surrogate_key
from ledgerlens.operators.vendors import vendor_fuzzy_match


def test_dense_key_empty_and_nulls_first(spark):
    empty = spark.createDataFrame([], "k string")
    assert dense_surrogate_key(empty, ["k"]).count() == 0
    df = spark.createDataFrame([("b",), (None,), ("a",), (None,)], "k string")
    out = dense_surrogate_key(df, ["k"], key="sk", num_partitions=3).orderBy("sk").collect()
    assert [r.sk for r in out] == [1, 2, 3, 4]
    assert [r.k for r in out] == [None, None, "a", "b"]


def test_fuzzy_match_without_any_name(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v string")
    assert [r.v for r in vendor_fuzzy_match(df, "v").collect()] == [None, None]
    assert vendor_fuzzy_match(spark.createDataFrame([], "id int, v string"), "v").count() == 0


def test_calendar_of_no_dates(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert star.calendar_spanning(df, ["d"]).count() == 0


def test_reports_on_empty_facts(spark):
    cost = spark.createDataFrame([], "building_id string, wbs_level_1 string, wbs_level_2 string, cost_code string, "
                                     "approved_budget bigint, actual_cost_to_date bigint, earned_value bigint, "
                                     "planned_value bigint, forecasted_final_cost bigint, variance bigint")
    assert evm.evm_summary_by_building(cost).count() == 0
    # Spark's CUBE is Expand + Aggregate, so an empty input yields no rows at all
    # (standard SQL would return one grand-total row for the empty grouping set).
    assert evm.evm_cube(cost).count() == 0
    assert reports.cost_variance_by_wbs(cost).count() == 0
    assert reports.variance_drill_through(cost, top_k=3).count() == 0


def test_staged_side_is_sized_in_bytes(spark):
    from pyspark.sql import functions as F

    from ledgerlens.operators.sizing import staged

    big = spark.range(0, 5000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    side = staged(spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")))
    plan = lambda: big.join(side, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # one byte: the side does not fit
    try:
        assert "BroadcastHashJoin" not in plan()
        assert big.join(side, "k").agg(F.sum("w")).first()[0] == sum((i % 50) * 10 for i in range(5000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _cost(spark, rows):
    return spark.createDataFrame(rows, "building_id string, wbs_level_1 string, cost_code string, variance bigint, "
                                       "approved_budget bigint")


def test_matrix_total_counts_every_building(spark):
    from ledgerlens.operators import reports

    r = reports.variance_matrix(_cost(spark, [("A", "1", "c", -10, 100), ("Z", "1", "c", -1000, 100),
                                              (None, "1", "c", -5, 100)]), ["A"]).first()
    assert (r.variance_a, r.variance_other, r.total_variance) == (-10, -1005, -1015)


def test_waterfall_ends_at_the_whole_impact(spark):
    from ledgerlens.operators import reports

    co = spark.createDataFrame([("A", "Approved", 10.1), ("A", "Void", 5.2), ("A", None, 2.3), ("A", "Pending", -1.0)],
                               "building_id string, status string, cost_impact double")
    bars = {r.step: r for r in reports.co_waterfall(co).collect()}
    assert bars["Other"].co_count == 2 and bars["Other"].amount == 7.5
    assert max(bars.values(), key=lambda r: r.step_order).bar_end == 16.6


def test_trend_skips_no_month(spark):
    from ledgerlens.operators import evm

    rows = [("A", "2024-01", 100, 10, 9, 10), ("A", "2024-03", 100, 10, 5, 10), ("A", "2024-04", 100, 10, 20, 10),
            ("A", None, 100, 99, 1, 10)]
    fact = spark.createDataFrame(rows, "building_id string, period string, approved_budget bigint, "
                                       "actual_cost_to_date bigint, earned_value bigint, planned_value bigint")
    out = {r.period: r for r in evm.evm_trend_monthly(fact).collect()}
    assert out["2024-03"].cpi_change is None and out["2024-03"].cpi_direction == "n/a"
    assert out["2024-04"].cpi_direction == "improving" and out["2024-04"].cum_actual_cost == 30
    assert out[None].cum_actual_cost == 99


def test_names_of_other_scripts_match_only_themselves(spark):
    from ledgerlens.operators.vendors import canonical_table, candidates, fuzzy_name_map

    canon = ["上海建筑", "Lake Shore Plumbing", "...", "Redline Fire Protection"]
    names = spark.createDataFrame([("東京建設",), ("上海建筑",), ("Läke Shore Plümbing",), ("--",), ("Redline Fire Protectoin",)],
                                  "raw_name string")
    table = canonical_table(spark, canon)
    assert {r.raw_name: r.matched for r in fuzzy_name_map(names, table).collect()} == {
        "上海建筑": "上海建筑", "Läke Shore Plümbing": "Lake Shore Plumbing", "Redline Fire Protectoin": "Redline Fire Protection"}
    many = [f"Company {a}{b} Services" for a in "abcdefghij" for b in "klmnopqrst"]
    pairs = candidates(spark.createDataFrame([("Zebra Glass",), ("Company ak Services",)], "raw_name string"),
                       canonical_table(spark, many), 85.0)
    assert pairs.where("raw_name = 'Zebra Glass'").count() == 0 < pairs.count() <= len(many)
