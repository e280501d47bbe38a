"""Further hand-made checks: trend directions, S-curve shapes, matrix bands, profile, exposure."""

import datetime as dt

import pytest

from ledgerlens.operators import clean, evm, reports

COST = ("building_id string, period string, approved_budget bigint, actual_cost_to_date bigint, "
        "earned_value bigint, planned_value bigint")


def test_trend_directions(spark):
    rows = [("B", "2024-01", 100, 100, 100, 100), ("B", "2024-02", 100, 100, 120, 100),
            ("B", "2024-03", 100, 200, 80, 100), ("B", "2024-04", 100, 0, 0, 100)]
    out = evm.evm_trend_monthly(spark.createDataFrame(rows, COST)).orderBy("period").collect()
    assert [r.cpi_direction for r in out] == ["n/a", "improving", "worsening", "flat"]
    assert out[1].cpi == 1.1 and out[1].cpi_change == 0.1
    assert out[-1].cum_actual_cost == 400


PAY = "building_id string, period string, contractor_name string, trade string, scheduled_value bigint, work_completed_this_period bigint"


@pytest.mark.parametrize("shape", ["linear", "sine"])
def test_scurve_shapes_end_at_budget(spark, shape):
    rows = [("B", f"2024-{m:02d}", "X", "T", 1200, 100) for m in range(1, 13)]
    out = reports.scurve_vs_baseline(spark.createDataFrame(rows, PAY), shape).orderBy("period").collect()
    assert out[-1].baseline_cumulative == 1200.0 and out[-1].actual_cumulative == 1200
    if shape == "sine":
        assert out[0].baseline_cumulative < 100 and out[5].baseline_cumulative == 600.0
    else:
        assert [r.position for r in out] == ["on plan"] * 12


def test_scurve_rejects_unknown_shape(spark):
    with pytest.raises(ValueError):
        reports.scurve_vs_baseline(spark.createDataFrame([("B", "2024-01", "X", "T", 1, 1)], PAY), "cubic")


def test_variance_matrix_bands_and_missing_cells(spark):
    rows = [("W1", "BLD-A", -50, 1000), ("W1", "BLD-B", 0, 1000), ("W2", "BLD-A", -5, 1000), ("W3", "BLD-B", 5, 100)]
    df = spark.createDataFrame(rows, "wbs_level_1 string, building_id string, variance bigint, approved_budget bigint")
    out = {r.wbs_level_1: r for r in reports.variance_matrix(df, ["BLD-A", "BLD-B"]).collect()}
    assert (out["W1"].variance_bld_a, out["W1"].variance_pct_bld_a, out["W1"].band) == (-50, -5.0, "overrun")
    assert (out["W2"].total_variance_pct, out["W2"].band) == (-0.5, "watch")
    assert out["W3"].variance_bld_a is None and out["W3"].band == "ok"


def test_null_profile_metrics(spark):
    rows = [("2024-01-05", "Acme", "Acme Steel"), ("n/a", None, None), (None, "Zed", "Zed"), ("  ", "Q", "Q")]
    df = spark.createDataFrame(rows, "d string, v string, v_clean string")
    out = {(r.column_name, r.metric): r.value for r in
           clean.null_profile(df, "s", date_columns=["d"], vendor_columns={"v": "v_clean"}, canonical=["Acme Steel"]).collect()}
    assert out[("d", "nulls")] == 1 and out[("d", "unparseable")] == 1
    assert out[("v", "unmatched")] == 2 and ("v_clean", "nulls") not in out


def test_open_exposure_ages(spark):
    rows = [("B", "Pending", dt.date(2024, 1, 1), 10.0), ("B", "Under Review", dt.date(2023, 12, 1), 5.0),
            ("B", "Approved", dt.date(2023, 1, 1), 99.0), ("B", "Pending", None, 1.0)]
    df = spark.createDataFrame(rows, "building_id string, status string, submitted_date date, cost_impact double")
    r = reports.co_open_exposure(df, "2024-01-10").collect()[0]
    assert (r.open_count, r.open_cost_impact, r.age_0_15_days, r.age_30_plus_days, r.age_unknown) == (3, 16.0, 1, 1, 1)
    assert r.max_days_outstanding == 40


def test_variance_matrix_rejects_colliding_names(spark):
    df = spark.createDataFrame([("W", "BLD-1", 1, 1)], "wbs_level_1 string, building_id string, variance bigint, approved_budget bigint")
    with pytest.raises(ValueError):
        reports.variance_matrix(df, ["BLD-1", "BLD_1"])
