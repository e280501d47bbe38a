"""Report semantics on hand-made rows: latest position, retainage audit, top-k ties,
waterfall / S-curve invariants, drill-through ranks."""


from ledgerlens.operators import reports, star

PAY = ("pay_app_id string, building_id string, period string, period_sequence int, contractor_name string, "
       "trade string, scheduled_value bigint, work_completed_this_period bigint, work_completed_to_date bigint, "
       "stored_materials bigint, total_earned bigint, retainage_pct double, retainage_held bigint, "
       "net_payment_due bigint, pay_app_status string")


def _pay(spark):
    rows = [
        ("PA-1", "B", "2024-01", 1, "Acme", "Steel", 1000, 100, 100, 5, 105, 10.0, 11, 94, "Certified"),
        ("PA-2", "B", "February 2024", 2, "Acme", "Steel", 1000, 200, 300, 10, 310, 10.0, 31, 279, "Certified"),
        ("PA-3", "B", "2024-02", 2, "Acme", "Steel", 1000, 200, 300, 10, 310, 10.0, 40, 270, "Submitted"),  # revision, broken
        ("PA-4", "B", "2024-01", 1, "Zen", "Glass", 500, 50, 50, 0, 50, 5.0, 3, 47, "Certified"),
        ("PA-5", "B", "2024-01", 1, "Zen", "Glazing", 500, 50, 50, 0, 50, 5.0, 3, 47, "Certified"),
    ]
    return spark.createDataFrame(rows, PAY)


def test_current_position_breaks_sequence_tie_by_id(spark):
    got = {r.contractor_name: r for r in reports.pay_app_current_position(_pay(spark)).collect()}
    assert got["Acme"].pay_app_id == "PA-3" and got["Acme"].pay_app_count == 3
    assert got["Acme"].percent_billed == 30.0


def test_retainage_audit_counts_breaks(spark):
    got = {r.contractor_name: r for r in reports.retainage_audit(_pay(spark)).collect()}
    a = got["Acme"]
    assert (a.earned_breaks, a.retainage_breaks, a.net_payment_breaks, a.retainage_diff_amount) == (0, 1, 0, 9)
    assert got["Zen"].retainage_breaks == 0


def test_cash_flow_as_written_splits_period_normalised_does_not(spark):
    as_written = reports.cash_flow_forecast(_pay(spark)).where("period_sequence = 2").count()
    normalised = reports.cash_flow_by_period(_pay(spark)).collect()
    assert as_written == 2
    assert sorted(r.period for r in normalised) == ["2024-01", "2024-02"]
    last = max(normalised, key=lambda r: r.period)
    assert last.running_monthly_spend == sum(r.monthly_spend for r in normalised)


def test_scurve_last_point_is_total_spend(spark):
    out = reports.scurve_vs_baseline(_pay(spark)).orderBy("period").collect()
    assert out[-1].actual_cumulative == 100 + 200 + 200 + 50 + 50
    assert out[-1].baseline_cumulative == 1000 + 500 + 500  # Zen counted per (name, trade)


def test_dim_vendor_two_trades_numbered_densely(spark):
    cost = spark.createDataFrame([("Acme",), ("Bolt",), (None,)], "vendor_name string")
    dv = star.dim_vendor(cost, _pay(spark)).orderBy("vendor_id").collect()
    assert [(r.vendor_id, r.vendor_name, r.trade) for r in dv] == [
        (1, "Acme", "Steel"), (2, "Bolt", None), (3, "Zen", "Glass"), (4, "Zen", "Glazing")]


COST = "wbs_level_1 string, building_id string, cost_code string, approved_budget bigint, actual_cost_to_date bigint, forecasted_final_cost bigint, variance bigint, earned_value bigint"


def test_top10_tie_at_rank_10_and_null_sum_last(spark):
    rows = [(f"W{i:02d}", "B", "c", 100, 10, 0, -5 if i >= 9 else -100 + i, 10) for i in range(12)]
    rows.append(("WNULL", "B", "c", 100, 10, 0, None, 10))
    out = reports.cost_variance_by_wbs(spark.createDataFrame(rows, COST), k=10).collect()
    assert len(out) == 10
    assert [r.wbs_level_1 for r in out][-2:] == ["W08", "W09"]  # tie on -5 broken by wbs: W10, W11 cut
    assert "WNULL" not in [r.wbs_level_1 for r in out]


def test_drill_through_rank_and_share(spark):
    rows = [("W", "B", "c1", 100, 0, 0, -30, 0), ("W", "B", "c2", 100, 0, 0, -10, 0), ("W", "B", "c3", 100, 0, 0, 50, 0)]
    out = {r.cost_code: r for r in reports.variance_drill_through(spark.createDataFrame(rows, COST)).collect()}
    assert (out["c1"].rank_in_cell, out["c1"].share_of_overrun) == (1, 0.75)
    assert (out["c3"].rank_in_cell, out["c3"].share_of_overrun) == (3, 0.0)


def test_waterfall_end_is_total_impact(spark):
    rows = [("B", "Approved", 10.0), ("B", "Pending", 5.0), ("B", "Under Review", 1.0), ("B", "Rejected", -2.0)]
    wf = reports.co_waterfall(spark.createDataFrame(rows, "building_id string, status string, cost_impact double"))
    steps = wf.orderBy("step_order").collect()
    assert [s.step for s in steps] == ["Approved", "Pending", "Rejected"]
    assert steps[-1].bar_end == 14.0 and steps[1].bar_start == 10.0
