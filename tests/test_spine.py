"""Every calendar month has a row."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import reports, spine
from ledgerlens.plans import catalog as C

D = dt.date
PAY = ("pay_app_id string, building_id string, period string, period_sequence int, contractor_name string, trade string, "
       "scheduled_value long, work_completed_this_period long, work_completed_to_date long")


def months(spark, rows):
    return spark.createDataFrame(rows, "b string, month date, v long")


def test_spine_goes_from_first_to_last_month(spark):
    df = months(spark, [("x", D(2020, 11, 1), 1), ("x", D(2021, 2, 1), 4), (None, D(2021, 1, 1), 7), ("y", None, 9)])
    got = sorted(map(tuple, spine.month_spine(df, ["b"], "month").collect()), key=repr)
    assert got == [("x", D(2020, 11, 1)), ("x", D(2020, 12, 1)), ("x", D(2021, 1, 1)), ("x", D(2021, 2, 1)), (None, D(2021, 1, 1))]
    end = spine.month_spine(df, ["b"], "month", F.lit("2021-04-20").cast("date"))
    assert end.where("b = 'x'").count() == 6 and end.where("b is null").count() == 4
    assert spine.month_spine(df.where("false"), ["b"], "month").collect() == []


def test_last_known_value_is_carried(spark):
    df = months(spark, [("x", D(2020, 11, 1), 1), ("x", D(2021, 1, 1), None), ("x", D(2021, 2, 1), 4), ("y", None, 9), ("y", None, None)])
    full = spine.carry_forward(spine.on_spine(df, ["b"], "month"), ["b"], "month", ["v"])
    got = [tuple(r) for r in full.where("b = 'x'").orderBy("month").collect()]
    assert [r[2] for r in got] == [1, 1, 1, 4]
    assert full.where("b = 'y'").count() == 2  # rows without a month stay as they are


def test_months_without_bills_have_rows(spark):
    rows = [("1", "A", "2020-01", 1, "p", "t", 100, 10, 10), ("2", "A", "2020-04", 4, "p", "t", 100, 30, 40),
            ("3", "A", "February 2020", 2, "q", "u", 200, 5, 5), ("4", "A", "n/a", 9, "q", "u", 200, 2, 7)]
    out = spine.scurve_every_month(spark.createDataFrame(rows, PAY), "linear", "2020-06")
    got = {r["period"]: r for r in out.collect()}
    assert sorted(k for k in got if k) == [f"2020-0{m}" for m in range(1, 7)] and None in got
    assert [got[f"2020-0{m}"]["monthly_spend"] for m in range(1, 7)] == [10, 5, 0, 30, 0, 0]
    assert [got[f"2020-0{m}"]["billed"] for m in range(1, 7)] == [True, True, False, True, False, False]
    assert [got[f"2020-0{m}"]["actual_cumulative"] for m in range(1, 7)] == [10, 15, 15, 45, 45, 45]
    assert [got[f"2020-0{m}"]["reported_to_date"] for m in range(1, 7)] == [10, 15, 15, 45, 45, 45]
    assert [got[f"2020-0{m}"]["baseline_cumulative"] for m in range(1, 7)] == [50, 100, 150, 200, 250, 300]
    assert got[None]["monthly_spend"] == 2 and got[None]["position"] == "unassigned" and got[None]["baseline_cumulative"] is None


def test_a_contractor_without_a_bill_keeps_its_amount(spark):
    rows = [("1", "A", "2020-01", 1, "p", "t", 100, 10, 10), ("2", "A", "2020-03", 3, "q", "u", 100, 30, 30)]
    out = {r["period"]: r["reported_to_date"] for r in spine.scurve_every_month(spark.createDataFrame(rows, PAY)).collect()}
    assert out == {"2020-01": 10, "2020-02": 10, "2020-03": 40}


def test_billed_months_are_those_of_the_plain_curve(spark):
    pay = C.pay_fact(spark, SF_SMALL)
    plain = reports.scurve_vs_baseline(pay, "sine", C.PLANNED_END)
    full = spine.scurve_every_month(pay, "sine", C.PLANNED_END)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, full.where("billed").select(*plain.columns).collect()))
    gaps = full.where("not billed").count()
    assert gaps == full.count() - plain.count() and gaps > 0


def test_every_change_has_a_month_before(spark):
    full = C.q_evm_trend_every_month(spark, SF_SMALL)
    plain = C.q_evm_trend_monthly(spark, SF_SMALL)
    assert full.where("has_rows").count() == plain.count() and full.where("not has_rows").count() > 0
    calm = full.where("not has_rows").select("cpi_change", "cpi_direction").distinct().collect()
    assert {tuple(r) for r in calm} <= {(0.0, "flat"), (None, "n/a")}
    first = full.where("period is not null").groupBy("building_id").agg(F.min("period").alias("p")).collect()
    unknown = full.where("period is not null and cpi_direction = 'n/a' and cpi is not null").select("building_id", "period").collect()
    assert {tuple(r) for r in unknown} <= {tuple(r) for r in first}
