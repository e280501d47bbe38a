"""The SQL text of the coded reports equals the DataFrame operators, row for row and in order."""

import pytest

from conftest import SF_SMALL
from ledgerlens.operators import evm, reports
from ledgerlens.plans import catalog as C
from ledgerlens.plans.sql_reports import REPORT_SQL, run_report

DF_OPS = {
    "evm_summary_by_building": lambda f: evm.evm_summary_by_building(f["fact_project_cost"]),
    "change_order_aging": lambda f: reports.change_order_aging(f["fact_change_orders"]),
    "cash_flow_forecast": lambda f: reports.cash_flow_forecast(f["fact_pay_applications"]),
    "pay_app_reconciliation": lambda f: reports.pay_app_reconciliation(f["fact_pay_applications"]),
    "cost_variance_by_wbs": lambda f: reports.cost_variance_by_wbs(f["fact_project_cost"]),
}


@pytest.fixture(scope="module")
def facts(spark):
    f = {
        "fact_project_cost": C.cost_fact(spark, SF_SMALL),
        "fact_change_orders": C.co_fact(spark, SF_SMALL),
        "fact_pay_applications": C.pay_fact(spark, SF_SMALL),
    }
    for name, df in f.items():
        df.createOrReplaceTempView(name)
    return f


@pytest.mark.parametrize("name", sorted(REPORT_SQL))
def test_sql_text_equals_operator(spark, facts, name):
    got = run_report(spark, name)
    want = DF_OPS[name](facts)
    assert got.columns == want.columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
