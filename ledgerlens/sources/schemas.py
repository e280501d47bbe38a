"""Explicit schemas for the four raw exports and the eight star tables.

Declaring the raw schema removes the inference scan per file and stops
type drift (money read as int on one run and bigint on the next).  Raw date
and period columns stay text; cleaning happens in ``functions.dates``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in cols])


S, I, L, D, DT = StringType(), IntegerType(), LongType(), DoubleType(), DateType()

COST_MONEY = (
    "contract_value",
    "approved_budget",
    "committed_cost",
    "actual_cost_to_date",
    "forecasted_final_cost",
    "variance",
    "earned_value",
    "planned_value",
)

RAW_COST_LEDGER = _schema(
    ("cost_key", L), ("cost_code", S), ("wbs_level_1", S), ("wbs_level_2", S),
    ("vendor_name", S),
    *[(c, L) for c in COST_MONEY],
    ("percent_complete_actual", D), ("percent_complete_baseline", D),
    ("period_month", S), ("building_id", S),
)

RAW_CHANGE_ORDERS = _schema(
    ("change_order_id", S), ("co_type", S), ("description", S),
    ("submitted_date", S), ("approved_date", S), ("status", S),
    ("cost_impact", D), ("schedule_impact_days", I), ("responsible_party", S),
    ("building_id", S), ("wbs_code", S), ("wbs_level_1", S),
)

RAW_SCHEDULE = _schema(
    ("activity_id", S), ("activity_name", S), ("building_id", S),
    ("wbs_level_1", S), ("wbs_code", S),
    ("planned_start", S), ("planned_finish", S), ("actual_start", S), ("actual_finish", S),
    ("baseline_duration", I), ("actual_duration", I), ("percent_complete", D),
    ("total_float_days", I), ("critical_path_flag", S),
)

PAY_MONEY = (
    "scheduled_value",
    "work_completed_this_period",
    "work_completed_to_date",
    "stored_materials",
    "total_earned",
)

RAW_PAY_APPLICATIONS = _schema(
    ("pay_app_id", S), ("period", S), ("period_sequence", I),
    ("building_id", S), ("contractor_name", S), ("trade", S),
    *[(c, L) for c in PAY_MONEY],
    ("retainage_pct", D), ("retainage_held", L), ("net_payment_due", L),
    ("pay_app_status", S),
)

RAW_SOURCES = {
    "cost_ledger": RAW_COST_LEDGER,
    "change_orders": RAW_CHANGE_ORDERS,
    "schedule": RAW_SCHEDULE,
    "pay_applications": RAW_PAY_APPLICATIONS,
}

FACT_PROJECT_COST = _schema(
    ("cost_key", L), ("building_id", S), ("cost_code", S),
    ("wbs_level_1", S), ("wbs_level_2", S), ("vendor_name", S),
    *[(c, L) for c in COST_MONEY],
    ("percent_complete_actual", D), ("percent_complete_baseline", D),
    ("cpi", D), ("spi", D), ("eac", D), ("vac", D), ("cost_variance_pct", D),
)

FACT_CHANGE_ORDERS = _schema(
    ("change_order_id", S), ("building_id", S), ("co_type", S), ("description", S),
    ("submitted_date", DT), ("approved_date", DT), ("status", S),
    ("cost_impact", D), ("schedule_impact_days", I), ("co_approval_lag_days", I),
    ("responsible_party", S), ("wbs_code", S), ("wbs_level_1", S),
)

FACT_SCHEDULE = _schema(
    ("activity_id", S), ("building_id", S), ("activity_name", S),
    ("wbs_level_1", S), ("wbs_code", S),
    ("planned_start", DT), ("planned_finish", DT), ("actual_start", DT), ("actual_finish", DT),
    ("baseline_duration", I), ("actual_duration", I), ("percent_complete", D),
    ("total_float_days", I), ("critical_path_flag", S),
)

FACT_PAY_APPLICATIONS = _schema(
    ("pay_app_id", S), ("building_id", S), ("period", S), ("period_sequence", I),
    ("contractor_name", S), ("trade", S),
    *[(c, L) for c in PAY_MONEY],
    ("retainage_pct", D), ("retainage_held", L), ("net_payment_due", L),
    ("pay_app_status", S),
)

DIM_BUILDING = _schema(
    ("building_id", S), ("campus", S), ("client", S),
    ("program_value_usd", L), ("snapshot_date", DT),
)

DIM_WBS = _schema(("wbs_code", S), ("wbs_level_1", S), ("wbs_level_2", S))

DIM_VENDOR = _schema(("vendor_id", L), ("vendor_name", S), ("trade", S))

DIM_DATE = _schema(
    ("full_date", DT), ("date_key", I), ("year", I), ("quarter", I), ("month", I),
    ("month_name", S), ("week_of_year", I), ("day_of_week", I), ("day_name", S),
    ("is_weekend", I), ("is_month_end", I), ("fiscal_year", I), ("fiscal_quarter", I),
)

STAR_TABLES = {
    "fact_project_cost": FACT_PROJECT_COST,
    "fact_change_orders": FACT_CHANGE_ORDERS,
    "fact_schedule": FACT_SCHEDULE,
    "fact_pay_applications": FACT_PAY_APPLICATIONS,
    "dim_building": DIM_BUILDING,
    "dim_wbs": DIM_WBS,
    "dim_vendor": DIM_VENDOR,
    "dim_date": DIM_DATE,
}
