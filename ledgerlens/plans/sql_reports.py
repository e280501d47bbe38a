"""The five coded reports as Spark SQL text over the star-table views.

For users who keep their reports as SQL: register the star tables
(``sources.files.read_star(..., register_views=True)``) and run
``spark.sql(REPORT_SQL[name])``.  Each statement returns exactly what the
DataFrame-API operator of the same name returns (tested).  Ratios use
``try_divide`` so a zero denominator gives null under ANSI mode, and sums
stay exact integers until the final division.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORT_SQL: dict[str, str] = {
    "evm_summary_by_building": """
        WITH t AS (
          SELECT building_id,
                 sum(approved_budget)     AS total_budget,
                 sum(actual_cost_to_date) AS total_actual_cost,
                 sum(earned_value)        AS total_earned_value,
                 sum(planned_value)       AS total_planned_value
          FROM fact_project_cost GROUP BY building_id)
        SELECT building_id,
               round(try_divide(CAST(total_earned_value AS DOUBLE), CAST(total_actual_cost AS DOUBLE)), 3) AS cpi,
               round(try_divide(CAST(total_earned_value AS DOUBLE), CAST(total_planned_value AS DOUBLE)), 3) AS spi,
               round(try_divide(CAST(total_budget AS DOUBLE),
                     try_divide(CAST(total_earned_value AS DOUBLE), CAST(total_actual_cost AS DOUBLE))), 0) AS eac,
               round(total_budget - try_divide(CAST(total_budget AS DOUBLE),
                     try_divide(CAST(total_earned_value AS DOUBLE), CAST(total_actual_cost AS DOUBLE))), 0) AS vac,
               total_budget, total_actual_cost, total_earned_value
        FROM t ORDER BY building_id NULLS LAST""",
    "change_order_aging": """
        SELECT building_id, status,
               count(*)                                          AS co_count,
               CAST(sum(CAST(round(cost_impact * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS total_cost_impact,
               avg(co_approval_lag_days)                         AS avg_approval_lag,
               count_if(co_approval_lag_days BETWEEN 0 AND 15)   AS bucket_0_15_days,
               count_if(co_approval_lag_days BETWEEN 16 AND 30)  AS bucket_16_30_days,
               count_if(co_approval_lag_days > 30)               AS bucket_30_plus_days
        FROM fact_change_orders
        GROUP BY building_id, status
        ORDER BY building_id NULLS LAST, status NULLS LAST""",
    "cash_flow_forecast": """
        SELECT building_id, period, period_sequence,
               sum(work_completed_this_period) AS monthly_spend,
               sum(work_completed_to_date)     AS cumulative_spend,
               sum(scheduled_value)            AS scheduled_value,
               sum(retainage_held)             AS retainage_held,
               sum(net_payment_due)            AS net_payment_due
        FROM fact_pay_applications
        GROUP BY building_id, period, period_sequence
        ORDER BY building_id NULLS LAST, period_sequence NULLS LAST, period NULLS LAST""",
    "pay_app_reconciliation": """
        SELECT building_id, contractor_name,
               count(*)                    AS pay_app_count,
               sum(scheduled_value)        AS contract_value,
               sum(work_completed_to_date) AS total_billed,
               sum(total_earned)           AS total_certified,
               sum(retainage_held)         AS total_retainage,
               sum(net_payment_due)        AS total_net_payment,
               round(try_divide(CAST(sum(retainage_held) AS DOUBLE), CAST(sum(total_earned) AS DOUBLE)) * 100.0D, 2)
                                           AS retainage_pct
        FROM fact_pay_applications
        GROUP BY building_id, contractor_name
        ORDER BY building_id NULLS LAST, total_billed DESC NULLS LAST, contractor_name NULLS LAST""",
    "cost_variance_by_wbs": """
        SELECT wbs_level_1, building_id,
               sum(approved_budget)       AS approved_budget,
               sum(actual_cost_to_date)   AS actual_cost,
               sum(forecasted_final_cost) AS forecasted_final_cost,
               sum(variance)              AS variance,
               round(try_divide(CAST(sum(variance) AS DOUBLE), CAST(sum(approved_budget) AS DOUBLE)) * 100.0D, 2)
                                          AS variance_pct,
               sum(earned_value)          AS earned_value,
               round(try_divide(CAST(sum(earned_value) AS DOUBLE), CAST(sum(actual_cost_to_date) AS DOUBLE)), 3) AS cpi
        FROM fact_project_cost
        GROUP BY wbs_level_1, building_id
        ORDER BY variance ASC NULLS LAST, wbs_level_1, building_id
        LIMIT 10""",
}


def run_report(spark: SparkSession, name: str) -> DataFrame:
    """Run one report over the registered star views."""
    return spark.sql(REPORT_SQL[name])
