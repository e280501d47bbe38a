"""Reports over the star schema.

All reports aggregate first (partial + final hash aggregate, so hot keys
are combined map-side) and only then apply windows, which therefore see a
small (key x period) grain instead of raw rows.  The reports that the
source ships as SQL keep its ORDER BY (on a result of a few hundred rows at
most, so the sort is cheap); the others leave ordering to the consumer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import money_sum, pct, ratio
from ..functions.dates import period_label
from .evm import summed_components, ratios_from_totals

# ---------------------------------------------------------------- change orders

OPEN_STATUSES = ("Pending", "Under Review")


def change_order_aging(fact_co: DataFrame) -> DataFrame:
    """Per (building, status): count, cost impact, mean approval lag and lag buckets.

    Buckets count decided orders by approval lag 0-15, 16-30, >30 days; a
    null or negative lag falls in no bucket.  Bucket counts are 0, not null.
    """
    lag = F.col("co_approval_lag_days")
    out = fact_co.groupBy("building_id", "status").agg(
        F.count(F.lit(1)).alias("co_count"),
        money_sum("cost_impact").alias("total_cost_impact"),
        F.avg(lag).alias("avg_approval_lag"),
        F.count_if(lag.between(0, 15)).alias("bucket_0_15_days"),
        F.count_if(lag.between(16, 30)).alias("bucket_16_30_days"),
        F.count_if(lag > 30).alias("bucket_30_plus_days"),
    )
    return out.orderBy(F.asc_nulls_last("building_id"), F.asc_nulls_last("status"))


def co_open_exposure(fact_co: DataFrame, snapshot_date: str) -> DataFrame:
    """Open (Pending / Under Review) orders per building: exposure and age buckets.

    Age is counted as of ``snapshot_date`` from submission (days outstanding).
    """
    age = F.datediff(F.lit(snapshot_date).cast("date"), F.col("submitted_date"))
    open_ = fact_co.where(F.col("status").isin(*OPEN_STATUSES)).select("building_id", "cost_impact", age.alias("age"))
    a = F.col("age")
    return open_.groupBy("building_id").agg(
        F.count(F.lit(1)).alias("open_count"),
        money_sum("cost_impact").alias("open_cost_impact"),
        F.avg(a).alias("avg_days_outstanding"),
        F.max(a).alias("max_days_outstanding"),
        F.count_if(a.between(0, 15)).alias("age_0_15_days"),
        F.count_if(a.between(16, 30)).alias("age_16_30_days"),
        F.count_if(a > 30).alias("age_30_plus_days"),
        F.count_if(a.isNull()).alias("age_unknown"),
    )


# Waterfall steps in display order; every other status, and none, is "Other".
WATERFALL_STEPS = (("Approved", 1, ("Approved",)), ("Pending", 2, OPEN_STATUSES), ("Rejected", 3, ("Rejected",)))
OTHER_STEP = ("Other", 4)


def co_waterfall(fact_co: DataFrame) -> DataFrame:
    """Per building: approved -> pending -> rejected -> other cost impact as start/end bars.

    The last bar ends at the building's whole cost impact, whatever the statuses.
    """
    step_name, step_order = F.lit(OTHER_STEP[0]), F.lit(OTHER_STEP[1])
    for name, order, statuses in reversed(WATERFALL_STEPS):
        hit = F.col("status").isin(*statuses)
        step_name = F.when(hit, F.lit(name)).otherwise(step_name)
        step_order = F.when(hit, F.lit(order)).otherwise(step_order)
    steps = (
        fact_co.select("building_id", step_name.alias("step"), step_order.alias("step_order"), "cost_impact")
        .groupBy("building_id", "step", "step_order")
        .agg(F.sum(F.round(F.col("cost_impact") * F.lit(100.0)).cast("bigint")).alias("cents"),
             F.count(F.lit(1)).alias("co_count"))
    )
    run = Window.partitionBy("building_id").orderBy("step_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cents = F.coalesce(F.col("cents"), F.lit(0))
    end = F.sum(cents).over(run)
    dollars = lambda c: c.cast("double") / F.lit(100.0)
    return steps.select("building_id", "step", "step_order", "co_count", dollars(cents).alias("amount"),
                        dollars(end - cents).alias("bar_start"), dollars(end).alias("bar_end"))


# ---------------------------------------------------------------- pay applications


def cash_flow_forecast(fact_pay: DataFrame) -> DataFrame:
    """Per (building, period text, sequence): spend and payment sums (as loaded)."""
    out = fact_pay.groupBy("building_id", "period", "period_sequence").agg(
        F.sum("work_completed_this_period").alias("monthly_spend"),
        F.sum("work_completed_to_date").alias("cumulative_spend"),
        F.sum("scheduled_value").alias("scheduled_value"),
        F.sum("retainage_held").alias("retainage_held"),
        F.sum("net_payment_due").alias("net_payment_due"),
    )
    return out.orderBy(F.asc_nulls_last("building_id"), F.asc_nulls_last("period_sequence"), F.asc_nulls_last("period"))


def cash_flow_by_period(fact_pay: DataFrame) -> DataFrame:
    """Same sums with the period normalised first: one row per (building, month),
    plus a running total of monthly spend to cross-check the cumulative column."""
    norm = fact_pay.withColumn("period", period_label("period"))
    monthly = norm.groupBy("building_id", "period").agg(
        F.sum("work_completed_this_period").alias("monthly_spend"),
        F.sum("work_completed_to_date").alias("cumulative_spend"),
        F.sum("scheduled_value").alias("scheduled_value"),
        F.sum("retainage_held").alias("retainage_held"),
        F.sum("net_payment_due").alias("net_payment_due"),
    )
    # rows whose period cannot be read are a row of their own, outside the running total
    known = F.col("period").isNotNull()
    run = Window.partitionBy("building_id").orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.withColumn("running_monthly_spend", F.when(known, F.sum(F.when(known, F.col("monthly_spend"))).over(run)))


def pay_app_reconciliation(fact_pay: DataFrame) -> DataFrame:
    """Per (building, contractor): count, billing sums, effective retainage %."""
    g = fact_pay.groupBy("building_id", "contractor_name").agg(
        F.count(F.lit(1)).alias("pay_app_count"),
        F.sum("scheduled_value").alias("contract_value"),
        F.sum("work_completed_to_date").alias("total_billed"),
        F.sum("total_earned").alias("total_certified"),
        F.sum("retainage_held").alias("total_retainage"),
        F.sum("net_payment_due").alias("total_net_payment"),
    )
    return g.withColumn("retainage_pct", pct("total_retainage", "total_certified", 2)).orderBy(
        F.asc_nulls_last("building_id"), F.desc_nulls_last("total_billed"), F.asc_nulls_last("contractor_name")
    )


def pay_app_current_position(fact_pay: DataFrame) -> DataFrame:
    """Latest application per (building, contractor) by (period_sequence, pay_app_id).

    ``max_by`` over a struct is a plain aggregate (partial + final), so no
    sort or window over the full table; a revised application with the same
    sequence is resolved by the id tie-breaker.
    """
    cols = [c for c in fact_pay.columns if c not in ("building_id", "contractor_name")]
    latest = fact_pay.groupBy("building_id", "contractor_name").agg(
        F.max_by(F.struct(*cols), F.struct("period_sequence", "pay_app_id")).alias("r"),
        F.count(F.lit(1)).alias("pay_app_count"),
    )
    return latest.select("building_id", "contractor_name", "pay_app_count", "r.*").withColumn(
        "percent_billed", pct("work_completed_to_date", "scheduled_value", 2)
    )


def retainage_audit(fact_pay: DataFrame) -> DataFrame:
    """Row checks on each application, counted per (building, contractor).

    earned = to_date + stored; held = round(earned * pct / 100); net = earned - held.
    A row with an amount missing is counted in ``missing_amounts``; it breaks
    only those checks whose amounts it has.
    """
    expected_held = F.round(F.col("total_earned") * F.col("retainage_pct") / F.lit(100.0)).cast("bigint")
    earned = F.col("work_completed_to_date") + F.col("stored_materials")
    net = F.col("total_earned") - F.col("retainage_held")
    off = lambda value, expected: F.coalesce(value != expected, F.lit(False))
    amounts = ("total_earned", "work_completed_to_date", "stored_materials", "retainage_pct", "retainage_held",
               "net_payment_due")
    missing = F.lit(False)
    for name in amounts:
        missing = missing | F.col(name).isNull()
    earned_bad = off(F.col("total_earned"), earned)
    held_bad = off(F.col("retainage_held"), expected_held)
    net_bad = off(F.col("net_payment_due"), net)
    return fact_pay.groupBy("building_id", "contractor_name").agg(
        F.count(F.lit(1)).alias("pay_app_count"),
        F.count_if(earned_bad).alias("earned_breaks"),
        F.count_if(held_bad).alias("retainage_breaks"),
        F.count_if(net_bad).alias("net_payment_breaks"),
        F.sum(F.abs(F.col("retainage_held") - expected_held)).alias("retainage_diff_amount"),
        F.count_if(missing).alias("missing_amounts"),
    )


SCURVE_SHAPES = ("linear", "sine")


def scurve_vs_baseline(fact_pay: DataFrame, shape: str = "linear", planned_end: str | None = None) -> DataFrame:
    """Cumulative actual spend vs a planned S-curve per building and month.

    The baseline is not in the data: the building's total scheduled value
    (one contract value per contractor) is spread over the calendar months
    from its first billed one to ``planned_end`` ('yyyy-MM'; none: its last
    billed month) along ``shape`` (linear, or the sine ``(1 - cos(pi t)) / 2``).
    Contractor names must be clean, or a contract counts once a spelling.
    Spend whose period cannot be read is a row of its own, outside the curve.
    """
    norm = fact_pay.withColumn("period", period_label("period"))
    monthly = norm.groupBy("building_id", "period").agg(F.sum("work_completed_this_period").alias("monthly_spend"))
    contract = (
        norm.groupBy("building_id", "contractor_name", "trade").agg(F.max("scheduled_value").alias("sv"))
        .groupBy("building_id").agg(F.sum("sv").alias("budget"))
    )
    return planned_curve(monthly, contract, shape, planned_end)


def planned_curve(monthly: DataFrame, budgets: DataFrame, shape: str = "linear", planned_end: str | None = None,
                  also: Sequence[str] = ()) -> DataFrame:
    """Running spend of (building, period) rows against the planned curve; ``also`` are columns to keep.

    ``budgets`` has one row per building (budget).
    """
    if shape not in SCURVE_SHAPES:
        raise ValueError(f"shape must be one of {SCURVE_SHAPES}")
    known = F.col("period").isNotNull()
    building = Window.partitionBy("building_id")
    run = building.orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    month = lambda c: F.to_date(c, "yyyy-MM")
    first = F.min("period").over(building)
    last = F.max("period").over(building) if planned_end is None else F.lit(planned_end)
    nth = lambda c: F.round(F.months_between(month(c), month(F.col("first_period"))) + F.lit(1)).cast("bigint")
    seq = monthly.select(
        "building_id", "period", "monthly_spend", *also,
        F.when(known, F.sum(F.when(known, F.col("monthly_spend"))).over(run)).alias("actual_cumulative"),
        first.alias("first_period"), last.alias("last_period"),
    ).join(budgets.withColumnRenamed("building_id", "__building"), F.col("building_id").eqNullSafe(F.col("__building")))
    # planned to be done at the end, and from then on
    t = F.least(F.lit(1.0), nth(F.col("period")).cast("double") / F.greatest(nth(F.col("last_period")), F.lit(1)).cast("double"))
    frac = t if shape == "linear" else (F.lit(1.0) - F.cos(F.lit(3.141592653589793) * t)) / F.lit(2.0)
    baseline = F.when(known, F.round(F.col("budget") * frac, 0))
    out = seq.select("building_id", "period", "monthly_spend", *also, "actual_cumulative",
                     baseline.alias("baseline_cumulative"))
    diff = F.col("actual_cumulative") - F.col("baseline_cumulative")
    return out.withColumns({
        "variance_to_baseline": diff,
        "position": F.when(F.col("period").isNull(), F.lit("unassigned")).when(diff > 0, F.lit("ahead"))
        .when(diff < 0, F.lit("behind")).otherwise(F.lit("on plan")),
    })


# ---------------------------------------------------------------- cost variance


def cost_variance_by_wbs(fact_cost: DataFrame, k: int = 10) -> DataFrame:
    """Worst ``k`` (WBS-1, building) cells by summed variance, ascending.

    Ties are broken by (wbs_level_1, building_id); null sums sort last.  The
    ``orderBy().limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own top k, only k rows per task move.
    """
    g = fact_cost.groupBy("wbs_level_1", "building_id").agg(
        F.sum("approved_budget").alias("approved_budget"),
        F.sum("actual_cost_to_date").alias("actual_cost"),
        F.sum("forecasted_final_cost").alias("forecasted_final_cost"),
        F.sum("variance").alias("variance"),
        F.sum("earned_value").alias("earned_value"),
    )
    g = g.withColumns({
        "variance_pct": pct("variance", "approved_budget", 2),
        "cpi": F.round(ratio("earned_value", "actual_cost"), 3),
    })
    return g.orderBy(F.col("variance").asc_nulls_last(), "wbs_level_1", "building_id").limit(k).select(
        "wbs_level_1", "building_id", "approved_budget", "actual_cost", "forecasted_final_cost",
        "variance", "variance_pct", "earned_value", "cpi",
    )


def _safe_name(value: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in value.lower())


def variance_matrix(fact_cost: DataFrame, buildings: Sequence[str], overrun_pct: float = -2.0) -> DataFrame:
    """WBS-1 x building matrix of variance and variance %, with a row band.

    The listed buildings have columns of their own; ``other`` sums all that
    are not listed, null ids included, so the total is over every row.  Band
    on the row total: ``overrun`` below ``overrun_pct`` %, ``watch`` below 0,
    else ``ok``.
    """
    names = [_safe_name(b) for b in buildings]
    if len(set(names)) != len(names) or "other" in names:
        raise ValueError(f"building ids collide after making column names: {list(buildings)}")
    listed = F.coalesce(F.col("building_id").isin(*buildings), F.lit(False)) if buildings else F.lit(False)
    slices = {n: F.col("building_id") == F.lit(b) for n, b in zip(names, buildings)} | {"other": ~listed}
    sums = []
    for n, hit in slices.items():
        sums += [F.sum(F.when(hit, F.col("variance"))).alias(f"variance_{n}"),
                 F.sum(F.when(hit, F.col("approved_budget"))).alias(f"b_{n}")]
    p = fact_cost.groupBy("wbs_level_1").agg(*sums, F.coalesce(F.sum("variance"), F.lit(0)).alias("total_variance"),
                                             F.coalesce(F.sum("approved_budget"), F.lit(0)).alias("b_total"))
    cols = [F.col("wbs_level_1")]
    for n in slices:
        cols += [F.col(f"variance_{n}"), pct(F.col(f"variance_{n}"), F.col(f"b_{n}"), 2).alias(f"variance_pct_{n}")]
    tp = pct(F.col("total_variance"), F.col("b_total"), 2)
    return p.select(*cols, "total_variance", tp.alias("total_variance_pct"),
                    F.when(tp < F.lit(overrun_pct), F.lit("overrun")).when(tp < 0, F.lit("watch")).otherwise(F.lit("ok")).alias("band"))


def variance_drill_through(fact_cost: DataFrame, top_k: int | None = None,
                           cell: Sequence[str] = ("wbs_level_1", "building_id")) -> DataFrame:
    """Cost codes inside each cell with share of the overrun and rank.

    Rank 1 = most negative variance (ties by cost code).  ``share_of_overrun``
    is the code's overrun over the cell's total overrun (overrun = negative
    variance only).  With ``top_k`` only the worst k per cell are kept: the
    cell totals are an aggregate joined back, so the rank is the only window
    and Spark drops rows before it is computed (a window group limit).
    """
    keys = list(cell)
    codes = fact_cost.groupBy(*keys, "cost_code").agg(
        F.sum("variance").alias("variance"),
        F.sum("approved_budget").alias("approved_budget"),
    )
    overrun = F.greatest(-F.col("variance"), F.lit(0))
    worst = Window.partitionBy(*keys).orderBy(F.col("variance").asc_nulls_last(), "cost_code")
    ranked = codes.withColumn("rank_in_cell", F.row_number().over(worst))
    if top_k is not None:
        ranked = ranked.where(F.col("rank_in_cell") <= top_k)
    totals = codes.groupBy(*[F.col(k).alias(f"t_{k}") for k in keys]).agg(F.sum(overrun).alias("cell_overrun"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"t_{k}"))
    return ranked.join(totals, same).select(
        *keys, "cost_code", "variance", "approved_budget", "rank_in_cell",
        F.round(ratio(overrun, "cell_overrun"), 4).alias("share_of_overrun"),
    )


# ---------------------------------------------------------------- schedule


def schedule_slippage(fact_sched: DataFrame) -> DataFrame:
    """Per (building, WBS-1): progress counts, start / finish slip, duration overrun, float risk.

    Finished, in progress and not started add up to the activities; a finish
    without a start is finished, and counted on its own besides.
    """
    started = F.col("actual_start").isNotNull()
    finished = F.col("actual_finish").isNotNull()
    start_slip = F.datediff("actual_start", "planned_start")
    finish_slip = F.datediff("actual_finish", "planned_finish")
    overrun = F.when(finished, F.greatest(F.col("actual_duration") - F.col("baseline_duration"), F.lit(0)))
    return fact_sched.groupBy("building_id", "wbs_level_1").agg(
        F.count(F.lit(1)).alias("activity_count"),
        F.count_if(finished).alias("finished_count"),
        F.count_if(started & ~finished).alias("in_progress_count"),
        F.count_if(~started & ~finished).alias("not_started_count"),
        F.count_if(~started & finished).alias("finished_without_start_count"),
        F.avg(start_slip).alias("avg_start_slip_days"),
        F.avg(finish_slip).alias("avg_finish_slip_days"),
        F.sum(overrun).alias("duration_overrun_days"),
        F.count_if(F.col("critical_path_flag") == "Y").alias("critical_count"),
        F.count_if(F.col("total_float_days") < 0).alias("negative_float_count"),
    )


# ---------------------------------------------------------------- star join


def star_join_report(fact_co: DataFrame, dim_date: DataFrame, dim_building: DataFrame,
                     dim_wbs: DataFrame) -> DataFrame:
    """Change orders through the date, building and WBS dimensions.

    The fact joins ``dim_date`` on the integer ``date_key``.  The dimensions
    are read from staged tables, whose size in bytes Spark knows: it
    broadcasts those below its own limit, so only the partial aggregate of
    the fact moves, and shuffles the others.
    """
    f = fact_co.select(
        "building_id", "wbs_code", "wbs_level_1", "cost_impact",
        F.date_format("submitted_date", "yyyyMMdd").cast("int").alias("date_key"),
    )
    j = (
        f.join(dim_date.select("date_key", "year", "quarter"), "date_key", "left")
        .join(dim_building.select("building_id", "campus"), "building_id", "left")
        .join(dim_wbs.select("wbs_code", "wbs_level_1", "wbs_level_2"), ["wbs_code", "wbs_level_1"], "left")
    )
    return j.groupBy("year", "quarter", "campus", "building_id", "wbs_level_1").agg(
        F.count(F.lit(1)).alias("co_count"),
        money_sum("cost_impact").alias("total_cost_impact"),
        F.count_if(F.col("wbs_level_2").isNotNull()).alias("with_level_2"),
    )


def star_cost_report(fact_cost: DataFrame, dim_building: DataFrame, dim_wbs: DataFrame) -> DataFrame:
    """Earned value per campus, building and WBS level 1 and 2, through the dimensions.

    Level 2 comes from ``dim_wbs`` by the fact's cost code; like
    ``star_join_report`` it leaves the join strategy to Spark.
    """
    f = fact_cost.drop("wbs_level_2").join(dim_building.select("building_id", "campus"), "building_id", "left")
    codes = dim_wbs.select(F.col("wbs_code").alias("cost_code"), "wbs_level_1", "wbs_level_2")
    j = f.join(codes, ["cost_code", "wbs_level_1"], "left")
    return ratios_from_totals(summed_components(j, ["campus", "building_id", "wbs_level_1", "wbs_level_2"]))
