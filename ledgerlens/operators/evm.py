"""Earned-value metrics: per row, per slice, over time.

Slice metrics are always re-derived from *summed* components (EV, AC, PV,
budget), never averaged from row ratios.  Aggregations run as partial +
final hash aggregates, so a building holding a third of all rows is
combined map-side and never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import pct, ratio

EV, AC, PV, BAC = "earned_value", "actual_cost_to_date", "planned_value", "approved_budget"


def cpi_expr(ev: Column, ac: Column) -> Column:
    return F.round(ratio(ev, ac), 3)


def spi_expr(ev: Column, pv: Column) -> Column:
    return F.round(ratio(ev, pv), 3)


def eac_raw(bac: Column, ev: Column, ac: Column) -> Column:
    """Budget / CPI with the *unrounded* CPI; null when AC or EV is 0."""
    return F.try_divide(bac.cast("double"), ratio(ev, ac))


def evm_row_metrics(df: DataFrame) -> DataFrame:
    """Per-row cpi, spi, eac, vac, cost_variance_pct (null when undefined)."""
    ev, ac, pv, bac = F.col(EV), F.col(AC), F.col(PV), F.col(BAC)
    eac = eac_raw(bac, ev, ac)
    return df.withColumns({
        "cpi": F.when(ac > 0, cpi_expr(ev, ac)),
        "spi": F.when(pv > 0, spi_expr(ev, pv)),
        "eac": F.when(ac > 0, F.round(eac, 0)),
        "vac": F.when(ac > 0, F.round(bac - eac, 0)),
        "cost_variance_pct": F.when(bac > 0, pct(bac - F.col("forecasted_final_cost"), bac)),
    })


def summed_components(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(BAC).alias("total_budget"),
        F.sum(AC).alias("total_actual_cost"),
        F.sum(EV).alias("total_earned_value"),
        F.sum(PV).alias("total_planned_value"),
    )


def ratios_from_totals(df: DataFrame) -> DataFrame:
    bac, ac, ev, pv = (F.col(c) for c in ("total_budget", "total_actual_cost", "total_earned_value", "total_planned_value"))
    eac = eac_raw(bac, ev, ac)
    return df.withColumns({
        "cpi": cpi_expr(ev, ac),
        "spi": spi_expr(ev, pv),
        "eac": F.round(eac, 0),
        "vac": F.round(bac - eac, 0),
    })


def evm_summary_by_building(fact: DataFrame, key: str | Sequence[str] = "building_id") -> DataFrame:
    """Per building (or any slice given as one or more key columns): cpi, spi
    (3 dp), eac, vac (0 dp) + budget / AC / EV totals, ordered by the keys."""
    keys = [key] if isinstance(key, str) else list(key)
    totals = summed_components(fact, keys)
    return ratios_from_totals(totals).select(
        *keys, "cpi", "spi", "eac", "vac", "total_budget", "total_actual_cost", "total_earned_value"
    ).orderBy(*[F.asc_nulls_last(k) for k in keys])


def evm_cube(fact: DataFrame, dims: Sequence[str] = ("building_id", "wbs_level_1", "wbs_level_2")) -> DataFrame:
    """CPI / SPI / EAC / VAC at every slice of ``dims`` (all subsets, incl. total).

    The fact is aggregated to the finest (dims) grain first, so the cube's
    ``Expand`` multiplies a small pre-aggregate, not the raw rows.
    """
    fine = summed_components(fact, list(dims))
    cubed = fine.cube(*dims).agg(
        F.sum("total_budget").alias("total_budget"),
        F.sum("total_actual_cost").alias("total_actual_cost"),
        F.sum("total_earned_value").alias("total_earned_value"),
        F.sum("total_planned_value").alias("total_planned_value"),
        F.grouping_id().cast("int").alias("grouping_level"),
    )
    return ratios_from_totals(cubed)


# Default CPI bands for the traffic light: Green at or above ``green``, Red
# below ``red``, Amber between.  The source states no numeric thresholds, so
# these are parameters, not published values.
DEFAULT_CPI_GREEN = 1.0
DEFAULT_CPI_RED = 0.9


def evm_traffic_light(fact: DataFrame, green: float = DEFAULT_CPI_GREEN, red: float = DEFAULT_CPI_RED,
                      key: str = "building_id") -> DataFrame:
    """Per building KPI row + cost per $1 of earned work (1/CPI) + status."""
    s = evm_summary_by_building(fact, key)
    return s.withColumns({
        "cost_per_dollar": F.round(F.try_divide(F.col("total_actual_cost").cast("double"),
                                                F.col("total_earned_value").cast("double")), 3),
        "status": F.when(F.col("cpi").isNull(), F.lit("No Data"))
        .when(F.col("cpi") >= F.lit(green), F.lit("Green"))
        .when(F.col("cpi") < F.lit(red), F.lit("Red"))
        .otherwise(F.lit("Amber")),
    })


def evm_trend_monthly(fact: DataFrame, period_col: str = "period", key: str = "building_id") -> DataFrame:
    """Cumulative CPI / SPI / EAC per building and month, with month-over-month change.

    The fact is aggregated to (building, month) first; the running-sum and
    lag windows then only see that small grain.  Rows whose period cannot be
    read ('yyyy-MM') are one row of their own with their own sums, outside
    every running total.  The change is against the calendar month before:
    where that has no row, there is none ('n/a').
    """
    return evm_trend_on(summed_components(fact, [key, period_col]), period_col, key)


def evm_trend_on(monthly: DataFrame, period_col: str, key: str, also: Sequence[str] = ()) -> DataFrame:
    """Running totals, ratios and changes of the summed components per (key, month); ``also`` are columns to keep."""
    known = F.col(period_col).isNotNull()
    w = Window.partitionBy(key, known).orderBy(period_col)  # the unread rows are apart
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = monthly.select(
        key, period_col, *also,
        F.sum("total_budget").over(run).alias("cum_budget"),
        F.sum("total_actual_cost").over(run).alias("cum_actual_cost"),
        F.sum("total_earned_value").over(run).alias("cum_earned_value"),
        F.sum("total_planned_value").over(run).alias("cum_planned_value"),
    )
    bac, ac, ev, pv = (F.col(c) for c in ("cum_budget", "cum_actual_cost", "cum_earned_value", "cum_planned_value"))
    eac = eac_raw(bac, ev, ac)
    with_ratios = cum.withColumns({
        "cpi": cpi_expr(ev, ac),
        "spi": spi_expr(ev, pv),
        "eac": F.round(eac, 0),
    })
    month = lambda c: F.to_date(c, "yyyy-MM")
    adjacent = F.add_months(month(F.lag(period_col).over(w)), 1) == month(F.col(period_col))
    prev = F.when(adjacent, F.lag("cpi").over(w))
    delta = F.round(F.col("cpi") - prev, 3)
    return with_ratios.withColumns({
        "cpi_change": delta,
        "cpi_direction": F.when(prev.isNull() | F.col("cpi").isNull(), F.lit("n/a"))
        .when(F.col("cpi") > prev, F.lit("improving"))
        .when(F.col("cpi") < prev, F.lit("worsening"))
        .otherwise(F.lit("flat")),
    })


def answer_key_check(computed: DataFrame, expected: DataFrame, keys: Sequence[str],
                     tolerances: dict[str, float]) -> DataFrame:
    """Compare computed metrics with an expected table, metric by metric.

    Full outer join on ``keys`` (null keys meet); one output row per key x metric with
    status PASS (|diff| <= tolerance), FAIL, MISSING_COMPUTED or
    MISSING_EXPECTED.
    """
    metrics = list(tolerances)
    c = computed.select(*keys, *[F.col(m).cast("double").alias(f"c__{m}") for m in metrics]).withColumn("c__present", F.lit(True))
    e = expected.select(*keys, *[F.col(m).cast("double").alias(f"e__{m}") for m in metrics]).withColumn("e__present", F.lit(True))
    e = e.withColumnsRenamed({k: f"e__key_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & c[k].eqNullSafe(e[f"e__key_{k}"])
    j = c.join(e, same, "full").withColumns({k: F.coalesce(F.col(k), F.col(f"e__key_{k}")) for k in keys})
    stacked = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"c__{m}").alias("computed"), F.col(f"e__{m}").alias("expected"),
                 F.lit(float(tol)).alias("tolerance"))
        for m, tol in tolerances.items()
    ])).alias("m")
    long = j.select(*keys, "c__present", "e__present", stacked)
    diff = F.abs(F.col("m.computed") - F.col("m.expected"))
    return long.select(
        *keys,
        F.col("m.metric").alias("metric"),
        F.col("m.computed").alias("computed"),
        F.col("m.expected").alias("expected"),
        diff.alias("abs_diff"),
        F.when(F.col("c__present").isNull(), F.lit("MISSING_COMPUTED"))
        .when(F.col("e__present").isNull(), F.lit("MISSING_EXPECTED"))
        .when(F.col("m.computed").isNull() & F.col("m.expected").isNull(), F.lit("PASS"))
        .when(diff <= F.col("m.tolerance"), F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
        .alias("status"),
    )
