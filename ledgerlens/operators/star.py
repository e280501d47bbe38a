"""Fact and dimension builders: raw export DataFrames -> star-schema tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DATE_LAYOUTS, SENTINEL_DATE
from ..sources import schemas as S
from .clean import approval_dates, normalize_dates, variance_backfill
from .evm import evm_row_metrics
from .keys import dense_surrogate_key
from .vendors import DEFAULT_VENDOR_RULES, vendor_fuzzy_match, vendor_rule_map


def _clean_vendor(df: DataFrame, column: str, output: str, rules, fuzzy: bool,
                  canonical: Sequence[str] | None) -> DataFrame:
    if fuzzy:
        return vendor_fuzzy_match(df, column, output, canonical=canonical, rules=rules)
    return vendor_rule_map(df, column, output, rules)


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def fact_project_cost(raw: DataFrame, rules=DEFAULT_VENDOR_RULES, fuzzy: bool = False,
                      canonical: Sequence[str] | None = None) -> DataFrame:
    """Cost ledger -> fact: variance back-filled, vendor standardised, EVM metrics."""
    df = variance_backfill(raw)
    df = _clean_vendor(df, "vendor_name", "vendor_name", rules, fuzzy, canonical)
    return _conform(evm_row_metrics(df), S.FACT_PROJECT_COST)


def fact_change_orders(raw: DataFrame, layouts: Sequence[str] = DATE_LAYOUTS) -> DataFrame:
    """Change-order log -> fact: clean dates, sentinel for open items, approval lag."""
    return _conform(approval_dates(raw, layouts=layouts), S.FACT_CHANGE_ORDERS)


SCHEDULE_DATES = ("planned_start", "planned_finish", "actual_start", "actual_finish")


def fact_schedule(raw: DataFrame, layouts: Sequence[str] = DATE_LAYOUTS) -> DataFrame:
    """Schedule export -> fact: four clean dates; null actuals kept as null."""
    return _conform(normalize_dates(raw, SCHEDULE_DATES, layouts), S.FACT_SCHEDULE)


def fact_pay_applications(raw: DataFrame, rules=DEFAULT_VENDOR_RULES, fuzzy: bool = False,
                          canonical: Sequence[str] | None = None) -> DataFrame:
    """Pay applications -> fact: contractor standardised, money typed.

    ``period`` stays the raw text, as loaded; see ``reports.cash_flow_by_period``
    for the normalised view.
    """
    df = _clean_vendor(raw, "contractor_name", "contractor_name", rules, fuzzy, canonical)
    return _conform(df, S.FACT_PAY_APPLICATIONS)


def dim_building(sources: Sequence[DataFrame], campus: str, client: str, program_value_usd: int,
                 snapshot_date: str) -> DataFrame:
    """Distinct building ids over all sources + programme constants (parameters).

    Rows without an id have a row of their own, with a null id.
    """
    ids = None
    for df in sources:
        part = df.select("building_id")
        ids = part if ids is None else ids.unionByName(part)
    return ids.distinct().select(
        "building_id",
        F.lit(campus).alias("campus"),
        F.lit(client).alias("client"),
        F.lit(program_value_usd).cast("bigint").alias("program_value_usd"),
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
    )


def dim_wbs(cost: DataFrame, schedule: DataFrame, change_orders: DataFrame) -> DataFrame:
    """WBS codes from all three sources; level-2 taken where any source has it.

    ``max`` ignores nulls and is order-independent (a ``first`` would depend
    on row order after the shuffle).
    """
    none = F.lit(None).cast("string")
    codes = (
        cost.select(F.col("cost_code").alias("wbs_code"), "wbs_level_1", "wbs_level_2")
        .unionByName(schedule.select("wbs_code", "wbs_level_1", none.alias("wbs_level_2")))
        .unionByName(change_orders.select("wbs_code", "wbs_level_1", none.alias("wbs_level_2")))
    )
    return codes.groupBy("wbs_code", "wbs_level_1").agg(F.max("wbs_level_2").alias("wbs_level_2"))


def dim_vendor(cost_fact: DataFrame, pay_fact: DataFrame) -> DataFrame:
    """Distinct standardised vendors with their trade, numbered by (name, trade)."""
    names = (
        cost_fact.select(F.col("vendor_name"))
        .unionByName(pay_fact.select(F.col("contractor_name").alias("vendor_name")))
        .where(F.col("vendor_name").isNotNull())
        .distinct()
    )
    trades = pay_fact.select(F.col("contractor_name").alias("vendor_name"), "trade").distinct()
    joined = names.join(trades, "vendor_name", "left")
    keyed = dense_surrogate_key(joined, ["vendor_name", "trade"], key="vendor_id")
    return keyed.select("vendor_id", "vendor_name", "trade")


def calendar(spark: SparkSession, start: Column | str, end: Column | str) -> DataFrame:
    """Daily calendar from ``start`` to ``end`` inclusive (DATE columns or literals)."""
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    span = spark.range(1).select(s.alias("s"), e.alias("e"))
    return date_attributes(span.select(F.explode(F.sequence("s", "e", F.expr("interval 1 day"))).alias("full_date")))


def calendar_spanning(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Calendar covering every date in ``columns`` of ``df`` (min..max).

    The span is one aggregate row computed on the cluster; the generator
    then explodes it.  Its size follows the date range, not the row count.
    The open-item sentinel date is not a real date and is ignored.
    """
    sentinel = F.lit(SENTINEL_DATE).cast("date")
    real = {c: F.when(F.col(c) < sentinel, F.col(c)) for c in columns}
    mins, maxs = [F.min(real[c]) for c in columns], [F.max(real[c]) for c in columns]
    lo = mins[0] if len(mins) == 1 else F.least(*mins)
    hi = maxs[0] if len(maxs) == 1 else F.greatest(*maxs)
    span = df.agg(lo.alias("s"), hi.alias("e")).where(F.col("s").isNotNull())
    days = span.select(F.explode(F.sequence("s", "e", F.expr("interval 1 day"))).alias("full_date"))
    return date_attributes(days)


def date_attributes(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return days.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).cast("int").alias("is_weekend"),
        (d == F.last_day(d)).cast("int").alias("is_month_end"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
    )
