"""Cleaning operators: dates, periods, sentinels, lags, back-fills, profiling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D


def normalize_dates(df: DataFrame, columns: Sequence[str] | Mapping[str, str],
                    layouts: Sequence[str] = D.DATE_LAYOUTS) -> DataFrame:
    """Parse text date columns in mixed layouts into DATE columns.

    ``columns`` is a list (replace in place) or a mapping raw -> output name.
    The parser is written once, over the array of a row's texts: written out
    per column it outgrows what the JVM compiles and runs interpreted.
    """
    mapping = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    if not mapping:
        return df
    read = df.withColumn("__dates", F.transform(_texts(mapping), lambda t: D.trimmed_date(t, layouts)))
    return read.withColumns({out: F.col("__dates")[i] for i, out in enumerate(mapping.values())}).drop("__dates")


def _texts(columns: Iterable[str]) -> Column:
    """The texts of a row in one array, trimmed once for all attempts at them."""
    return F.array(*[F.trim(F.col(c)) for c in columns])


def normalize_periods(df: DataFrame, columns: Mapping[str, str],
                      layouts: Sequence[str] = D.PERIOD_LAYOUTS) -> DataFrame:
    """Period text (``yyyy-MM`` / ``MMM-yyyy`` / ``MMMM yyyy``) -> ``yyyy-MM`` label
    in ``columns[raw]`` and first-of-month DATE in ``<label>_start``."""
    out = {}
    for raw, label in columns.items():
        out[label] = D.period_label(raw, layouts)
        out[f"{label}_start"] = D.normalize_period(raw, layouts)
    return df.withColumns(out)


def approval_dates(df: DataFrame, submitted: str = "submitted_date", decided: str = "approved_date",
                   lag: str = "co_approval_lag_days", sentinel: str = D.SENTINEL_DATE,
                   layouts: Sequence[str] = D.DATE_LAYOUTS) -> DataFrame:
    """Clean both dates, put the sentinel on undecided items, derive the lag.

    A non-blank decision text that does not parse also becomes the sentinel
    (it is indistinguishable from an open item afterwards); ``null_profile``
    counts such rows so they are not lost silently.
    """
    cleaned = normalize_dates(df, [submitted, decided], layouts)
    return cleaned.withColumns({
        decided: D.sentinel_date(decided, sentinel),
    }).withColumn(lag, D.lag_days(decided, submitted, sentinel).cast("int"))


def variance_backfill(df: DataFrame, variance: str = "variance", budget: str = "approved_budget",
                      forecast: str = "forecasted_final_cost") -> DataFrame:
    """Keep a present variance; fill a missing one as budget - forecast."""
    return df.withColumn(variance, F.coalesce(F.col(variance), F.col(budget) - F.col(forecast)))


def null_profile(df: DataFrame, source: str, date_columns: Sequence[str] = (),
                 vendor_columns: Mapping[str, str] | None = None, canonical: Sequence[str] = (),
                 layouts: Sequence[str] = D.DATE_LAYOUTS, period_columns: Sequence[str] = ()) -> DataFrame:
    """Data-quality census of one source as long rows (source, column, metric, value).

    Metrics: ``nulls`` for every column; ``unparseable`` (non-blank text no
    layout accepts) and ``layout <fmt>`` (values read with each layout, the
    first that parses) for ``date_columns``; ``unparseable`` for
    ``period_columns``; ``unmatched`` for each raw vendor
    column ``raw`` in ``vendor_columns`` -- non-null rows whose cleaned value
    (column ``vendor_columns[raw]``) is not in ``canonical``.  Profiled
    columns are those of ``df`` except the cleaned vendor columns.  One
    aggregate job, then an unpivot of the single result row.
    """
    aggs = []
    cleaned_cols = set((vendor_columns or {}).values())
    for c in [c for c in df.columns if c not in cleaned_cols]:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}|nulls"))
    # each text is read once, in a projection below the aggregate
    if date_columns:
        df = df.withColumn("__layouts", F.transform(_texts(date_columns), lambda t: D.trimmed_layout(t, layouts)))
    read = {f"__layout_{c}": F.col("__layouts")[i] for i, c in enumerate(date_columns)}
    read |= {f"__period_{c}": D.normalize_period(c) for c in period_columns}
    df = df.withColumns(read) if read else df
    written = lambda c: F.coalesce(F.trim(F.col(c)) != "", F.lit(False))
    for c in date_columns:
        first = F.col(f"__layout_{c}")
        aggs.append(F.count_if(written(c) & first.isNull()).alias(f"{c}|unparseable"))
        for i, fmt in enumerate(layouts):
            aggs.append(F.count_if(first == i).alias(f"{c}|layout {fmt}"))
    for c in period_columns:
        aggs.append(F.count_if(written(c) & F.col(f"__period_{c}").isNull()).alias(f"{c}|unparseable"))
    for raw, clean in (vendor_columns or {}).items():
        known = F.col(clean).isin(*canonical) if canonical else F.lit(False)
        aggs.append(F.count_if(F.col(raw).isNotNull() & ~known).alias(f"{raw}|unmatched"))
    one_row = df.agg(*aggs)
    cols = one_row.columns
    long = one_row.unpivot([], cols, "key", "value")
    parts = F.split(F.col("key"), r"\|")
    return long.select(
        F.lit(source).alias("source"),
        parts.getItem(0).alias("column_name"),
        parts.getItem(1).alias("metric"),
        F.col("value").cast("bigint").alias("value"),
    )


def source_row_audit(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per source in one job: tag, union, group."""
    tagged = None
    for name, df in sources.items():
        part = df.select(F.lit(name).alias("source"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))
