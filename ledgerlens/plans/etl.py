"""The batch job: raw CSV exports -> cleaned star schema (8 tables).

Differences from a straight script, all for scale:

* raw files are read with declared schemas (no inference pass per file);
* the exports are parsed once, into staged typed tables (line breaks in quoted
  text included); rows are counted while they are staged, and held against the
  rows counted while the facts are written: no scan is made for a count;
* each fact is computed once and staged as Parquet, and the dimensions are
  derived from the staged facts (column-pruned Parquet scans), instead of
  re-reading and re-cleaning the raw text for every table;
* the vendor surrogate key is numbered in parallel (``dense_surrogate_key``)
  rather than by a single-partition window;
* the tables are published together, as one version (a failed run leaves the
  old one whole);
* what a later step does not read is removed: shuffle files when their query
  ends, an export's staged rows when its fact is written (and, where asked for,
  the export itself when its rows are staged);
* the sink is Parquet by default; JDBC is available with bounded
  connection count and batch size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import SENTINEL_DATE
from ..operators import clean, star
from ..operators.vendors import DEFAULT_VENDOR_RULES, vendor_rule_map
from ..session import remove_path, shuffles_removed
from ..sources import files, publication, records
from ..sources.schemas import RAW_SOURCES, STAR_TABLES


@dataclass
class ProgramConfig:
    """Programme constants and cleaning parameters for one run."""

    campus: str
    client: str
    program_value_usd: int
    snapshot_date: str
    vendor_rules: Sequence[tuple[str, str]] = DEFAULT_VENDOR_RULES
    fuzzy_vendors: bool = True
    canonical_vendors: Sequence[str] | None = None
    calendar_start: str | None = None  # None -> span of the fact dates
    calendar_end: str | None = None
    # Facts are written in one directory per building (partition pruning for
    # building slices); an empty mapping writes them flat.
    fact_partitions: dict = field(default_factory=lambda: {
        "fact_project_cost": ["building_id"], "fact_change_orders": ["building_id"],
        "fact_schedule": ["building_id"], "fact_pay_applications": ["building_id"],
    })


# The fact that each raw export becomes, one row per raw row.
SOURCE_FACT = {
    "cost_ledger": "fact_project_cost",
    "change_orders": "fact_change_orders",
    "schedule": "fact_schedule",
    "pay_applications": "fact_pay_applications",
}


def read_raw(spark: SparkSession, paths: Mapping[str, str] | Iterable[tuple[str, str]],
             drop_exports: bool = False) -> dict[str, records.Records]:
    """Read the four raw exports (keys of ``RAW_SOURCES``) with declared schemas: staged rows, their
    number, and the text of those that do not fit.

    The exports are taken one by one: (name, path) pairs may come as each is
    fetched.  With ``drop_exports`` an export is removed when its rows are staged.
    """
    found = {}
    for name, path in paths.items() if isinstance(paths, Mapping) else paths:
        if name in RAW_SOURCES:
            found[name] = records.read_records(spark, path, RAW_SOURCES[name])
            if drop_exports:
                remove_path(spark, path)
    return {name: found[name] for name in RAW_SOURCES}


def quality_profile(raw: Mapping[str, DataFrame], cfg: ProgramConfig) -> DataFrame:
    """The data-quality census of all four exports (source, column_name, metric, value)."""
    canonical = list(dict.fromkeys(cfg.canonical_vendors or [c for _, c in cfg.vendor_rules]))
    dates = {"change_orders": ["submitted_date", "approved_date"], "schedule": star.SCHEDULE_DATES}
    vendors = {"cost_ledger": "vendor_name", "pay_applications": "contractor_name"}
    periods = {"cost_ledger": ["period_month"], "pay_applications": ["period"]}
    out = None
    for name, df in raw.items():
        vendor = vendors.get(name)
        if vendor:
            df = vendor_rule_map(df, vendor, "__clean", cfg.vendor_rules)
        part = clean.null_profile(df, name, date_columns=dates.get(name, ()),
                                  vendor_columns={vendor: "__clean"} if vendor else None, canonical=canonical,
                                  period_columns=periods.get(name, ()))
        out = part if out is None else out.unionByName(part)
    return out


def build_facts(raw: Mapping[str, DataFrame], cfg: ProgramConfig) -> dict[str, DataFrame]:
    return {
        "fact_project_cost": star.fact_project_cost(raw["cost_ledger"], cfg.vendor_rules, cfg.fuzzy_vendors,
                                                    cfg.canonical_vendors),
        "fact_change_orders": star.fact_change_orders(raw["change_orders"]),
        "fact_schedule": star.fact_schedule(raw["schedule"]),
        "fact_pay_applications": star.fact_pay_applications(raw["pay_applications"], cfg.vendor_rules,
                                                            cfg.fuzzy_vendors, cfg.canonical_vendors),
    }


def _date_span(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: earliest and latest real date over ``columns`` (one aggregate job)."""
    sentinel = F.lit(SENTINEL_DATE).cast("date")
    real = [F.when(F.col(c) < sentinel, F.col(c)) for c in columns]
    return df.agg(F.least(*[F.min(r) for r in real]).alias("lo"), F.greatest(*[F.max(r) for r in real]).alias("hi"))


def fact_calendar(co: DataFrame, sched: DataFrame) -> DataFrame:
    """The calendar of every date a fact carries (the open-item sentinel is ignored)."""
    spans = _date_span(co, ["submitted_date", "approved_date"]).unionByName(_date_span(sched, star.SCHEDULE_DATES))
    return star.calendar_spanning(spans, ["lo", "hi"])


def build_dims(spark: SparkSession, facts: Mapping[str, DataFrame], cfg: ProgramConfig) -> dict[str, DataFrame]:
    cost, co = facts["fact_project_cost"], facts["fact_change_orders"]
    sched, pay = facts["fact_schedule"], facts["fact_pay_applications"]
    if cfg.calendar_start and cfg.calendar_end:
        dim_date = star.calendar(spark, cfg.calendar_start, cfg.calendar_end)
    else:
        dim_date = fact_calendar(co, sched)
    return {
        "dim_building": star.dim_building([cost, co, sched, pay], cfg.campus, cfg.client, cfg.program_value_usd,
                                          cfg.snapshot_date),
        "dim_wbs": star.dim_wbs(cost, sched, co),
        "dim_vendor": star.dim_vendor(cost, pay),
        "dim_date": dim_date,
    }


def quarantine(raw: Mapping[str, records.Records]) -> DataFrame:
    """The unread rows of all exports: source, file, split, line, text."""
    out = None
    for name, found in raw.items():
        part = found.quarantine.select(F.lit(name).alias("source"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def publish(spark: SparkSession, raw: Mapping[str, DataFrame], out_root: str, cfg: ProgramConfig,
            also: Mapping[str, DataFrame] | None = None, expected: Mapping[str, int] | None = None,
            written: Callable[[str], None] | None = None) -> publication.Publication:
    """Write the eight tables (and ``also``) as one version: all of them are published, or none.

    With ``expected`` rows per export, a fact that has not as many rows is an
    error; its rows are counted while they are written.  ``written`` is told of
    each export whose fact is written: its rows are not read again.
    """
    out = publication.Publication(spark, out_root)
    for name, df in (also or {}).items():
        out.write(name, df)
    facts = {}
    source_of = {fact: source for source, fact in SOURCE_FACT.items()}
    for name, df in build_facts(raw, cfg).items():
        facts[name] = out.write(name, df, cfg.fact_partitions.get(name, ()))
        if written:
            written(source_of[name])
    loaded = {source: out.entries[fact].row_count for source, fact in SOURCE_FACT.items()}
    if expected is not None and loaded != dict(expected):
        raise RuntimeError(f"rows read {dict(expected)}, rows in the facts {loaded}")
    for name, df in build_dims(spark, facts, cfg).items():
        out.write(name, df)
    out.commit()
    return out


def run(spark: SparkSession, raw_paths: Mapping[str, str] | Iterable[tuple[str, str]], out_root: str, cfg: ProgramConfig,
        jdbc: Mapping[str, object] | None = None, drop_exports: bool = False) -> dict:
    """Run the whole job; returns the audit, the corrupt rows, the version and the written paths.

    The exports are parsed once, into staged typed tables; their rows are
    counted on the way (the audit).  The profile (table ``data_quality``), the
    unread rows (``quarantine``) and the eight tables become one version.  With
    ``jdbc`` (``url``, ``properties``, optional ``num_partitions``) each table
    is then loaded into the warehouse as well.  ``drop_exports``: see ``read_raw``.
    """
    with shuffles_removed(spark):
        read = read_raw(spark, raw_paths, drop_exports)
        audit = {name: found.row_count for name, found in read.items()}
        raw = {name: found.rows for name, found in read.items()}
        done = publish(spark, raw, out_root, cfg, {"data_quality": quality_profile(raw, cfg), "quarantine": quarantine(read)},
                       expected=audit, written=lambda name: read[name].drop(spark))
    paths = {name: path for name, path in done.paths().items() if name in STAR_TABLES}
    if jdbc:
        for name, path in paths.items():
            files.write_jdbc(spark.read.parquet(path), jdbc["url"], name, jdbc["properties"],
                             num_partitions=jdbc.get("num_partitions"))
    return {"audit": audit, "corrupt": {name: found.unread_count for name, found in read.items()},
            "version": done.version, "paths": paths}


def main(argv: Sequence[str] | None = None) -> None:
    """``python -m ledgerlens.plans.etl --cost_ledger P --change_orders P --schedule P
    --pay_applications P --out ROOT --campus C --client C --program_value N --snapshot YYYY-MM-DD``

    Runs on the session the cluster provides (``getOrCreate``); JDBC loading
    is enabled with ``--jdbc_url`` plus ``--jdbc_user`` and the name of an
    environment variable holding the password (``--jdbc_password_env``).
    """
    import argparse
    import json
    import os

    ap = argparse.ArgumentParser(description="raw exports -> star schema")
    for name in RAW_SOURCES:
        ap.add_argument(f"--{name}", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--campus", required=True)
    ap.add_argument("--client", required=True)
    ap.add_argument("--program_value", type=int, required=True)
    ap.add_argument("--snapshot", required=True)
    ap.add_argument("--rules_only", action="store_true", help="skip fuzzy vendor matching")
    ap.add_argument("--jdbc_url")
    ap.add_argument("--jdbc_user")
    ap.add_argument("--jdbc_password_env")
    ap.add_argument("--jdbc_partitions", type=int, default=8)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("ledgerlens-etl").getOrCreate()
    cfg = ProgramConfig(a.campus, a.client, a.program_value, a.snapshot, fuzzy_vendors=not a.rules_only)
    jdbc = None
    if a.jdbc_url:
        props = {"user": a.jdbc_user or "", "password": os.environ.get(a.jdbc_password_env or "", "")}
        jdbc = {"url": a.jdbc_url, "properties": props, "num_partitions": a.jdbc_partitions}
    res = run(spark, {n: getattr(a, n) for n in RAW_SOURCES}, a.out, cfg, jdbc)
    print(json.dumps(res["audit"]))


if __name__ == "__main__":
    main()
