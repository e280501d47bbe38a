"""End-to-end job: bound exports written as CSV -> ETL -> star tables -> reports."""

import os
import tempfile


from conftest import SF_SMALL
from ledgerlens.operators import evm, reports
from ledgerlens.plans import catalog as C
from ledgerlens.plans.etl import ProgramConfig, run
from ledgerlens.sources import bindings as B
from ledgerlens.sources import files


def test_etl_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="ledgerlens-etl-")
    raw_paths = {}
    for name, fn in B.BINDINGS.items():
        raw_paths[name] = os.path.join(root, "raw", name)
        files.write_csv(fn(spark, SF_SMALL), raw_paths[name])
    cfg = ProgramConfig("Campus", "Owner", 1, "2001-12-31", vendor_rules=B.BINDING_VENDOR_RULES,
                        fuzzy_vendors=True, canonical_vendors=B.CANONICAL_VENDORS)
    res = run(spark, raw_paths, os.path.join(root, "star"), cfg)
    assert set(res["paths"]) == {"fact_project_cost", "fact_change_orders", "fact_schedule", "fact_pay_applications",
                                 "dim_building", "dim_wbs", "dim_vendor", "dim_date"}
    assert res["audit"]["change_orders"] == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    star = files.read_star(spark, os.path.join(root, "star"))
    # the report from the staged star equals the report computed directly from the binding (rules-only
    # vendor cleaning does not affect the building summary)
    a = {r.building_id: r for r in evm.evm_summary_by_building(star["fact_project_cost"]).collect()}
    b = {r.building_id: r for r in C.q_evm_summary_by_building(spark, SF_SMALL).collect()}
    assert a == b
    dv = star["dim_vendor"].orderBy("vendor_id").collect()
    assert [r.vendor_id for r in dv] == list(range(1, len(dv) + 1))
    # fuzzy cleaning maps 'Harbour Steel Works' etc. onto the canonical list
    names = {r.vendor_name for r in dv}
    assert "Harbour Steel Works" not in names and "Harbor Steel Works" in names
    # SQL over the registered views works (star_read)
    n = spark.sql("SELECT count(*) FROM fact_change_orders WHERE approved_date = DATE'9999-12-31'").collect()[0][0]
    assert n > 0
    assert reports.change_order_aging(star["fact_change_orders"]).count() > 0


def test_etl_tables_equal_registered_queries(spark):
    """Rules-only run: every fact (and the id-independent dimensions) written by
    the job after a CSV round trip equals the registered query, row for row."""
    from collections import Counter

    root = tempfile.mkdtemp(prefix="ledgerlens-etl2-")
    raw_paths = {}
    for name, fn in B.BINDINGS.items():
        raw_paths[name] = os.path.join(root, "raw", name)
        files.write_csv(fn(spark, SF_SMALL), raw_paths[name])
    cfg = ProgramConfig(C.CAMPUS, C.CLIENT, C.PROGRAM_VALUE, C.SNAPSHOT, vendor_rules=B.BINDING_VENDOR_RULES,
                        fuzzy_vendors=False)
    run(spark, raw_paths, os.path.join(root, "star"), cfg)
    star = files.read_star(spark, os.path.join(root, "star"), register_views=False)
    # contractors are unified by the fuzzy match in the registered queries: see the etl_job key
    for name in ("fact_project_cost", "fact_change_orders", "fact_schedule", "dim_building", "dim_wbs"):
        got = star[name]
        want = C.QUERIES[name](spark, SF_SMALL).select(*got.columns)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), name


def test_building_slice_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="ledgerlens-etl3-")
    raw_paths = {}
    for name, fn in B.BINDINGS.items():
        raw_paths[name] = os.path.join(root, "raw", name)
        files.write_csv(fn(spark, SF_SMALL), raw_paths[name])
    cfg = ProgramConfig("Campus", "Owner", 1, "2001-12-31", vendor_rules=B.BINDING_VENDOR_RULES, fuzzy_vendors=False)
    res = run(spark, raw_paths, os.path.join(root, "star"), cfg)
    assert os.path.isdir(os.path.join(res["paths"]["fact_project_cost"], "building_id=BLD-1"))
    star = files.read_star(spark, os.path.join(root, "star"), register_views=False)
    one = evm.evm_summary_by_building(star["fact_project_cost"].where("building_id = 'BLD-1'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(building_id" in plan and "BLD-1" in plan
    full = {r.building_id: r for r in evm.evm_summary_by_building(star["fact_project_cost"]).collect()}
    assert one.collect()[0] == full["BLD-1"]


def test_etl_calendar_covers_all_fact_dates(spark):
    from pyspark.sql import functions as F
    root = tempfile.mkdtemp(prefix="ledgerlens-etl4-")
    raw_paths = {}
    for name, fn in B.BINDINGS.items():
        raw_paths[name] = os.path.join(root, "raw", name)
        files.write_csv(fn(spark, SF_SMALL), raw_paths[name])
    cfg = ProgramConfig("Campus", "Owner", 1, "2001-12-31", vendor_rules=B.BINDING_VENDOR_RULES, fuzzy_vendors=False)
    run(spark, raw_paths, os.path.join(root, "star"), cfg)
    star = files.read_star(spark, os.path.join(root, "star"), register_views=False)
    cal = star["dim_date"].agg(F.min("full_date"), F.max("full_date"), F.count(F.lit(1))).collect()[0]
    co = star["fact_change_orders"].where(F.col("approved_date") < F.lit("9999-12-31").cast("date"))
    lo = min(co.agg(F.min("submitted_date")).collect()[0][0], star["fact_schedule"].agg(F.min("planned_start")).collect()[0][0])
    hi = max(co.agg(F.max("approved_date")).collect()[0][0], star["fact_schedule"].agg(F.max("actual_finish")).collect()[0][0])
    assert cal[0] <= lo and cal[1] >= hi and cal[1].year < 9999
    assert cal[2] == (cal[1] - cal[0]).days + 1


def test_etl_keeps_on_disk_only_what_later_steps_read(spark, monkeypatch):
    """Exports come one by one and go when their rows are staged; staged rows go when their fact is written."""
    from ledgerlens.sources import publication
    from ledgerlens.sources.schemas import RAW_SOURCES

    root = tempfile.mkdtemp(prefix="ledgerlens-etl5-")
    kept = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    staged_before = set(os.listdir(kept))
    seen = []  # exports and staged rows there are while a table is written

    def exports():
        for name, fn in B.BINDINGS.items():
            assert not any(os.path.exists(os.path.join(root, "raw", other)) for other in RAW_SOURCES)
            path = os.path.join(root, "raw", name)
            files.write_csv(fn(spark, SF_SMALL), path, **{**C.EXPORT, "maxRecordsPerFile": "1000"})
            assert len([f for f in os.listdir(path) if f.endswith(".csv.gz")]) > 0
            yield name, path

    def write(self, name, df, *args, of=publication.Publication.write, **more):
        staged = [f for f in os.listdir(kept) if f.startswith("records-") and f not in staged_before]
        seen.append((name, len(staged), len(os.listdir(os.path.join(root, "raw")))))
        return of(self, name, df, *args, **more)

    monkeypatch.setattr(publication.Publication, "write", write)
    cfg = ProgramConfig(C.CAMPUS, C.CLIENT, C.PROGRAM_VALUE, C.SNAPSHOT, vendor_rules=B.BINDING_VENDOR_RULES,
                        canonical_vendors=B.CANONICAL_VENDORS)
    res = run(spark, exports(), os.path.join(root, "star"), cfg, drop_exports=True)
    assert seen == [("data_quality", 4, 0), ("quarantine", 4, 0), ("fact_project_cost", 4, 0), ("fact_change_orders", 3, 0),
                    ("fact_schedule", 2, 0), ("fact_pay_applications", 1, 0), ("dim_building", 0, 0), ("dim_wbs", 0, 0),
                    ("dim_vendor", 0, 0), ("dim_date", 0, 0)]
    # the tables are those of a run over plain exports that stay
    raw_paths = {}
    for name, fn in B.BINDINGS.items():
        raw_paths[name] = os.path.join(root, "plain", name)
        files.write_csv(fn(spark, SF_SMALL), raw_paths[name])
    plain = run(spark, raw_paths, os.path.join(root, "star-of-plain"), cfg)
    assert res["audit"] == plain["audit"] and all(os.path.isdir(p) for p in raw_paths.values())
    got, want = (files.read_star(spark, os.path.join(root, at), register_views=False) for at in ("star", "star-of-plain"))
    for name in got:
        assert sorted(map(repr, got[name].collect())) == sorted(map(repr, want[name].collect())), name


def test_shuffles_go_with_their_query(spark):
    from ledgerlens.session import shuffles_removed

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
