"""Landing stream: new files are taken exactly once across runs."""

import os
import tempfile

from conftest import SF_SMALL
from ledgerlens.plans.etl import ProgramConfig
from ledgerlens.sources import bindings as B
from ledgerlens.sources import files
from ledgerlens.streaming.landing import land_new_exports, refresh_star


def test_new_files_taken_once(spark):
    root = tempfile.mkdtemp(prefix="ledgerlens-landing-")
    landing = {name: os.path.join(root, "landing", name) for name in B.BINDINGS}
    frames = {name: fn(spark, SF_SMALL) for name, fn in B.BINDINGS.items()}
    for name, df in frames.items():
        files.write_csv(df, os.path.join(landing[name], "day1"))
    ckpt, landed = os.path.join(root, "ckpt"), os.path.join(root, "landed")
    counts = {n: df.count() for n, df in frames.items()}

    first = land_new_exports(spark, {n: landing[n] + "/*" for n in landing}, landed, ckpt)
    assert first == counts
    again = land_new_exports(spark, {n: landing[n] + "/*" for n in landing}, landed, ckpt)
    assert again == {n: 0 for n in counts}
    files.write_csv(frames["change_orders"], os.path.join(landing["change_orders"], "day2"))
    third = land_new_exports(spark, {n: landing[n] + "/*" for n in landing}, landed, ckpt)
    assert third["change_orders"] == counts["change_orders"] and third["cost_ledger"] == 0

    cfg = ProgramConfig("Campus", "Owner", 1, "2001-12-31", vendor_rules=B.BINDING_VENDOR_RULES, fuzzy_vendors=False)
    paths = refresh_star(spark, landed, os.path.join(root, "star"), cfg)
    assert spark.read.parquet(paths["fact_change_orders"]).count() == 2 * counts["change_orders"]


def test_a_checkpoint_must_be_named(spark):
    import pytest

    with pytest.raises((TypeError, ValueError)):
        land_new_exports(spark, {}, "landed")
    with pytest.raises(ValueError):
        land_new_exports(spark, {}, "landed", "")


def test_new_session_takes_only_the_new_file(spark):
    """A second application with the same checkpoint folder: the old file is not lost, nor taken twice."""
    from ledgerlens.sources.schemas import RAW_CHANGE_ORDERS

    root = tempfile.mkdtemp(prefix="ledgerlens-landing-apps-")
    land, out, ckpt = (os.path.join(root, d) for d in ("co", "landed", "ck"))
    os.makedirs(land)
    row = "{},OCO,\"said \"\"go\"\", then left\",2024-01-05,,Pending,12.5,3,Owner,BLD-A,01.10,01\n"
    taken = []
    for run, name in enumerate(("a", None, "b")):
        if name:
            with open(os.path.join(land, f"{name}.csv"), "w") as fh:
                fh.write(",".join(RAW_CHANGE_ORDERS.fieldNames()) + "\n" + row.format(name))
        spark.sparkContext.setCheckpointDir(os.path.join(root, f"app{run}"))  # new in every application
        taken.append(land_new_exports(spark.newSession(), {"change_orders": land}, out, ckpt)["change_orders"])
    assert taken == [1, 0, 1]
    rows = spark.read.parquet(os.path.join(out, "change_orders")).collect()
    assert sorted(r.change_order_id for r in rows) == ["a", "b"]
    assert {r.description for r in rows} == {'said "go", then left'}


def test_malformed_file_does_not_stop_the_stream(spark):
    from ledgerlens.sources.schemas import RAW_CHANGE_ORDERS
    root = tempfile.mkdtemp(prefix="ledgerlens-landing-bad-")
    land = os.path.join(root, "co")
    os.makedirs(land)
    header = ",".join(RAW_CHANGE_ORDERS.fieldNames())
    with open(os.path.join(land, "a.csv"), "w") as fh:
        fh.write(header + "\n" + "CO-1,OCO,x,2024-01-05,,Pending,12.5,3,Owner,BLD-A,01.10,01\n"
                 + "CO-2,OCO,x,2024-01-05,,Pending,not-a-number,zz,Owner,BLD-A,01.10,01\n")
    taken = land_new_exports(spark, {"change_orders": land}, os.path.join(root, "landed"), os.path.join(root, "ck"))
    assert taken == {"change_orders": 2}
    rows = {r.change_order_id: r for r in spark.read.parquet(os.path.join(root, "landed", "change_orders")).collect()}
    assert rows["CO-1"].cost_impact == 12.5 and rows["CO-2"].cost_impact is None
