"""Several tables as one version: readers see all of it, or the one before."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import star
from ledgerlens.plans import catalog as C
from ledgerlens.plans import etl
from ledgerlens.sources import bindings as B
from ledgerlens.sources import files, publication
from ledgerlens.sources.publication import Publication, expire, read_published, versions


def numbers(spark, n):
    return spark.range(n).select("id", (F.col("id") % 3).cast("string").alias("part"))


def publish(spark, root, n):
    out = Publication(spark, root)
    out.write("a", numbers(spark, n), partition_by=["part"])
    out.write("b", numbers(spark, 2 * n))
    return out


def counts(tables):
    return {name: df.count() for name, df in tables.items()}


def test_a_version_appears_as_a_whole(spark, tmp_path):
    root = str(tmp_path / "star")
    with pytest.raises(LookupError):
        read_published(spark, root)
    first = publish(spark, root, 10)
    assert versions(spark, root) == []  # written, not published
    assert first.commit() == 1 and counts(read_published(spark, root)) == {"a": 10, "b": 20}
    assert {n: e.row_count for n, e in first.entries.items()} == {"a": 10, "b": 20}
    held = read_published(spark, root)
    second = publish(spark, root, 7)
    assert counts(read_published(spark, root)) == {"a": 10, "b": 20}
    second.commit()
    assert counts(read_published(spark, root)) == {"a": 7, "b": 14}
    assert counts(held) == {"a": 10, "b": 20}  # a reader keeps its version
    assert counts(read_published(spark, root, version=1)) == {"a": 10, "b": 20}
    assert read_published(spark, root)["a"].schema["part"].dataType.simpleString() == "string"
    with pytest.raises(LookupError):
        read_published(spark, root, names=["c"])


def test_two_runs_at_once(spark, tmp_path):
    root = str(tmp_path / "star")
    one, two = publish(spark, root, 3), publish(spark, root, 5)
    two.commit()
    one.commit()  # both are version 1: the later one is read, whole
    assert counts(read_published(spark, root)) == {"a": 3, "b": 6} and len(versions(spark, root)) == 2


def test_empty_tables_and_mistakes(spark, tmp_path):
    root = str(tmp_path / "star")
    out = Publication(spark, root)
    with pytest.raises(ValueError):
        out.commit()
    out.write("a", numbers(spark, 0))
    with pytest.raises(ValueError):
        out.write("a", numbers(spark, 1))
    out.commit()
    assert counts(read_published(spark, root)) == {"a": 0}


def test_old_versions_expire(spark, tmp_path):
    root = str(tmp_path / "star")
    for n in (1, 2, 3):
        publish(spark, root, n).commit()
    publish(spark, root, 9)  # under way
    gone = expire(spark, root, keep=2)
    assert len(gone) == 1 and gone[0].startswith("v00000001")
    assert counts(read_published(spark, root, version=2)) == {"a": 2, "b": 4}
    assert len(os.listdir(os.path.join(root, "versions"))) == 3 and expire(spark, root, keep=3) == []


def test_a_job_that_fails_leaves_the_old_star(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "star")
    raw = {name: fn(spark, SF_SMALL) for name, fn in B.BINDINGS.items()}
    cfg = etl.ProgramConfig(C.CAMPUS, C.CLIENT, C.PROGRAM_VALUE, C.SNAPSHOT, vendor_rules=B.BINDING_VENDOR_RULES, fuzzy_vendors=False)
    etl.publish(spark, raw, root, cfg)
    before = {n: sorted(map(repr, df.collect())) for n, df in files.read_star(spark, root, register_views=False).items()}
    half = {name: df.where("building_id = 'BLD-1'") for name, df in raw.items()}
    real = star.dim_building
    monkeypatch.setattr(star, "dim_building", lambda *a: real(*a).withColumn("campus", F.raise_error(F.lit("fifth table"))))
    with pytest.raises(Exception, match="fifth table"):
        etl.publish(spark, half, root, cfg)
    with pytest.raises(RuntimeError, match="rows in the facts"):
        etl.publish(spark, half, root, cfg, expected={name: -1 for name in half})
    after = {n: sorted(map(repr, df.collect())) for n, df in files.read_star(spark, root, register_views=False).items()}
    assert before == after and len(after) == 8 and all(after.values())


def test_clustered_files_skip_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    root = str(tmp_path / "star")
    fact = C.co_fact(spark, SF_SMALL)
    out = Publication(spark, root)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small: keep its ranges apart
    try:
        table = out.write("co", fact, cluster_by=["submitted_date", "change_order_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    out.commit()
    groups = [pq.ParquetFile(f).metadata.row_group(i).column(4) for f in glob.glob(out.paths()["co"] + "/*.parquet")
              for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(groups) > 3 and all(g.path_in_schema == "submitted_date" for g in groups)
    spans = sorted((g.statistics.min, g.statistics.max) for g in groups if g.statistics.has_min_max)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))  # the files' days do not overlap
    day = spans[1][0]
    one = table.where(F.col("submitted_date") == F.lit(day))
    assert "PushedFilters: [IsNotNull(submitted_date), EqualTo(submitted_date," in one._jdf.queryExecution().executedPlan().toString()
    # what the statistics let the scan read: the row groups whose span holds the day
    assert sum(lo <= day <= hi for lo, hi in spans) <= 2 < len(spans)
    assert one.count() == fact.where(F.col("submitted_date") == F.lit(day)).count() > 0
    assert publication.read_published(spark, root)["co"].count() == fact.count()
