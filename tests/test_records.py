"""CSV records with line breaks between quotes, over splits of every size."""

import csv
import os
import random

import pytest
from pyspark.sql import types as T

from conftest import SF_SMALL
from ledgerlens.sources import bindings as B
from ledgerlens.sources import files, records
from ledgerlens.sources.schemas import RAW_CHANGE_ORDERS

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.StringType()), T.StructField("v", T.DoubleType())])


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, order, rows, end="\n", blank=0):
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as out:
        w = csv.writer(out, lineterminator=end)
        w.writerow(order)
        for i, row in enumerate(rows):
            w.writerow([row[c] for c in order])
            if blank and i % blank == 0:
                out.write(end)


@pytest.mark.parametrize("size", [150, 1000, 1 << 20])
def test_records_equal_what_was_written(spark, tmp_path, small_splits, size):
    rng, want = random.Random(size), []
    for f, (order, end) in enumerate([(("id", "d", "v"), "\n"), (("v", "x", "d", "id"), "\r\n"), (("id", "d", "v"), "\n")]):
        rows = []
        for i in range(120):
            text = "".join(rng.choice(["a", '"', "\n", " ", ",", "é", "\r\n", "b"]) for _ in range(rng.randint(0, 30)))
            text = "long\n" * 300 if i % 37 == 5 else text  # over several splits
            rows.append({"id": f * 1000 + i, "d": text, "v": i / 4, "x": "u\nv"})
            want.append((f * 1000 + i, text or None, i / 4))
        write(tmp_path, f"f{f}.csv", order, rows, end, blank=9)
    small_splits(size)
    got = records.read_records(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, got.rows.collect()), key=repr) == sorted(want, key=repr)
    assert got.quarantine.count() == 0 and (got.row_count, got.unread_count) == (len(want), 0)


def test_a_file_is_read_in_many_tasks(spark, tmp_path, small_splits):
    path = str(tmp_path / "orders")
    source = B.change_orders_with_breaks(spark, SF_SMALL)
    files.write_csv(source.coalesce(1), path)
    small_splits(20_000)
    states = records.split_states(spark, path)
    assert len(states) > 10 and any(s["inside"] for s in states)  # some splits start between quotes
    got = records.read_records(spark, path, RAW_CHANGE_ORDERS)
    text = records._lines(spark, path)
    assert text.rdd.getNumPartitions() > 10
    assert sorted(map(repr, got.rows.collect())) == sorted(map(repr, source.select(*got.rows.columns).collect()))
    plan = text.select("file_id", "split", "value").mapInArrow(records._joiner({}, 1), records._PIECE)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()  # no text is shuffled


def test_unread_rows_are_kept_and_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,d,v\n1,x,1.5\n2,"two\nlines",bad\n3,y\n4,z,2,extra\n\n  \n5,"",\n')
    got = records.read_records(spark, str(tmp_path), SCHEMA)
    rows = {r["id"]: tuple(r) for r in got.rows.collect()}
    assert rows[1] == (1, "x", 1.5) and rows[2] == (2, "two\nlines", None) and rows[5] == (5, None, None)
    assert got.row_count == 5 and got.unread_count == 3
    bad = {r["text"]: r for r in got.quarantine.collect()}
    assert set(bad) == {'2,"two\nlines",bad', "3,y", "4,z,2,extra"}
    assert all(r["file"].endswith("a.csv") and r["split"] == 0 for r in bad.values()) and bad["3,y"]["line"] == 4


def test_an_unclosed_quote_loses_no_text(spark, tmp_path, small_splits):
    lines = [f"{i},text {i},{i}" for i in range(200)]
    (tmp_path / "a.csv").write_text("id,d,v\n" + "\n".join(lines[:50]) + '\n50,"open,1\n' + "\n".join(lines[50:]) + "\n")
    small_splits(400)
    got = records.read_records(spark, str(tmp_path), SCHEMA, max_record=600)
    assert sorted(r["id"] for r in got.rows.collect()) == list(range(50))
    text = "\n".join(r["text"] for r in sorted(got.quarantine.collect(), key=lambda r: (r["split"], r["line"])))
    assert text.split("\n") == ['50,"open,1', *lines[50:]]
    assert got.row_count == 50 and got.unread_count == got.quarantine.count() > 1


def test_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id, d ,v\n1,x,2\n", encoding="utf-8")
    assert [tuple(r) for r in records.read_records(spark, str(tmp_path), SCHEMA).rows.collect()] == [(1, "x", 2.0)]
    (tmp_path / "b.csv").write_text("id,v\n1,2\n")
    with pytest.raises(ValueError, match="the header lacks \\['d'\\]"):
        records.read_records(spark, str(tmp_path), SCHEMA)
    (tmp_path / "b.csv").write_text('id,"d\nd",v\n')
    with pytest.raises(ValueError, match="line break in the header"):
        records.read_records(spark, str(tmp_path), SCHEMA)


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "only-a-header.csv").write_text("id,d,v\n")
    (tmp_path / "blank.csv").write_text("")
    got = records.read_records(spark, str(tmp_path), SCHEMA)
    assert got.rows.collect() == [] and got.quarantine.collect() == [] and got.row_count == 0
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "blank.csv").write_text("")
    assert records.read_records(spark, str(tmp_path / "sub"), SCHEMA).rows.schema == SCHEMA


def test_splits_that_change_are_counted_again(spark, tmp_path, monkeypatch):
    write(tmp_path, "a.csv", ("id", "d", "v"), [{"id": i, "d": "x\ny", "v": 1} for i in range(30)])
    real, calls = records.split_states, []

    def once_wrong(*args):
        calls.append(1)
        states = real(*args)
        return [s for s in states] if len(calls) > 1 else [type(s)(**{**s.asDict(), "split": s["split"] + 7}) for s in states] + states[:0]

    monkeypatch.setattr(records, "split_states", once_wrong)
    monkeypatch.setattr(records, "_layouts", lambda states, schema: {("id", "d", "v"): [states[0]["file_id"]]})
    assert records.read_records(spark, str(tmp_path), SCHEMA).row_count == 30 and len(calls) == 2
