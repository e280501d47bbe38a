"""The stored cube: merged batches equal the whole fact, at the chosen slices, without reading it."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators.cube_store import CubeStore, evm_slices
from ledgerlens.operators.evm import evm_cube
from ledgerlens.plans import catalog as C

DIMS = ["building_id", "wbs_level_1", "wbs_level_2"]
DDL = "b string, w string, x long"


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def small(spark, values):
    return spark.createDataFrame(values, DDL)


def test_batches_give_what_the_whole_fact_gives(spark, tmp_path):
    fact = C.cost_fact(spark, SF_SMALL)
    store = CubeStore(spark, str(tmp_path), DIMS)
    for i in range(3):
        assert store.append(f"part-{i}", fact.where(F.pmod(F.xxhash64("cost_key"), F.lit(3)) == i))
    all_sets = [[d for k, d in enumerate(DIMS) if bits >> k & 1] for bits in range(8)]
    assert rows(evm_slices(store, all_sets)) == rows(evm_cube(fact, DIMS))
    assert store.compact() == 3 and store.compact() == 1
    assert rows(evm_slices(store, all_sets)) == rows(evm_cube(fact, DIMS))


def test_slices_expand_by_the_sets_and_do_not_read_the_fact(spark, tmp_path):
    store = CubeStore(spark, str(tmp_path / "cube"), DIMS)
    store.append("all", C.cost_fact(spark, SF_SMALL))
    out = evm_slices(store, [["building_id"], []])
    assert all(f"{tmp_path}/cube/cells" in f for f in out.inputFiles()) and out.inputFiles()
    plan = out._jdf.queryExecution().executedPlan().toString()
    expand = [line for line in plan.splitlines() if "Expand [" in line]
    # one projection per set (each ends with its grouping id), where a cube would have eight
    assert len(expand) == 1 and expand[0].split("], [building_id")[0].count("[[") == 1
    assert expand[0].count(", 3]") == 1 and expand[0].count(", 7]") == 1
    assert {r["grouping_level"] for r in out.collect()} == {3, 7}


def test_a_batch_counts_once(spark, tmp_path):
    store = CubeStore(spark, str(tmp_path), ["b", "w"], ["x"])
    one = small(spark, [("p", "1", 5), ("p", None, 7), (None, None, None)])
    assert store.append("monday", one) and not store.append("monday", one)
    store._add(store._signed(one, 1), ["monday"])  # a retry that passed the look at the log
    assert store.batches() == ["monday"]
    assert rows(store.cells()) == rows(spark.createDataFrame(
        [("p", "1", 1, 5), ("p", None, 1, 7), (None, None, 1, None)], "b string, w string, row_count long, x long"))


def test_rows_taken_back(spark, tmp_path):
    store = CubeStore(spark, str(tmp_path), ["b", "w"], ["x"])
    store.append("first", small(spark, [("p", "1", 5), ("p", "1", None), ("q", "1", 3)]))
    store.append("second", small(spark, [("q", "2", 3)]), taken_back=small(spark, [("p", "1", 5), ("q", "1", 3)]))
    want = [("p", "1", 1, None), ("q", "2", 1, 3)]  # a sum whose known values are all gone is null, not 0
    for _ in range(2):
        assert rows(store.cells()) == rows(spark.createDataFrame(want, "b string, w string, row_count long, x long"))
        store.compact()


def test_compactions_that_meet_lose_nothing(spark, tmp_path):
    store = CubeStore(spark, str(tmp_path), ["b"], ["x"])
    for i in range(3):
        store.append(str(i), small(spark, [("p", "1", 10 ** i)]))
    lines = store._lines()
    store._add(store._cells(lines[:2]), [b for line in lines[:2] for b in line["batches"]])
    store._add(store._cells(lines[1:]), [b for line in lines[1:] for b in line["batches"]])
    store.append("3", small(spark, [("p", "1", 1000)]))
    for _ in range(2):
        assert [r["x"] for r in store.cells().collect()] == [1111] and store.batches() == ["0", "1", "2", "3"]
        store.compact()


def test_empty_batches_and_mistakes(spark, tmp_path):
    store = CubeStore(spark, str(tmp_path), ["b", "w"], ["x"])
    with pytest.raises(LookupError):
        store.cells()
    store.append("none", small(spark, []))
    assert store.cells().count() == 0
    assert [r["row_count"] for r in store.slices([[]]).collect()] in ([], [None])
    for sets in ([], [["z"]], [["b", "w"], ["w", "b"]]):
        with pytest.raises(ValueError):
            store.slices(sets)
    with pytest.raises(ValueError):
        CubeStore(spark, str(tmp_path), ["x"], ["x"])
