"""What the join's driver holds stays small: plans, rounds and collected tables."""

import pytest

from ledgerlens.llm import common, ngram_join
from llm import brute


@pytest.fixture
def staged(monkeypatch):
    """(name, plan) of every staged table."""
    seen, whole = [], common.stage

    def stage(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return whole(df, name)

    monkeypatch.setattr(common, "stage", stage)
    monkeypatch.setattr(ngram_join, "stage", stage)
    return seen


def test_a_round_names_its_input_four_times(spark, staged):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    got = dict(common.components(edges, "t").collect())
    assert got == {i: 0 for i in range(41)}
    assert len(staged) > 2
    for _, plan in staged[1:]:
        assert 0 < plan.count("FileScan") <= 4


def test_stars_need_no_round(spark, staged):
    edges = [(1, i) for i in range(2, 20)] + [(40, 30), (50, 50), (None, 7)]
    got = dict(common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect())
    assert got == {**{i: 1 for i in range(1, 20)}, 30: 30, 40: 30}
    assert len(staged) == 1


@pytest.mark.parametrize("few", [1 << 13, 0])
def test_tables_are_collected_as_arrow(spark, monkeypatch, few):
    def no(*a, **b):
        raise AssertionError("rows become objects in the driver")

    rows = [(d, " ".join(f"w{i + d // 20}" for i in range(60)) + f" x{d % 7}") for d in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(type(docs), "toPandas", no)
    monkeypatch.setattr(ngram_join, "FEW", few)
    got = ngram_join.jaccard_components(docs, 4, 85)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.jaccard(rows, 4, 85))
