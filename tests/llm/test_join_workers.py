"""The n-gram join's tasks hold one Python worker each, and an empty table none."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import ngram_join
from llm import brute


@pytest.fixture(scope="module")
def rows():
    words = [f"w{i}" for i in range(60)]
    near = [(d, " ".join([*words[:40 + d % 3], f"x{d}"])) for d in range(30)]
    return near + [(30 + d, " ".join(words[d:] + words[:d]) + f" own{d} too{d}") for d in range(30)] + [(60, "one"), (61, "")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_links_need_no_worker(spark, rows):
    join = ngram_join.Join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, True)
    assert [f.dataType.simpleString() for f in join.links.schema] == ["bigint", "bigint"]
    assert join.links.columns == ["a", "b"] and "ExistingRDD" not in plan(join.links)


@pytest.mark.parametrize("few", [1 << 13, 0])
def test_one_python_step_a_task(spark, rows, monkeypatch, few):
    plans, whole = [], ngram_join.stage

    def staged(df, name):
        if name == "full-sets":
            plans.append(plan(df))
        return whole(df, name)

    monkeypatch.setattr(ngram_join, "stage", staged)
    monkeypatch.setattr(ngram_join, "FEW", few, raising=False)
    docs = spark.range(len(rows)).select("id").join(spark.createDataFrame(rows, "id long, text string"), "id")
    docs = docs.select(F.col("id").alias("doc_id"), "text")
    got = ngram_join.jaccard_components(docs, 4, 85)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.jaccard(rows, 4, 85))
    assert plans
    for p in plans:  # either one step, or an exchange between the two
        assert p.count("MapInArrow") == 1 or "SortMergeJoin" in p
