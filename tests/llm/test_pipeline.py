"""The pipeline's stages against brute force, each on its own input, and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from ledgerlens.llm import common, toxicity
from ledgerlens.llm.queries import ORACLE_SQL, QUERIES
from llm import brute
from oracle_harness import compare, duck


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage gets and returns on the smallest input."""
    docs, out = common.table(spark, SF_SMALL, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        after = common.stage(step(spark, docs, SF_SMALL), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stage_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "mixing", "packing"]
    for docs, after in steps[:-1]:
        assert after.columns == docs.columns


def test_toxic_documents_go(spark, steps):
    docs, after = steps[0]
    scores = toxicity.toxicity(docs, common.table(spark, SF_SMALL, "labels"))
    want = docs.join(scores.where("predicted = 0").select("doc_id"), "doc_id")
    assert texts(after) == texts(want)


def test_one_of_equal_texts_stays(steps):
    docs, after = steps[1]
    assert texts(after) == sorted({(k, t) for (_, t), (_, k, _, _) in zip(texts(docs), brute.copies(texts(docs)))})


def test_one_of_near_copies_stays(steps):
    docs, after = steps[2]
    rows = texts(docs)
    assert texts(after) == [r for r, (d, _, c) in zip(rows, brute.jaccard(rows, 5, 80)) if d == c]


def test_mix_repeats_whole_documents(steps):
    docs, after = steps[3]
    before = dict(texts(docs))
    times = {}
    for d, t in texts(after):
        assert before[d] == t
        times[d] = times.get(d, 0) + 1
    assert times and max(times.values()) <= 3


def test_pack_takes_every_copy(steps):
    docs, after = steps[4]
    tokens = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    met = docs.groupBy("doc_id").agg(F.count("*").alias("times")).join(tokens, "doc_id")
    assert met.count() == docs.select("doc_id").distinct().count()
    assert met.where("n <> times * t").count() == 0


def test_run_is_registered(spark, steps):
    assert E.queries()["pipeline"] is corpus_pipeline.run
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == steps[-1][1].columns and got.count() == steps[-1][1].count()
    assert set(QUERIES) < set(E.queries()) and set(ORACLE_SQL) < set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    out = duck(SF_SMALL)
    for name in ("documents", "embeddings"):
        out.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    return out


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    found = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert found["status"] == "MATCH", found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_covers_every_row(spark, name):
    got = QUERIES[name](spark, SF_SMALL)
    assert got.select("doc_id").distinct().count() == common.table(spark, SF_SMALL, "documents").count()


def test_suffix_query_matches_brute_force(spark):
    docs = texts(common.table(spark, SF_SMALL, "documents"))
    got = QUERIES["op5_suffix_dedup"](spark, SF_SMALL)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) \
        == brute.byte_repeats(docs, 50)
