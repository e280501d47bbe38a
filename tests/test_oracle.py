"""Differential test: every registered query vs its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.oracle import ORACLE_SQL
from conftest import SF_SMALL
from oracle_harness import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert r["status"] == "MATCH", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["building_id", "cpi", "spi"]


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.mark.parametrize("key", KEYS)
def test_query_types_match_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(E.oracle_sql()[key])
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert s_types == d_types
