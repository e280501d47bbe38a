"""Rules as a table against the rules tried one by one."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from ledgerlens.operators.rule_table import rule_hits, vendor_rule_table
from ledgerlens.operators.vendors import DEFAULT_VENDOR_RULES, vendor_rule_map
from ledgerlens.plans import catalog as C
from ledgerlens.sources import bindings as B

RULES = "pattern string, canonical string, priority long"


def brute(names, rules):
    out = {}
    for name in names:
        hits = [(-(1 << 63) if p is None else p, c) for pattern, c, p in rules
                if name is not None and pattern is not None and c is not None and pattern.upper() in name.upper()]
        out[name] = max(hits)[1] if hits else name
    return out


def got(spark, names, rules):
    df = spark.createDataFrame([(n,) for n in names], "raw string")
    out = vendor_rule_table(df, "raw", spark.createDataFrame(rules, RULES), "clean").collect()
    assert len(out) == len(names)
    return {r["raw"]: r["clean"] for r in out}


def test_awkward_rules_and_names(spark):
    names = ["Ab Electric", "ab", "a", "", None, "xx", "日本建設", "ABAB", "Ab Electric", "é"]
    rules = [("ab", "AB", 1), ("AB E", "ABE", 2), ("ab e", "ABE2", 2), ("a", "A", None), ("本建", "JP", 5), ("zzz", "Z", 9),
             (None, "N", 9), ("x", None, 9), ("abab", "Four", 3), ("É", "E", 0), ("xx", "XX", 4)]
    assert got(spark, names, rules) == brute(names, rules)
    assert got(spark, names, [*rules, ("", "Any", -1)]) == brute(names, [*rules, ("", "Any", -1)])
    assert got(spark, names, []) == {n: n for n in names} and got(spark, [None], rules) == {None: None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abc ", max_size=9), min_size=1, max_size=25),
       st.lists(st.tuples(st.text("abc ", max_size=5), st.sampled_from("PQRS"), st.integers(0, 3)), max_size=15))
def test_random_rules(spark, names, rules):
    assert got(spark, names, rules) == brute(names, rules)


def test_the_coded_rules_as_a_table(spark):
    names = ["turner elec.", "Turner Electric", "SKANSKA-WSP JV", "dpr", "Nobody", "Power Engineers & EMCOR", None]
    rules = [(p, c, i) for i, (p, c) in enumerate(DEFAULT_VENDOR_RULES)]
    chain = vendor_rule_map(spark.createDataFrame([(n,) for n in names], "raw string"), "raw", "clean")
    assert got(spark, names, rules) == {r["raw"]: r["clean"] for r in chain.collect()}


def test_ten_thousand_rules_have_no_chain(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9)))
    rules = [(word(), f"V{i}", i) for i in range(10_000)]
    names = [f"{word()} {rng.choice(rules)[0]} {word()}" for _ in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "raw string")
    out = vendor_rule_table(df, "raw", spark.createDataFrame(rules, RULES), "clean")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CASE" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert {r["raw"]: r["clean"] for r in out.collect()} == brute(names, rules)


def test_a_rule_meets_only_names_with_its_rarest_gram(spark):
    """1000 rules that share a frequent gram: each is compared with the names of its rare one."""
    names = spark.range(1000).selectExpr("concat('common ', id * 7919 % 1000003) as raw_name")
    rules = spark.range(1000).selectExpr("concat('common ', id * 7919 % 1000003) as pattern", "'x' as canonical", "id as priority")
    hits = rule_hits(names, rules)
    join = [line for line in hits._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Contains(up" in line]
    assert len(join) <= 1 and hits.count() == 1000


def test_query_has_thousands_of_rules(spark):
    assert B.account_rules(spark, "/root/testdata/sf0.1").count() > 10_000
    kinds = {(r["account_name"] or "none").split(" ")[0] for r in C.q_vendor_rule_table(spark, SF_SMALL).collect()}
    assert kinds == {"Account", "Block", "none"}


@pytest.mark.parametrize("hot", [300])
def test_repeated_names_are_matched_once(spark, hot):
    df = spark.createDataFrame([("same name",)] * hot + [("other",)], "raw string")
    out = vendor_rule_table(df, "raw", spark.createDataFrame([("same", "S", 1)], RULES), "clean")
    assert out.where("clean = 'S'").count() == hot
