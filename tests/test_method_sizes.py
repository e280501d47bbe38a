"""Wide cleaning projections stay short enough for HotSpot to compile, in a session without the package's settings."""

import re

import pytest

from conftest import SF_SMALL
from ledgerlens.operators import clean, star
from ledgerlens.sources import bindings as B

LONGEST = 8000  # bytes of a method; longer ones run interpreted


@pytest.fixture
def plain_conf(spark):
    """Spark's own limit; the final plan without a first run."""
    wanted = {"spark.sql.codegen.hugeMethodLimit": "65535", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def longest_method(df, capsys) -> int:
    capsys.readouterr()
    df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))


def test_dates_of_a_wide_row_compile(spark, plain_conf, capsys):
    raw = B.schedule(spark, SF_SMALL)
    assert longest_method(raw, capsys) < LONGEST
    assert longest_method(star.fact_schedule(raw), capsys) < LONGEST
    assert longest_method(star.fact_change_orders(B.change_orders(spark, SF_SMALL)), capsys) < LONGEST
    assert longest_method(clean.null_profile(raw, "schedule", date_columns=star.SCHEDULE_DATES), capsys) < LONGEST


def test_dates_of_a_row_are_read_as_one_by_one(spark):
    texts = [" 1996-02-10 ", "02/10/1996", "10-Feb-1996", "02-10-1996", "Feb-1996", "1996-02", "", "n/a", "1996-02-31", None]
    rows = [(i, a, texts[(i * 3 + 1) % len(texts)]) for i, a in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = {r.i: (r.x, r.y) for r in clean.normalize_dates(df, {"a": "x", "b": "y"}).select("i", "x", "y").collect()}
    one = {a: i for i, a, _ in rows}
    assert [got[i][1] for i, _, b in rows] == [got[one[b]][0] for _, _, b in rows]
    assert [str(got[i][0]) for i in range(len(rows))] == ["1996-02-10"] * 4 + ["1996-02-01"] * 2 + ["None"] * 4
    assert clean.normalize_dates(df, []).columns == df.columns
    profile = {(r.column_name, r.metric): r.value for r in
               clean.null_profile(df, "s", date_columns=["a", "b"]).collect()}
    assert profile["a", "unparseable"] == profile["b", "unparseable"] == 2
    assert profile["a", "layout yyyy-MM-dd"] == profile["a", "layout yyyy-MM"] == 1
