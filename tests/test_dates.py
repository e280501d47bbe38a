"""Hand-made rows for date / period cleaning, sentinel and approval lag."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.operators import clean, reports


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_each_layout_and_junk(spark):
    vals = ["2024-03-07", "03/07/2024", "07-Mar-2024", "03-07-2024", "Mar-2024", "2024-03",
            "07-MAR-2024", "  2024-03-07 ", "", None, "13/45/2025", "2025-1-5", "05-12-2024", "n/a"]
    got = _one(spark, vals, D.normalize_date)
    d = dt.date
    assert got == [d(2024, 3, 7), d(2024, 3, 7), d(2024, 3, 7), d(2024, 3, 7), d(2024, 3, 1), d(2024, 3, 1),
                   d(2024, 3, 7), d(2024, 3, 7), None, None, None, None, d(2024, 5, 12), None]


def test_periods(spark):
    got = _one(spark, ["2023-06", "Jun-2023", "June 2023", "JUNE 2023", "bad"], D.period_label)
    assert got == ["2023-06", "2023-06", "2023-06", "2023-06", None]


@settings(max_examples=200, deadline=None)
@given(st.dates(min_value=dt.date(1000, 1, 1), max_value=dt.date(9999, 12, 31)))
def test_guard_accepts_every_rendered_layout(day):
    render = {
        "yyyy-MM-dd": day.strftime("%Y-%m-%d"), "MM/dd/yyyy": day.strftime("%m/%d/%Y"),
        "dd-MMM-yyyy": day.strftime("%d-%b-%Y"), "MM-dd-yyyy": day.strftime("%m-%d-%Y"),
        "MMM-yyyy": day.strftime("%b-%Y"), "yyyy-MM": day.strftime("%Y-%m"), "MMMM yyyy": day.strftime("%B %Y"),
    }
    for layout, text in render.items():
        assert re.match(D.layout_guard(layout), text), (layout, text)


def test_sentinel_and_lag_buckets(spark):
    rows = [
        ("a", "2024-01-10", "2024-01-09", "Approved"),  # -1: no bucket
        ("b", "2024-01-10", "2024-01-10", "Approved"),  # 0
        ("c", "2024-01-10", "2024-01-25", "Approved"),  # 15
        ("d", "2024-01-10", "2024-01-26", "Approved"),  # 16
        ("e", "2024-01-10", "2024-02-09", "Approved"),  # 30
        ("f", "2024-01-10", "2024-02-10", "Approved"),  # 31
        ("g", "2024-01-10", None, "Pending"),           # sentinel, null lag
        ("h", "junk", "2024-02-10", "Approved"),        # unparsed submitted -> null lag
    ]
    raw = spark.createDataFrame(rows, "change_order_id string, submitted_date string, approved_date string, status string")
    out = clean.approval_dates(raw)
    got = {r.change_order_id: (r.approved_date, r.co_approval_lag_days) for r in out.collect()}
    assert got["g"] == (dt.date(9999, 12, 31), None)
    assert [got[k][1] for k in "abcdefh"] == [-1, 0, 15, 16, 30, 31, None]
    facts = out.withColumns({"building_id": F.lit("B"), "cost_impact": F.lit(1.0)})
    aging = {r.status: r for r in reports.change_order_aging(facts).collect()}
    a = aging["Approved"]
    assert (a.co_count, a.bucket_0_15_days, a.bucket_16_30_days, a.bucket_30_plus_days) == (7, 2, 2, 1)
    assert aging["Pending"].bucket_0_15_days == 0 and aging["Pending"].avg_approval_lag is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2099, 12, 31)), min_size=1, max_size=40))
def test_every_layout_round_trips(spark, days):
    fmts = ["%Y-%m-%d", "%m/%d/%Y", "%d-%b-%Y", "%m-%d-%Y"]
    rows = [(i, d.strftime(fmts[i % 4])) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "i int, s string")
    got = {r.i: r.d for r in df.select("i", D.normalize_date("s").alias("d")).collect()}
    assert got == dict(enumerate(days))


def test_fixed_width_reading_equals_the_formatter(spark):
    """Texts of every shape, valid and not: rearranged ISO text against guarded ``try_to_date``."""
    import random

    rng, texts = random.Random(3), []
    for _ in range(8000):
        y = rng.choice(["0000", "0001", "99", "12345", "-200", "+202", "202a"]) if rng.random() < .3 else str(rng.randint(1900, 2100))
        m = rng.choice(["00", "13", "1", "ab", "+1", " 1"]) if rng.random() < .2 else f"{rng.randint(1, 12):02d}"
        d = rng.choice(["00", "31", "30", "29", "32", "5", "1e"]) if rng.random() < .4 else f"{rng.randint(1, 28):02d}"
        n = rng.choice(["Jan", "FEB", "mar", "April", "May", "june", "Sep", "Sept", "anF", "xyz", "Dec", "August"])
        shape = rng.choice(["{y}-{m}-{d}", "{m}/{d}/{y}", "{d}-{n}-{y}", "{m}-{d}-{y}", "{n}-{y}", "{y}-{m}", "{n} {y}",
                            " {y}-{m}-{d} ", "{y}/{m}/{d}", "{y}-{m}-{d}T00"])
        texts.append((shape.format(y=y, m=m, d=d, n=n),))
    df = spark.createDataFrame(texts, "t string")
    t = F.trim("t")
    for layouts in (D.DATE_LAYOUTS, D.PERIOD_LAYOUTS):
        plain = [F.when(t.rlike(D.layout_guard(f)), F.try_to_date(t, f)) for f in layouts]
        index = F.coalesce(*[F.when(p.isNotNull(), F.lit(i)) for i, p in enumerate(plain)])
        both = df.select("t", F.coalesce(*plain).alias("a"), D.normalize_date("t", layouts).alias("b"), index.alias("i"),
                         D.layout_index("t", layouts).alias("j"))
        assert both.where("not (a <=> b and i <=> j)").count() == 0 and both.where("a is not null").count() > 500
