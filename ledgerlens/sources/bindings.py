"""Bind the driver's TPC-H-style tables to the four raw export shapes.

These are the test inputs: each binding reads the real tables (so its work
grows with them), derives the columns of one export and then *dirties*
them the way the real exports are dirty (four date layouts, blanks, junk,
vendor spelling variants, two period layouts).  The oracle SQL builds the
same rows from the clean values, so it never re-implements the cleaners.

Money is bound as bigint cents so sums are exact in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Fixed values for the test bindings (invented names, not real vendors).
CANONICAL_VENDORS: tuple[str, ...] = (
    "Northwind Electric Co.",
    "Harbor Steel Works",
    "Granite Civil Group",
    "Bluefield Mechanical",
    "Summit Concrete Inc.",
    "Summit Mechanical LLC",
    "Redline Fire Protection",
    "Cedar Glass Systems",
    "Ironbridge Structural",
    "Lakeshore Plumbing",
    "Meridian Controls",
    "Copperline Data Systems",
)

# Five spellings per canonical vendor, in canonical order: as is, upper case,
# abbreviated or split, tokens swapped, suffix changed.
VENDOR_VARIANTS: tuple[tuple[str, ...], ...] = (
    ("Northwind Electric Co.", "NORTHWIND ELECTRIC CO.", "Northwind Elec.", "Electric Co. Northwind", "Northwind Electric Company"),
    ("Harbor Steel Works", "HARBOR STEEL WORKS", "Harbour Steel Works", "Steel Works Harbor", "H.S.W."),
    ("Granite Civil Group", "GRANITE CIVIL GROUP", "Granite-Civil Group", "Civil Group, Granite", "Granite Civil Grp"),
    ("Bluefield Mechanical", "BLUEFIELD MECHANICAL", "Blue Field Mechanical", "Mechanical Bluefield", "Bluefield Mech. Inc"),
    ("Summit Concrete Inc.", "SUMMIT CONCRETE INC.", "Summit Concrete", "Concrete Inc. Summit", "Summit Concrete Incorporated"),
    ("Summit Mechanical LLC", "SUMMIT MECHANICAL LLC", "Summit Mech.", "Mechanical LLC Summit", "Summit Mechanical"),
    ("Redline Fire Protection", "REDLINE FIRE PROTECTION", "Red Line Fire Protection", "Fire Protection Redline", "R.F.P."),
    ("Cedar Glass Systems", "CEDAR GLASS SYSTEMS", "Cedar Glas Systems", "Glass Systems Cedar", "Cedar Glass Sys."),
    ("Ironbridge Structural", "IRONBRIDGE STRUCTURAL", "Iron Bridge Structural", "Structural Ironbridge", "Ironbridge Structural Ltd"),
    ("Lakeshore Plumbing", "LAKESHORE PLUMBING", "Läke Shore Plümbing", "Plumbing Lakeshore", "Lakeshore Plumbing & Heating"),
    ("Meridian Controls", "MERIDIAN CONTROLS", "Meridian Ctrls", "Controls Meridian", "Meridian Controls Inc"),
    ("Copperline Data Systems", "COPPERLINE DATA SYSTEMS", "Copper Line Data Systems", "Data Systems Copperline", "東京建設"),
)

# Substring rules for the invented vendors (upper-case pattern, canonical);
# a later rule outranks an earlier one.
BINDING_VENDOR_RULES: tuple[tuple[str, str], ...] = (
    ("NORTHWIND", "Northwind Electric Co."),
    ("HARBOR STEEL", "Harbor Steel Works"),
    ("GRANITE CIVIL", "Granite Civil Group"),
    ("BLUEFIELD", "Bluefield Mechanical"),
    ("SUMMIT", "Summit Concrete Inc."),
    ("SUMMIT MECH", "Summit Mechanical LLC"),
    ("MECHANICAL LLC SUMMIT", "Summit Mechanical LLC"),
    ("H.S.W.", "Harbor Steel Works"),
    ("IRON BRIDGE", "Ironbridge Structural"),
    ("RED LINE", "Redline Fire Protection"),
    ("R.F.P.", "Redline Fire Protection"),
    ("REDLINE", "Redline Fire Protection"),
    ("CEDAR GLASS", "Cedar Glass Systems"),
    ("IRONBRIDGE", "Ironbridge Structural"),
    ("LAKESHORE", "Lakeshore Plumbing"),
    ("MERIDIAN", "Meridian Controls"),
    ("COPPERLINE", "Copperline Data Systems"),
)

# Pay-application contractors are the first nine vendors, one trade each.
CONTRACTOR_TRADES: tuple[str, ...] = (
    "Electrical", "Structural Steel", "Sitework", "Mechanical", "Concrete",
    "Mechanical", "Fire Protection", "Glazing", "Structural Steel",
)

CO_PARTIES: tuple[str, ...] = ("Owner", "Contractor", "Design Team", "Site Conditions", "Authority")

PAY_STATUSES: tuple[str, ...] = ("Certified", "Submitted", "Under Review", "Disputed")

N_VENDORS = len(CANONICAL_VENDORS)
N_CONTRACTORS = len(CONTRACTOR_TRADES)

# Residues that blank or corrupt a raw date text (exercise null handling).
BLANK_MOD, JUNK_MOD, JUNK_TEXT = 97, 89, "n/a"
# Decided change orders whose decision date text is corrupted (become sentinel).
APPROVED_JUNK_MOD = 83
# Cost rows whose variance is blank, and rows with no vendor at all.
VARIANCE_BLANK_MOD, VENDOR_NULL_MOD = 16, 53
# Period label: one row in PERIOD_ALT_MOD uses the alternative layout.
PERIOD_ALT_MOD = 5
PAY_PERIOD_ALT = 3  # sequence % 10 < 3 -> 'MMMM yyyy'
# Pay applications whose reported retainage is off by RETAINAGE_ERROR cents.
RETAINAGE_BREAK_MOD, RETAINAGE_ERROR = 23, 100
# Rows without a building id (cost ledger, change orders), orders of a status
# that no report lists, and orders without a status.
COST_NO_BUILDING_MOD, CO_NO_BUILDING_MOD, VOID_MOD, NO_STATUS_MOD = 43, 41, 31, 37
# Ship months whose cost period text is junk in even years (so those months are
# missing), and pay sequences whose period text is junk or whose amounts are blank.
JUNK_PERIOD_MONTH, PAY_JUNK_PERIOD_MOD, HELD_NULL_MOD, NET_NULL_MOD = 7, 13, 29, 31


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(col: Column) -> Column:
    return F.round(col * F.lit(100.0)).cast("bigint")


def pick(values: tuple[str, ...], index: Column) -> Column:
    """``values[index]`` for a 0-based Column index, as a literal array lookup."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + F.lit(1)).cast("int"))


def vendor_variant(vendor_idx: Column, variant_idx: Column) -> Column:
    flat = tuple(v for row in VENDOR_VARIANTS for v in row)
    return pick(flat, vendor_idx * F.lit(5) + variant_idx)


def building_of(key: Column) -> Column:
    return F.concat(F.lit("BLD-"), key.cast("string"))


def dirty_date(d: Column, key: Column, shift: int | Column = 0) -> Column:
    """A DATE rendered in one of four layouts chosen by ``key``; some blank or junk."""
    layout = (key + F.lit(shift)) % 4
    text = (
        F.when(layout == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(layout == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(layout == 2, F.date_format(d, "dd-MMM-yyyy"))
        .otherwise(F.date_format(d, "MM-dd-yyyy"))
    )
    return (
        F.when(key % BLANK_MOD == 0, F.lit(None).cast("string"))
        .when(key % JUNK_MOD == 0, F.lit(JUNK_TEXT))
        .otherwise(text)
    )


# nation and region have a fixed size at every scale factor (25 and 5 rows), a
# proven bound, so they are broadcast without a counting job.
FIXED_SIZE_TABLES = ("nation", "region")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return F.broadcast(geo.select("n_nationkey", "r_regionkey"))


def cost_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost-ledger export: one row per lineitem, vendor and period dirtied."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate",
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
        .join(_geo(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    key = F.col("l_orderkey")
    q = F.col("l_quantity").cast("int")
    dp = F.round(F.col("l_discount") * F.lit(100.0)).cast("int")
    ln = F.col("l_linenumber")
    budget = F.col("approved_budget")

    def share(p: Column) -> Column:
        return F.floor(budget * p / F.lit(100.0)).cast("bigint")

    ship = F.col("l_shipdate").cast("date")
    staged = rows.select(
        (key * F.lit(10) + ln).alias("cost_key"),
        F.concat_ws(".", F.col("p_type"), F.col("p_brand")).alias("cost_code"),
        F.col("p_type").alias("wbs_level_1"),
        F.col("p_brand").alias("wbs_level_2"),
        F.when(key % VENDOR_NULL_MOD == 0, F.lit(None).cast("string"))
        .otherwise(vendor_variant(F.col("l_suppkey") % N_VENDORS, ln % 5))
        .alias("vendor_name"),
        cents(F.col("l_extendedprice")).alias("approved_budget"),
        q.alias("_q"), dp.alias("_dp"), ln.alias("_ln"), key.alias("_key"),
        F.when((F.month(ship) == JUNK_PERIOD_MONTH) & (F.year(ship) % 2 == 0), F.lit(JUNK_TEXT))
        .when(key % PERIOD_ALT_MOD == 0, F.date_format(ship, "MMM-yyyy"))
        .otherwise(F.date_format(ship, "yyyy-MM"))
        .alias("period_month"),
        F.when(key % COST_NO_BUILDING_MOD != 0, building_of(F.col("r_regionkey"))).alias("building_id"),
    )
    q, dp, ln, key = F.col("_q"), F.col("_dp"), F.col("_ln"), F.col("_key")
    forecast = share(F.lit(96) + dp)
    return staged.select(
        "cost_key", "cost_code", "wbs_level_1", "wbs_level_2", "vendor_name",
        share(F.lit(95)).alias("contract_value"),
        "approved_budget",
        share(F.lit(90) + dp).alias("committed_cost"),
        F.when(q < 3, F.lit(0).cast("bigint")).otherwise(share(F.lit(38) + q + dp)).alias("actual_cost_to_date"),
        forecast.alias("forecasted_final_cost"),
        F.when(key % VARIANCE_BLANK_MOD == 0, F.lit(None).cast("bigint"))
        .otherwise(budget - forecast)
        .alias("variance"),
        share(F.lit(40) + q).alias("earned_value"),
        share(F.lit(36) + q + ln).alias("planned_value"),
        ((F.lit(40) + q) / F.lit(100.0)).alias("percent_complete_actual"),
        ((F.lit(36) + q + ln) / F.lit(100.0)).alias("percent_complete_baseline"),
        "period_month",
        "building_id",
    )


def _co_status(key: Column, status: Column) -> Column:
    return (
        F.when(key % VOID_MOD == 0, F.lit("Void"))
        .when(key % NO_STATUS_MOD == 0, F.lit(None).cast("string"))
        .when(status == "F", F.lit("Approved"))
        .when((status == "P") & (key % 3 == 0), F.lit("Rejected"))
        .when(key % 2 == 0, F.lit("Pending"))
        .otherwise(F.lit("Under Review"))
    )


def change_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-order log: one row per order; dates in four layouts, pending undated."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    key = F.col("o_orderkey")
    status = _co_status(key, F.col("o_orderstatus"))
    submitted = F.col("o_orderdate").cast("date")
    decided = F.date_add(submitted, ((key * F.lit(13)) % 54 - F.lit(2)).cast("int"))
    open_ = status.isin("Pending", "Under Review")
    approved_text = (
        F.when(open_, F.lit(None).cast("string"))
        .when(key % APPROVED_JUNK_MOD == 0, F.lit(JUNK_TEXT))
        .otherwise(dirty_date(decided, key, shift=1))
    )
    return o.select(
        F.concat(F.lit("CO-"), key.cast("string")).alias("change_order_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("OCO"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("COR"))
        .otherwise(F.lit("PCO"))
        .alias("co_type"),
        F.concat(F.lit('Scope "change", order '), key.cast("string"), F.lit(', "left"')).alias("description"),
        dirty_date(submitted, key).alias("submitted_date"),
        approved_text.alias("approved_date"),
        status.alias("status"),
        ((cents(F.col("o_totalprice")) - F.lit(5_000_000)).cast("double") / F.lit(100.0)).alias("cost_impact"),
        (key % 46).cast("int").alias("schedule_impact_days"),
        pick(CO_PARTIES, key % len(CO_PARTIES)).alias("responsible_party"),
        F.when(key % CO_NO_BUILDING_MOD != 0, building_of(F.col("o_custkey") % 5)).alias("building_id"),
        F.concat(F.col("o_orderpriority"), F.lit("."), (F.col("o_custkey") % 10).cast("string")).alias("wbs_code"),
        F.col("o_orderpriority").alias("wbs_level_1"),
    )


# Orders whose description has line breaks, and whose amount is no number.
CO_BREAK_MOD, CO_BAD_AMOUNT_MOD = 3, 61


def change_orders_with_breaks(spark: SparkSession, sf_dir: str, bad_amounts: bool = False) -> DataFrame:
    """The change-order log with line breaks (both kinds) between quotes in its descriptions;
    amounts as text, some of them junk where ``bad_amounts``."""
    out = change_orders(spark, sf_dir)
    key = F.substring("change_order_id", 4, 20).cast("bigint")
    broken = F.concat(F.col("description"), F.lit(",\nrevised\r\n"), key.cast("string"), F.lit(' "times"\n\nend'))
    out = out.withColumn("description", F.when(key % CO_BREAK_MOD == 0, broken).otherwise(F.col("description")))
    if bad_amounts:
        out = out.withColumn("cost_impact", F.when(key % CO_BAD_AMOUNT_MOD == 0, F.lit(JUNK_TEXT))
                             .otherwise(F.col("cost_impact").cast("string")))
    return out


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule export: one activity per lineitem, four dirty date columns."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                                 "o_orderpriority")
    # two flags travel to the orders instead of two texts
    finished = F.col("l_linestatus") == "F"
    li = li.withColumns({"_finished": finished, "_started": finished | (F.col("l_returnflag") == "A")}).drop(
        "l_linestatus", "l_returnflag")
    rows = li.join(o, li.l_orderkey == o.o_orderkey)
    key, ln = F.col("l_orderkey"), F.col("l_linenumber")
    q = F.col("l_quantity").cast("int")
    start = F.col("o_orderdate").cast("date")
    finished, started = F.col("_finished"), F.col("_started")
    act_start = F.when(started, F.date_add(start, (ln - F.lit(1)).cast("int")))
    act_finish = F.when(finished, F.col("l_shipdate").cast("date"))
    row_key = key * F.lit(8) + ln
    float_days = ln * F.lit(5) - F.lit(10)
    # one lambda for the four dates: four copies of it are too long a method for the JVM to compile
    dates = F.array(start, F.date_add(start, q), act_start, act_finish)
    rows = rows.withColumn("_texts", F.transform(dates, lambda d, i: dirty_date(d, row_key, i)))
    text = F.col("_texts")
    return rows.select(
        F.concat(F.lit("ACT-"), key.cast("string"), F.lit("-"), ln.cast("string")).alias("activity_id"),
        F.concat(F.lit("Activity "), ln.cast("string")).alias("activity_name"),
        building_of(F.col("o_custkey") % 5).alias("building_id"),
        F.col("o_orderpriority").alias("wbs_level_1"),
        F.concat(F.col("o_orderpriority"), F.lit("."), (F.col("o_custkey") % 10).cast("string")).alias("wbs_code"),
        F.when(row_key % BLANK_MOD == 0, F.date_format(start, "yyyy-MM-dd"))
        .otherwise(text[0]).alias("planned_start"),
        F.when(row_key % BLANK_MOD == 0, F.date_format(F.date_add(start, q), "yyyy-MM-dd"))
        .otherwise(text[1]).alias("planned_finish"),
        F.when(started, text[2]).alias("actual_start"),
        F.when(finished, text[3]).alias("actual_finish"),
        q.alias("baseline_duration"),
        F.when(finished, F.datediff(act_finish, act_start))
        .when(started, ln * F.lit(3))
        .cast("int")
        .alias("actual_duration"),
        F.when(finished, F.lit(1.0)).when(started, F.col("l_quantity") / F.lit(100.0))
        .otherwise(F.lit(0.0)).alias("percent_complete"),
        float_days.cast("int").alias("total_float_days"),
        F.when(float_days <= 0, F.lit("Y")).otherwise(F.lit("N")).alias("critical_path_flag"),
    )


PAY_EPOCH = "1995-01-01"


def pay_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay-application register: building x contractor x month, cumulative money.

    Lineitems are first aggregated to the (building, contractor, month) grain
    (partial aggregation, so a hot building never reaches one task whole);
    the running totals are windows over that small grain.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_shipdate")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    rows = li.join(supp, li.l_suppkey == supp.s_suppkey).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    monthly = rows.groupBy(
        F.col("n_regionkey").alias("region"),
        (F.col("l_suppkey") % N_CONTRACTORS).cast("int").alias("contractor"),
        month.alias("month"),
    ).agg(F.sum(cents(F.col("l_extendedprice"))).alias("this_period"))

    per = Window.partitionBy("region", "contractor")
    running = per.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seq = (F.months_between(F.col("month"), F.lit(PAY_EPOCH).cast("date")).cast("int") + F.lit(1))
    staged = monthly.select(
        "region", "contractor", "month", "this_period",
        seq.alias("seq"),
        F.sum("this_period").over(running).alias("to_date"),
        F.sum("this_period").over(per).alias("scheduled"),
    )
    stored = F.floor(F.col("this_period") / F.lit(20.0)).cast("bigint")
    earned = F.col("to_date") + stored
    pct = F.when(F.col("contractor") % 4 == 0, F.lit(5.0)).otherwise(F.lit(10.0))
    held = F.round(earned * pct / F.lit(100.0)).cast("bigint")
    seq = F.col("seq")
    return staged.select(
        F.concat_ws("-", F.lit("PA"), F.col("region").cast("string"), F.col("contractor").cast("string"),
                    seq.cast("string")).alias("pay_app_id"),
        F.when(seq % PAY_JUNK_PERIOD_MOD == 0, F.lit(JUNK_TEXT))
        .when(seq % 10 < PAY_PERIOD_ALT, F.date_format("month", "MMMM yyyy"))
        .otherwise(F.date_format("month", "yyyy-MM")).alias("period"),
        seq.alias("period_sequence"),
        building_of(F.col("region")).alias("building_id"),
        vendor_variant(F.col("contractor"), seq % 5).alias("contractor_name"),
        pick(CONTRACTOR_TRADES, F.col("contractor")).alias("trade"),
        F.col("scheduled").alias("scheduled_value"),
        F.col("this_period").alias("work_completed_this_period"),
        F.col("to_date").alias("work_completed_to_date"),
        stored.alias("stored_materials"),
        earned.alias("total_earned"),
        pct.alias("retainage_pct"),
        F.when((seq * F.lit(5) + F.col("contractor")) % HELD_NULL_MOD != 0,
               held + F.when((seq * F.lit(7) + F.col("contractor")) % RETAINAGE_BREAK_MOD == 0, F.lit(RETAINAGE_ERROR))
               .otherwise(F.lit(0))).alias("retainage_held"),
        F.when((seq * F.lit(11) + F.col("contractor")) % NET_NULL_MOD != 0, earned - held).alias("net_payment_due"),
        pick(PAY_STATUSES, seq % 4).alias("pay_app_status"),
    )


# Orders whose account text is misspelt (only a block rule applies), or has no account at all.
TYPO_MOD, NO_ACCOUNT_MOD = 7, 29


def account_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per customer (its name) and, ranked below, one per block of ten (the name without its last digit)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    block = F.floor(F.col("c_custkey") / F.lit(10)).cast("string")
    own = c.select(F.col("c_name").alias("pattern"), F.concat(F.lit("Account "), F.col("c_custkey").cast("string")).alias("canonical"),
                   (F.col("c_custkey") + F.lit(1_000_000_000)).alias("priority"))
    blocks = c.select(F.upper(F.expr("left(c_name, length(c_name) - 1)")).alias("pattern"),
                      F.concat(F.lit("Block "), block).alias("canonical"), F.lit(1).cast("bigint").alias("priority"))
    return own.unionByName(blocks.distinct())


def account_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account as somebody typed it on each order: case and surroundings vary."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    key, number = F.col("o_orderkey"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    name = F.concat(F.lit("Customer#"), F.when(key % TYPO_MOD == 0, F.concat(F.expr("left(lpad(cast(o_custkey as string), 9, '0'), 8)"),
                                                                             F.lit("x"))).otherwise(number))
    text = F.when(key % 3 == 0, F.lower(name)).when(key % 3 == 1, F.concat(F.lit("c/o "), name, F.lit(" (site office)"))).otherwise(name)
    return o.select("o_orderkey", F.when(key % NO_ACCOUNT_MOD != 0, text).alias("account_raw"))


BINDINGS = {
    "cost_ledger": cost_ledger,
    "change_orders": change_orders,
    "schedule": schedule,
    "pay_applications": pay_applications,
}
