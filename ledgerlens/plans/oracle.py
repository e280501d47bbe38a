"""Independent DuckDB SQL for every registered query.

The oracle builds the bound rows from the *clean* values (true dates, true
canonical names) and the dirtying residues, never from the dirty text, so
it does not re-implement the cleaners.  It runs on the driver's views
(``lineitem``, ``orders``, ...).  Types are cast to what Spark returns:
DuckDB sums are HUGEINT, ``datediff``/``year`` are BIGINT, ``/`` on
integers is double, and ``x / 0`` is inf rather than an error (``NULLIF``).
"""

from __future__ import annotations

from ..functions.dates import SENTINEL_DATE
from ..operators.evm import DEFAULT_CPI_GREEN, DEFAULT_CPI_RED
from ..operators.vendors import DEFAULT_FUZZY_THRESHOLD
from ..sources import bindings as B
from . import catalog as C


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _rule_case(expr: str, rules) -> str:
    whens = " ".join(f"WHEN contains(upper({expr}), {_q(p)}) THEN {_q(c)}" for p, c in reversed(list(rules)))
    return f"CASE {whens} ELSE {expr} END"


def _rule_hit(expr: str, rules) -> str:
    return "(" + " OR ".join(f"contains(upper({expr}), {_q(p)})" for p, _ in rules) + ")"


def _dirty_date(d: str, k: str, shift: int = 0) -> str:
    layout = f"(({k}) + {shift}) % 4"
    return (
        f"CASE WHEN ({k}) % {B.BLANK_MOD} = 0 THEN NULL WHEN ({k}) % {B.JUNK_MOD} = 0 THEN {_q(B.JUNK_TEXT)} "
        f"WHEN {layout} = 0 THEN strftime({d}, '%Y-%m-%d') WHEN {layout} = 1 THEN strftime({d}, '%m/%d/%Y') "
        f"WHEN {layout} = 2 THEN strftime({d}, '%d-%b-%Y') ELSE strftime({d}, '%m-%d-%Y') END"
    )


def _clean_date(d: str, k: str) -> str:
    """The date a dirtied text parses back to: null on the blank / junk residues."""
    return f"CASE WHEN ({k}) % {B.BLANK_MOD} = 0 OR ({k}) % {B.JUNK_MOD} = 0 THEN NULL ELSE {d} END"


VARIANTS = _list([v for row in B.VENDOR_VARIANTS for v in row])
RULES = B.BINDING_VENDOR_RULES
SENT = f"DATE '{SENTINEL_DATE}'"
D100 = "CAST(100 AS DOUBLE)"

# ---------------------------------------------------------------- bindings

COST_BASE = f"""
cost_base AS (
  SELECT l_orderkey AS okey, l_linenumber AS ln,
         l_orderkey * 10 + l_linenumber AS cost_key,
         p_type || '.' || p_brand AS cost_code, p_type AS wbs_level_1, p_brand AS wbs_level_2,
         CASE WHEN l_orderkey % {B.VENDOR_NULL_MOD} = 0 THEN NULL
              ELSE {VARIANTS}[(l_suppkey % {B.N_VENDORS}) * 5 + l_linenumber % 5 + 1] END AS vendor_raw,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS approved_budget,
         CAST(l_quantity AS INTEGER) AS q,
         CAST(round(l_discount * 100) AS INTEGER) AS dp,
         CAST(l_shipdate AS DATE) AS ship,
         CASE WHEN l_orderkey % {B.COST_NO_BUILDING_MOD} <> 0 THEN 'BLD-' || CAST(r_regionkey AS VARCHAR) END AS building_id
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
cost_raw AS (
  SELECT cost_key, cost_code, wbs_level_1, wbs_level_2, vendor_raw AS vendor_name,
         CAST(floor(approved_budget * 95 / {D100}) AS BIGINT) AS contract_value,
         approved_budget,
         CAST(floor(approved_budget * (90 + dp) / {D100}) AS BIGINT) AS committed_cost,
         CASE WHEN q < 3 THEN CAST(0 AS BIGINT)
              ELSE CAST(floor(approved_budget * (38 + q + dp) / {D100}) AS BIGINT) END AS actual_cost_to_date,
         CAST(floor(approved_budget * (96 + dp) / {D100}) AS BIGINT) AS forecasted_final_cost,
         CASE WHEN okey % {B.VARIANCE_BLANK_MOD} = 0 THEN NULL
              ELSE approved_budget - CAST(floor(approved_budget * (96 + dp) / {D100}) AS BIGINT) END AS variance,
         CAST(floor(approved_budget * (40 + q) / {D100}) AS BIGINT) AS earned_value,
         CAST(floor(approved_budget * (36 + q + ln) / {D100}) AS BIGINT) AS planned_value,
         (40 + q) / {D100} AS percent_complete_actual,
         (36 + q + ln) / {D100} AS percent_complete_baseline,
         CASE WHEN month(ship) = {B.JUNK_PERIOD_MONTH} AND year(ship) % 2 = 0 THEN NULL
              ELSE date_trunc('month', ship)::DATE END AS period_start,
         building_id, okey
  FROM cost_base
),
cost_fact AS (
  SELECT cost_key, building_id, cost_code, wbs_level_1, wbs_level_2,
         {_rule_case('vendor_name', RULES)} AS vendor_name,
         contract_value, approved_budget, committed_cost, actual_cost_to_date, forecasted_final_cost,
         coalesce(variance, approved_budget - forecasted_final_cost) AS variance,
         earned_value, planned_value, percent_complete_actual, percent_complete_baseline,
         CASE WHEN actual_cost_to_date > 0 THEN round(earned_value / actual_cost_to_date, 3) END AS cpi,
         CASE WHEN planned_value > 0 THEN round(earned_value / planned_value, 3) END AS spi,
         CASE WHEN actual_cost_to_date > 0
              THEN round(approved_budget / NULLIF(earned_value / actual_cost_to_date, 0), 0) END AS eac,
         CASE WHEN actual_cost_to_date > 0
              THEN round(approved_budget - approved_budget / NULLIF(earned_value / actual_cost_to_date, 0), 0) END AS vac,
         CASE WHEN approved_budget > 0
              THEN round((approved_budget - forecasted_final_cost) / approved_budget * 100, 2) END AS cost_variance_pct
  FROM cost_raw
)"""

CO_STATUS = (
    f"CASE WHEN o_orderkey % {B.VOID_MOD} = 0 THEN 'Void' WHEN o_orderkey % {B.NO_STATUS_MOD} = 0 THEN NULL "
    "WHEN o_orderstatus = 'F' THEN 'Approved' "
    "WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'Rejected' "
    "WHEN o_orderkey % 2 = 0 THEN 'Pending' ELSE 'Under Review' END"
)

CO_BASE = f"""
co_base AS (
  SELECT o_orderkey AS okey,
         'CO-' || CAST(o_orderkey AS VARCHAR) AS change_order_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'OCO'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'COR' ELSE 'PCO' END AS co_type,
         'Scope "change", order ' || CAST(o_orderkey AS VARCHAR) || ', "left"' AS description,
         CAST(o_orderdate AS DATE) AS sub_true,
         CAST(o_orderdate AS DATE) + CAST((o_orderkey * 13) % 54 - 2 AS INTEGER) AS dec_true,
         {CO_STATUS} AS status,
         CAST(CAST(round(o_totalprice * 100) AS BIGINT) - 5000000 AS DOUBLE) / {D100} AS cost_impact,
         CAST(o_orderkey % 46 AS INTEGER) AS schedule_impact_days,
         {_list(B.CO_PARTIES)}[o_orderkey % {len(B.CO_PARTIES)} + 1] AS responsible_party,
         CASE WHEN o_orderkey % {B.CO_NO_BUILDING_MOD} <> 0 THEN 'BLD-' || CAST(o_custkey % 5 AS VARCHAR) END AS building_id,
         o_orderpriority || '.' || CAST(o_custkey % 10 AS VARCHAR) AS wbs_code,
         o_orderpriority AS wbs_level_1
  FROM orders
),
co_raw AS (
  SELECT change_order_id, co_type, description,
         {_dirty_date('sub_true', 'okey')} AS submitted_date,
         CASE WHEN status IN ('Pending', 'Under Review') THEN NULL
              WHEN okey % {B.APPROVED_JUNK_MOD} = 0 THEN {_q(B.JUNK_TEXT)}
              ELSE {_dirty_date('dec_true', 'okey', 1)} END AS approved_date,
         status, cost_impact, schedule_impact_days, responsible_party, building_id, wbs_code, wbs_level_1, okey
  FROM co_base
),
co_fact0 AS (
  SELECT change_order_id, building_id, co_type, description,
         {_clean_date('sub_true', 'okey')} AS submitted_date,
         coalesce(CASE WHEN status IN ('Pending', 'Under Review') OR okey % {B.APPROVED_JUNK_MOD} = 0 THEN NULL
                       ELSE {_clean_date('dec_true', 'okey')} END, {SENT}) AS approved_date,
         status, cost_impact, schedule_impact_days, responsible_party, wbs_code, wbs_level_1
  FROM co_base
),
co_fact AS (
  SELECT change_order_id, building_id, co_type, description, submitted_date, approved_date, status,
         cost_impact, schedule_impact_days,
         CASE WHEN approved_date < {SENT} THEN CAST(datediff('day', submitted_date, approved_date) AS INTEGER) END
           AS co_approval_lag_days,
         responsible_party, wbs_code, wbs_level_1
  FROM co_fact0
)"""

SCHED = f"""
sched_base AS (
  SELECT l_orderkey * 8 + l_linenumber AS rk, l_linenumber AS ln,
         'ACT-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS activity_id,
         'Activity ' || CAST(l_linenumber AS VARCHAR) AS activity_name,
         'BLD-' || CAST(o_custkey % 5 AS VARCHAR) AS building_id,
         o_orderpriority AS wbs_level_1,
         o_orderpriority || '.' || CAST(o_custkey % 10 AS VARCHAR) AS wbs_code,
         CAST(o_orderdate AS DATE) AS ps,
         CAST(o_orderdate AS DATE) + CAST(l_quantity AS INTEGER) AS pf,
         l_linestatus = 'F' AS fin,
         (l_linestatus = 'F' OR l_returnflag = 'A') AS st,
         CAST(o_orderdate AS DATE) + CAST(l_linenumber - 1 AS INTEGER) AS as_true,
         CAST(l_shipdate AS DATE) AS af_true,
         CAST(l_quantity AS INTEGER) AS q, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
sched_fact AS (
  SELECT activity_id, building_id, activity_name, wbs_level_1, wbs_code,
         CASE WHEN rk % {B.BLANK_MOD} <> 0 AND rk % {B.JUNK_MOD} = 0 THEN NULL ELSE ps END AS planned_start,
         CASE WHEN rk % {B.BLANK_MOD} <> 0 AND rk % {B.JUNK_MOD} = 0 THEN NULL ELSE pf END AS planned_finish,
         CASE WHEN st THEN {_clean_date('as_true', 'rk')} END AS actual_start,
         CASE WHEN fin THEN {_clean_date('af_true', 'rk')} END AS actual_finish,
         q AS baseline_duration,
         CAST(CASE WHEN fin THEN datediff('day', as_true, af_true) WHEN st THEN ln * 3 END AS INTEGER) AS actual_duration,
         CASE WHEN fin THEN 1.0::DOUBLE WHEN st THEN l_quantity / {D100} ELSE 0.0::DOUBLE END AS percent_complete,
         CAST(ln * 5 - 10 AS INTEGER) AS total_float_days,
         CASE WHEN ln * 5 - 10 <= 0 THEN 'Y' ELSE 'N' END AS critical_path_flag
  FROM sched_base
)"""

PAY = f"""
pay_month AS (
  SELECT n_regionkey AS region, CAST(l_suppkey % {B.N_CONTRACTORS} AS INTEGER) AS contractor,
         CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS month,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS this_period
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL
),
pay_run AS (
  SELECT *, CAST(datediff('month', DATE '{B.PAY_EPOCH}', month) + 1 AS INTEGER) AS seq,
         CAST(sum(this_period) OVER (PARTITION BY region, contractor ORDER BY month
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS to_date,
         CAST(sum(this_period) OVER (PARTITION BY region, contractor) AS BIGINT) AS scheduled,
         CAST(floor(this_period / 20.0::DOUBLE) AS BIGINT) AS stored,
         CASE WHEN contractor % 4 = 0 THEN 5.0::DOUBLE ELSE 10.0::DOUBLE END AS pct
  FROM pay_month
),
pay_calc AS (
  SELECT *, to_date + stored AS earned,
         CAST(round((to_date + stored) * pct / {D100}) AS BIGINT) AS held
  FROM pay_run
),
pay_raw AS (
  SELECT 'PA-' || CAST(region AS VARCHAR) || '-' || CAST(contractor AS VARCHAR) || '-' || CAST(seq AS VARCHAR) AS pay_app_id,
         CASE WHEN seq % {B.PAY_JUNK_PERIOD_MOD} = 0 THEN {_q(B.JUNK_TEXT)}
              WHEN seq % 10 < {B.PAY_PERIOD_ALT} THEN strftime(month, '%B %Y') ELSE strftime(month, '%Y-%m') END AS period,
         CASE WHEN seq % {B.PAY_JUNK_PERIOD_MOD} <> 0 THEN strftime(month, '%Y-%m') END AS period_label,
         CASE WHEN seq % {B.PAY_JUNK_PERIOD_MOD} <> 0 THEN month END AS period_start,
         seq AS period_sequence,
         'BLD-' || CAST(region AS VARCHAR) AS building_id,
         {VARIANTS}[contractor * 5 + seq % 5 + 1] AS contractor_raw,
         {_list(B.CANONICAL_VENDORS)}[contractor + 1] AS contractor_true,
         {_list(B.CONTRACTOR_TRADES)}[contractor + 1] AS trade,
         scheduled AS scheduled_value, this_period AS work_completed_this_period,
         to_date AS work_completed_to_date, stored AS stored_materials, earned AS total_earned,
         pct AS retainage_pct,
         CASE WHEN (seq * 5 + contractor) % {B.HELD_NULL_MOD} <> 0
              THEN held + CASE WHEN (seq * 7 + contractor) % {B.RETAINAGE_BREAK_MOD} = 0 THEN {B.RETAINAGE_ERROR} ELSE 0 END
         END AS retainage_held,
         CASE WHEN (seq * 11 + contractor) % {B.NET_NULL_MOD} <> 0 THEN earned - held END AS net_payment_due,
         {_list(B.PAY_STATUSES)}[seq % 4 + 1] AS pay_app_status
  FROM pay_calc
),
pay_fact AS (
  SELECT pay_app_id, building_id, period, period_sequence,
         contractor_true AS contractor_name, contractor_raw,
         trade, scheduled_value, work_completed_this_period, work_completed_to_date, stored_materials,
         total_earned, retainage_pct, retainage_held, net_payment_due, pay_app_status,
         period_label, period_start
  FROM pay_raw
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


COST = _with(COST_BASE)
CO = _with(CO_BASE)
SCH = _with(SCHED)
PAYW = _with(PAY)

FACT_COST_COLS = (
    "cost_key, building_id, cost_code, wbs_level_1, wbs_level_2, vendor_name, contract_value, approved_budget, "
    "committed_cost, actual_cost_to_date, forecasted_final_cost, variance, earned_value, planned_value, "
    "percent_complete_actual, percent_complete_baseline, cpi, spi, eac, vac, cost_variance_pct"
)
FACT_CO_COLS = (
    "change_order_id, building_id, co_type, description, submitted_date, approved_date, status, cost_impact, "
    "schedule_impact_days, co_approval_lag_days, responsible_party, wbs_code, wbs_level_1"
)
FACT_PAY_COLS = (
    "pay_app_id, building_id, period, period_sequence, contractor_name, trade, scheduled_value, "
    "work_completed_this_period, work_completed_to_date, stored_materials, total_earned, retainage_pct, "
    "retainage_held, net_payment_due, pay_app_status"
)


def _money(agg: str, expr: str) -> str:
    return f"CAST({agg}(CAST(round({expr} * 100) AS BIGINT)) AS DOUBLE) / {D100}"


def _i(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _evm_ratios(bac: str, ac: str, ev: str, pv: str) -> str:
    eac = f"({bac} / NULLIF({ev} / NULLIF({ac}, 0), 0))"
    return (
        f"round({ev} / NULLIF({ac}, 0), 3) AS cpi, round({ev} / NULLIF({pv}, 0), 3) AS spi, "
        f"round({eac}, 0) AS eac, round({bac} - {eac}, 0) AS vac"
    )


SUMMARY = f"""{COST},
t AS (SELECT building_id, {_i('sum(approved_budget)')} AS total_budget, {_i('sum(actual_cost_to_date)')} AS total_actual_cost,
             {_i('sum(earned_value)')} AS total_earned_value, {_i('sum(planned_value)')} AS total_planned_value
      FROM cost_fact GROUP BY building_id)
SELECT building_id, {_evm_ratios('total_budget', 'total_actual_cost', 'total_earned_value', 'total_planned_value')},
       total_budget, total_actual_cost, total_earned_value
FROM t"""


def _fuzzy_key(expr: str) -> str:
    return (
        f"array_to_string(list_sort(string_split(trim(regexp_replace(regexp_replace(strip_accents(lower({expr})), '[.'']', '', 'g'), "
        f"'[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')), ' ')"
    )


CANON_VALUES = ", ".join(f"({i}, {_q(c)})" for i, c in enumerate(B.CANONICAL_VENDORS))

FUZZY = f"""{COST},
canon AS (SELECT * FROM (VALUES {CANON_VALUES}) AS t(canon_id, canonical)),
canon_k AS (SELECT canon_id, canonical, {_fuzzy_key('canonical')} AS ck FROM canon),
names AS (SELECT DISTINCT vendor_name AS raw FROM cost_raw
          WHERE vendor_name IS NOT NULL AND NOT {_rule_hit('vendor_name', RULES)}),
names_k AS (SELECT raw, {_fuzzy_key('raw')} AS nk FROM names),
scored AS (
  SELECT raw, canon_id, canonical,
         CASE WHEN least(length(nk), length(ck)) = 0 THEN 0.0::DOUBLE
              ELSE 100.0::DOUBLE * (1.0::DOUBLE - CAST(levenshtein(nk, ck) AS DOUBLE) / CAST(greatest(length(nk), length(ck)) AS DOUBLE))
         END AS score
  FROM names_k CROSS JOIN canon_k
),
best AS (
  SELECT raw, canonical FROM (
    SELECT raw, canonical, row_number() OVER (PARTITION BY raw ORDER BY score DESC, canon_id) AS rn
    FROM scored WHERE score >= {DEFAULT_FUZZY_THRESHOLD}) WHERE rn = 1
)
SELECT cost_key, vendor_name AS vendor_raw,
       CASE WHEN {_rule_hit('vendor_name', RULES)} THEN {_rule_case('vendor_name', RULES)}
            ELSE coalesce(best.canonical, vendor_name) END AS vendor_name
FROM cost_raw LEFT JOIN best ON cost_raw.vendor_name = best.raw"""


# The binding renders dates in the first four layouts by key residue; the
# month-only layouts never occur, so their counts are 0.
def _layout_counts():
    from ..functions.dates import DATE_LAYOUTS

    sub_ok = f"okey % {B.BLANK_MOD} <> 0 AND okey % {B.JUNK_MOD} <> 0"
    dec_ok = f"coalesce(status, '') NOT IN ('Pending', 'Under Review') AND okey % {B.APPROVED_JUNK_MOD} <> 0 AND {sub_ok}"
    out = []
    for i, fmt in enumerate(DATE_LAYOUTS):
        if i < 4:
            out.append(("submitted_date", f"layout {fmt}", f"{sub_ok} AND okey % 4 = {i}"))
            out.append(("approved_date", f"layout {fmt}", f"{dec_ok} AND (okey + 1) % 4 = {i}"))
        else:
            out.append(("submitted_date", f"layout {fmt}", "FALSE"))
            out.append(("approved_date", f"layout {fmt}", "FALSE"))
    return out


def _profile(source: str, table: str, cols, extra) -> str:
    parts = [
        f"SELECT {_q(source)} AS source, {_q(c)} AS column_name, 'nulls' AS metric, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS value FROM {table}"
        for c in cols
    ]
    parts += [
        f"SELECT {_q(source)}, {_q(c)}, {_q(m)}, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) FROM {table}"
        for c, m, cond in extra
    ]
    return " UNION ALL ".join(parts)


COST_RAW_COLS = (
    "cost_key", "cost_code", "wbs_level_1", "wbs_level_2", "vendor_name", "contract_value", "approved_budget",
    "committed_cost", "actual_cost_to_date", "forecasted_final_cost", "variance", "earned_value", "planned_value",
    "percent_complete_actual", "percent_complete_baseline", "period_month", "building_id",
)
# line breaks as the binding puts them into descriptions
_BROKEN = (f"CASE WHEN okey % {B.CO_BREAK_MOD} = 0 THEN description || ',' || chr(10) || 'revised' || chr(13) || chr(10) "
           "|| CAST(okey AS VARCHAR) || ' \"times\"' || chr(10) || chr(10) || 'end' ELSE description END")

CO_RAW_COLS = (
    "change_order_id", "co_type", "description", "submitted_date", "approved_date", "status", "cost_impact",
    "schedule_impact_days", "responsible_party", "building_id", "wbs_code", "wbs_level_1",
)

SCHED_RAW_COLS = (
    "activity_id", "activity_name", "building_id", "wbs_level_1", "wbs_code", "planned_start", "planned_finish",
    "actual_start", "actual_finish", "baseline_duration", "actual_duration", "percent_complete", "total_float_days",
    "critical_path_flag",
)
PAY_RAW_COLS = (
    "pay_app_id", "period", "period_sequence", "building_id", "contractor_name", "trade", "scheduled_value",
    "work_completed_this_period", "work_completed_to_date", "stored_materials", "total_earned", "retainage_pct",
    "retainage_held", "net_payment_due", "pay_app_status",
)
# Raw schedule dates: null, junk, or text in one of four layouts by the row's key.
_BLANK, _JUNK = f"rk % {B.BLANK_MOD} = 0", f"(rk % {B.BLANK_MOD} <> 0 AND rk % {B.JUNK_MOD} = 0)"
_SCHED_TEXT = {"planned_start": ("TRUE", 0), "planned_finish": ("TRUE", 1), "actual_start": ("st", 2), "actual_finish": ("fin", 3)}


def _sched_profile():
    from ..functions.dates import DATE_LAYOUTS

    out = []
    for column, (there, shift) in _SCHED_TEXT.items():
        planned = there == "TRUE"
        out.append((column, "unparseable", f"{there} AND {_JUNK}"))
        for i, fmt in enumerate(DATE_LAYOUTS):
            plain = f"(NOT {_BLANK} AND NOT {_JUNK} AND (rk + {shift}) % 4 = {i})" if i < 4 else "FALSE"
            if planned and i == 0:  # a planned date is never blank: the first layout instead
                plain = f"({plain} OR {_BLANK})"
            out.append((column, f"layout {fmt}", f"{there} AND {plain}"))
    return out


SCHED_P = (
    "sched_q AS (SELECT activity_id, activity_name, building_id, wbs_level_1, wbs_code, rk, st, fin, "
    "'x' AS planned_start, 'x' AS planned_finish, "
    f"CASE WHEN st AND NOT {_BLANK} THEN 'x' END AS actual_start, CASE WHEN fin AND NOT {_BLANK} THEN 'x' END AS actual_finish, "
    "q AS baseline_duration, CASE WHEN fin OR st THEN 1 END AS actual_duration, 1 AS percent_complete, "
    "1 AS total_float_days, 'x' AS critical_path_flag FROM sched_base)"
)
PAY_P = ("pay_p AS (SELECT pay_app_id, period, period_sequence, building_id, contractor_raw AS contractor_name, trade, scheduled_value, "
         "work_completed_this_period, work_completed_to_date, stored_materials, total_earned, retainage_pct, retainage_held, "
         "net_payment_due, pay_app_status FROM pay_raw)")

_CANON_IN = "(" + ", ".join(_q(c) for c in B.CANONICAL_VENDORS) + ")"

NULL_PROFILE = (
    _with(COST_BASE, CO_BASE, SCHED, PAY, SCHED_P, PAY_P)
    + ", cost_p AS (SELECT *, 'x' AS period_month, "
    + f"{_rule_case('vendor_name', RULES)} AS vendor_clean FROM cost_raw) "
    + _profile("cost_ledger", "cost_p", COST_RAW_COLS,
               [("vendor_name", "unmatched", f"vendor_name IS NOT NULL AND vendor_clean NOT IN {_CANON_IN}")])
    + " UNION ALL "
    + _profile("change_orders", "co_raw", CO_RAW_COLS,
               [("submitted_date", "unparseable", f"submitted_date = {_q(B.JUNK_TEXT)}"),
                ("approved_date", "unparseable", f"approved_date = {_q(B.JUNK_TEXT)}")]
               + _layout_counts())
    + " UNION ALL " + _profile("schedule", "sched_q", SCHED_RAW_COLS, _sched_profile())
    + " UNION ALL "
    + _profile("pay_applications", "pay_p", PAY_RAW_COLS,
               [("contractor_name", "unmatched", "FALSE"), ("period", "unparseable", f"period = {_q(B.JUNK_TEXT)}")])
)

AUDIT = (
    _with(COST_BASE, CO_BASE, SCHED, PAY)
    + " SELECT 'cost_ledger' AS source, count(*) AS row_count FROM cost_raw"
    + " UNION ALL SELECT 'change_orders', count(*) FROM co_raw"
    + " UNION ALL SELECT 'schedule', count(*) FROM sched_fact"
    + " UNION ALL SELECT 'pay_applications', count(*) FROM pay_raw"
)

CASH_SUMS = (
    f"{_i('sum(work_completed_this_period)')} AS monthly_spend, {_i('sum(work_completed_to_date)')} AS cumulative_spend, "
    f"{_i('sum(scheduled_value)')} AS scheduled_value, {_i('sum(retainage_held)')} AS retainage_held, "
    f"{_i('sum(net_payment_due)')} AS net_payment_due"
)

DIM_WBS = f"""{_with(COST_BASE, CO_BASE, SCHED)},
codes AS (SELECT cost_code AS wbs_code, wbs_level_1, wbs_level_2 FROM cost_raw
          UNION ALL SELECT wbs_code, wbs_level_1, NULL FROM sched_fact
          UNION ALL SELECT wbs_code, wbs_level_1, NULL FROM co_base)
SELECT wbs_code, wbs_level_1, max(wbs_level_2) AS wbs_level_2 FROM codes GROUP BY wbs_code, wbs_level_1"""

DIM_BUILDING = f"""{_with(COST_BASE, CO_BASE, SCHED, PAY)},
ids AS (SELECT building_id FROM cost_raw UNION SELECT building_id FROM co_base
        UNION SELECT building_id FROM sched_fact UNION SELECT building_id FROM pay_raw)
SELECT building_id, {_q(C.CAMPUS)} AS campus, {_q(C.CLIENT)} AS client,
       CAST({C.PROGRAM_VALUE} AS BIGINT) AS program_value_usd, DATE '{C.SNAPSHOT}' AS snapshot_date
FROM ids"""

DIM_VENDOR = f"""{_with(COST_BASE, PAY)},
names AS (SELECT vendor_name FROM cost_fact UNION SELECT contractor_name FROM pay_fact),
trades AS (SELECT DISTINCT contractor_name AS vendor_name, trade FROM pay_fact),
j AS (SELECT n.vendor_name, t.trade FROM names n LEFT JOIN trades t ON n.vendor_name = t.vendor_name
      WHERE n.vendor_name IS NOT NULL)
SELECT CAST(row_number() OVER (ORDER BY vendor_name NULLS FIRST, trade NULLS FIRST) AS BIGINT) AS vendor_id,
       vendor_name, trade FROM j"""


def _calendar(span_sql: str) -> str:
    return f"""{span_sql},
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS full_date FROM span WHERE s IS NOT NULL)
SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
       CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
       dayname(full_date) AS day_name, CAST(dayofweek(full_date) IN (0, 6) AS INTEGER) AS is_weekend,
       CAST(full_date = last_day(full_date) AS INTEGER) AS is_month_end,
       CAST(year(full_date) AS INTEGER) AS fiscal_year, CAST(quarter(full_date) AS INTEGER) AS fiscal_quarter
FROM days"""


DIM_DATE = _calendar(f"""{_with(CO_BASE, SCHED)},
dates AS (SELECT submitted_date AS d FROM co_fact UNION ALL SELECT approved_date FROM co_fact WHERE approved_date < {SENT}
          UNION ALL SELECT planned_start FROM sched_fact UNION ALL SELECT planned_finish FROM sched_fact
          UNION ALL SELECT actual_start FROM sched_fact UNION ALL SELECT actual_finish FROM sched_fact),
span AS (SELECT min(d) AS s, max(d) AS e FROM dates)""")

AGING = f"""{CO}
SELECT building_id, status, count(*) AS co_count, {_money('sum', 'cost_impact')} AS total_cost_impact,
       avg(co_approval_lag_days) AS avg_approval_lag,
       count(*) FILTER (WHERE co_approval_lag_days BETWEEN 0 AND 15) AS bucket_0_15_days,
       count(*) FILTER (WHERE co_approval_lag_days BETWEEN 16 AND 30) AS bucket_16_30_days,
       count(*) FILTER (WHERE co_approval_lag_days > 30) AS bucket_30_plus_days
FROM co_fact GROUP BY building_id, status"""

EXPOSURE = f"""{CO},
o AS (SELECT building_id, cost_impact, CAST(datediff('day', submitted_date, DATE '{C.SNAPSHOT}') AS INTEGER) AS age
      FROM co_fact WHERE status IN ('Pending', 'Under Review'))
SELECT building_id, count(*) AS open_count, {_money('sum', 'cost_impact')} AS open_cost_impact,
       avg(age) AS avg_days_outstanding, max(age) AS max_days_outstanding,
       count(*) FILTER (WHERE age BETWEEN 0 AND 15) AS age_0_15_days,
       count(*) FILTER (WHERE age BETWEEN 16 AND 30) AS age_16_30_days,
       count(*) FILTER (WHERE age > 30) AS age_30_plus_days,
       count(*) FILTER (WHERE age IS NULL) AS age_unknown
FROM o GROUP BY building_id"""

WATERFALL = f"""{CO},
s AS (SELECT building_id,
             CASE WHEN status = 'Approved' THEN 'Approved' WHEN status IN ('Pending', 'Under Review') THEN 'Pending'
                  WHEN status = 'Rejected' THEN 'Rejected' ELSE 'Other' END AS step,
             CASE WHEN status = 'Approved' THEN 1 WHEN status IN ('Pending', 'Under Review') THEN 2
                  WHEN status = 'Rejected' THEN 3 ELSE 4 END AS step_order, cost_impact
      FROM co_fact),
g AS (SELECT building_id, step, CAST(step_order AS INTEGER) AS step_order,
             sum(CAST(round(cost_impact * 100) AS BIGINT)) AS amount, count(*) AS co_count
      FROM s GROUP BY ALL),
r AS (SELECT *, sum(amount) OVER (PARTITION BY building_id ORDER BY step_order
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bar_end FROM g)
SELECT building_id, step, step_order, co_count, CAST(amount AS DOUBLE) / {D100} AS amount,
       CAST(bar_end - amount AS DOUBLE) / {D100} AS bar_start, CAST(bar_end AS DOUBLE) / {D100} AS bar_end FROM r"""

RECON = f"""{PAYW}
SELECT building_id, contractor_name, count(*) AS pay_app_count,
       {_i('sum(scheduled_value)')} AS contract_value, {_i('sum(work_completed_to_date)')} AS total_billed,
       {_i('sum(total_earned)')} AS total_certified, {_i('sum(retainage_held)')} AS total_retainage,
       {_i('sum(net_payment_due)')} AS total_net_payment,
       round({_i('sum(retainage_held)')} / NULLIF({_i('sum(total_earned)')}, 0) * 100, 2) AS retainage_pct
FROM pay_fact GROUP BY building_id, contractor_name"""

CURRENT = f"""{PAYW},
r AS (SELECT *, count(*) OVER (PARTITION BY building_id, contractor_name) AS pay_app_count,
             row_number() OVER (PARTITION BY building_id, contractor_name
                                ORDER BY period_sequence DESC, pay_app_id DESC) AS rn FROM pay_fact)
SELECT building_id, contractor_name, pay_app_count, pay_app_id, period, period_sequence, trade, scheduled_value,
       work_completed_this_period, work_completed_to_date, stored_materials, total_earned, retainage_pct,
       retainage_held, net_payment_due, pay_app_status,
       round(work_completed_to_date / NULLIF(scheduled_value, 0) * 100, 2) AS percent_billed
FROM r WHERE rn = 1"""

RETAINAGE = f"""{PAYW},
x AS (SELECT *, CAST(round(total_earned * retainage_pct / {D100}) AS BIGINT) AS exp_held FROM pay_fact)
SELECT building_id, contractor_name, count(*) AS pay_app_count,
       count(*) FILTER (WHERE total_earned <> work_completed_to_date + stored_materials) AS earned_breaks,
       count(*) FILTER (WHERE retainage_held <> exp_held) AS retainage_breaks,
       count(*) FILTER (WHERE net_payment_due <> total_earned - retainage_held) AS net_payment_breaks,
       {_i('sum(abs(retainage_held - exp_held))')} AS retainage_diff_amount,
       count(*) FILTER (WHERE retainage_held IS NULL OR net_payment_due IS NULL) AS missing_amounts
FROM x GROUP BY building_id, contractor_name"""

CASH_BY_PERIOD = f"""{PAYW},
g AS (SELECT building_id, period_label AS period, {CASH_SUMS} FROM pay_fact GROUP BY building_id, period_label)
SELECT *, (SELECT CAST(sum(x.monthly_spend) AS BIGINT) FROM g x
           WHERE x.building_id = g.building_id AND x.period <= g.period) AS running_monthly_spend
FROM g"""

SCURVE = f"""{PAYW},
m AS (SELECT building_id, period_start, {_i('sum(work_completed_this_period)')} AS monthly_spend
      FROM pay_fact GROUP BY building_id, period_start),
c AS (SELECT building_id, {_i('sum(this_period)')} AS budget
      FROM (SELECT 'BLD-' || CAST(region AS VARCHAR) AS building_id, this_period FROM pay_month) GROUP BY building_id),
f AS (SELECT building_id, min(period_start) AS first FROM m GROUP BY building_id),
s AS (SELECT m.building_id, m.period_start, monthly_spend, budget,
             (SELECT CAST(sum(x.monthly_spend) AS BIGINT) FROM m x
              WHERE x.building_id = m.building_id AND x.period_start <= m.period_start) AS actual_cumulative,
             least(1.0::DOUBLE, CAST(datediff('month', first, m.period_start) + 1 AS DOUBLE)
                   / CAST(greatest(datediff('month', first, DATE '{C.PLANNED_END}-01') + 1, 1) AS DOUBLE)) AS t
      FROM m JOIN c ON m.building_id = c.building_id JOIN f ON m.building_id = f.building_id),
b AS (SELECT building_id, strftime(period_start, '%Y-%m') AS period, monthly_spend, actual_cumulative,
             CASE WHEN period_start IS NOT NULL THEN round(budget * t, 0) END AS baseline_cumulative FROM s)
SELECT *, actual_cumulative - baseline_cumulative AS variance_to_baseline,
       CASE WHEN period IS NULL THEN 'unassigned' WHEN actual_cumulative - baseline_cumulative > 0 THEN 'ahead'
            WHEN actual_cumulative - baseline_cumulative < 0 THEN 'behind' ELSE 'on plan' END AS position
FROM b"""

SCURVE_MONTHS = f"""{PAYW},
m AS (SELECT building_id, period_start, {_i('sum(work_completed_this_period)')} AS monthly_spend
      FROM pay_fact GROUP BY building_id, period_start),
c AS (SELECT building_id, {_i('sum(this_period)')} AS budget
      FROM (SELECT 'BLD-' || CAST(region AS VARCHAR) AS building_id, this_period FROM pay_month) GROUP BY building_id),
f AS (SELECT building_id, min(period_start) AS first, greatest(max(period_start), DATE '{C.PLANNED_END}-01') AS last
      FROM m GROUP BY building_id),
g AS (SELECT building_id, first, unnest(generate_series(first, last, INTERVAL 1 MONTH))::DATE AS month FROM f
      UNION ALL SELECT m.building_id, first, NULL::DATE FROM m JOIN f ON m.building_id = f.building_id WHERE period_start IS NULL),
s AS (SELECT g.building_id, g.month, first, budget, m.building_id IS NOT NULL AS billed,
             CASE WHEN m.building_id IS NULL THEN 0 ELSE m.monthly_spend END AS monthly_spend,
             (SELECT CAST(sum(x.monthly_spend) AS BIGINT) FROM m x
              WHERE x.building_id = g.building_id AND x.period_start <= g.month) AS actual_cumulative,
             (SELECT CAST(sum(t) AS BIGINT) FROM (
                SELECT max_by(p.work_completed_to_date, p.period_sequence) AS t FROM pay_fact p
                WHERE p.building_id = g.building_id AND p.period_start <= g.month GROUP BY p.contractor_name)) AS reported_to_date,
             least(1.0::DOUBLE, CAST(datediff('month', first, g.month) + 1 AS DOUBLE)
                   / CAST(greatest(datediff('month', first, DATE '{C.PLANNED_END}-01') + 1, 1) AS DOUBLE)) AS t
      FROM g JOIN c ON g.building_id = c.building_id
           LEFT JOIN m ON m.building_id = g.building_id AND m.period_start IS NOT DISTINCT FROM g.month),
b AS (SELECT building_id, strftime(month, '%Y-%m') AS period, CAST(monthly_spend AS BIGINT) AS monthly_spend, billed,
             reported_to_date, actual_cumulative,
             CASE WHEN month IS NOT NULL THEN round(budget * t, 0) END AS baseline_cumulative FROM s)
SELECT *, actual_cumulative - baseline_cumulative AS variance_to_baseline,
       CASE WHEN period IS NULL THEN 'unassigned' WHEN actual_cumulative - baseline_cumulative > 0 THEN 'ahead'
            WHEN actual_cumulative - baseline_cumulative < 0 THEN 'behind' ELSE 'on plan' END AS position
FROM b"""

RULE_TABLE = f"""
WITH r AS (SELECT c_name AS pattern, 'Account ' || CAST(c_custkey AS VARCHAR) AS canonical, c_custkey + 1000000000 AS priority
           FROM customer
           UNION ALL SELECT DISTINCT upper(left(c_name, length(c_name) - 1)), 'Block ' || CAST(c_custkey // 10 AS VARCHAR), 1
           FROM customer),
n AS (SELECT o_orderkey, 'Customer#' || CASE WHEN o_orderkey % {B.TYPO_MOD} = 0
             THEN left(lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 8) || 'x' ELSE lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS name
      FROM orders),
t AS (SELECT o_orderkey, CASE WHEN o_orderkey % {B.NO_ACCOUNT_MOD} <> 0 THEN
             CASE o_orderkey % 3 WHEN 0 THEN lower(name) WHEN 1 THEN 'c/o ' || name || ' (site office)' ELSE name END
             END AS account_raw FROM n),
b AS (SELECT d.account_raw, max_by(r.canonical, r.priority) AS canonical
      FROM (SELECT DISTINCT account_raw FROM t WHERE account_raw IS NOT NULL) d JOIN r
           ON contains(upper(d.account_raw), upper(r.pattern)) GROUP BY d.account_raw)
SELECT t.o_orderkey, t.account_raw, coalesce(b.canonical, t.account_raw) AS account_name
FROM t LEFT JOIN b ON b.account_raw = t.account_raw"""

VARIANCE_TOP = f"""{COST},
g AS (SELECT wbs_level_1, building_id, {_i('sum(approved_budget)')} AS approved_budget,
             {_i('sum(actual_cost_to_date)')} AS actual_cost, {_i('sum(forecasted_final_cost)')} AS forecasted_final_cost,
             {_i('sum(variance)')} AS variance, {_i('sum(earned_value)')} AS earned_value
      FROM cost_fact GROUP BY wbs_level_1, building_id)
SELECT wbs_level_1, building_id, approved_budget, actual_cost, forecasted_final_cost, variance,
       round(variance / NULLIF(approved_budget, 0) * 100, 2) AS variance_pct, earned_value,
       round(earned_value / NULLIF(actual_cost, 0), 3) AS cpi
FROM g ORDER BY variance ASC NULLS LAST, wbs_level_1, building_id LIMIT 10"""

CUBE = f"""{COST},
f AS (SELECT building_id, wbs_level_1, wbs_level_2, {_i('sum(approved_budget)')} AS b, {_i('sum(actual_cost_to_date)')} AS a,
             {_i('sum(earned_value)')} AS e, {_i('sum(planned_value)')} AS p
      FROM cost_fact GROUP BY ALL),
c AS (SELECT building_id, wbs_level_1, wbs_level_2, {_i('sum(b)')} AS total_budget, {_i('sum(a)')} AS total_actual_cost,
             {_i('sum(e)')} AS total_earned_value, {_i('sum(p)')} AS total_planned_value,
             CAST(grouping(building_id, wbs_level_1, wbs_level_2) AS INTEGER) AS grouping_level
      FROM f GROUP BY CUBE (building_id, wbs_level_1, wbs_level_2))
SELECT *, {_evm_ratios('total_budget', 'total_actual_cost', 'total_earned_value', 'total_planned_value')} FROM c"""

CUBE_STORED = CUBE.replace("CUBE (building_id, wbs_level_1, wbs_level_2)",
                           "GROUPING SETS (" + ", ".join("(" + ", ".join(s) + ")" for s in C.CUBE_SETS) + ")")

TRAFFIC = f"""{COST},
t AS (SELECT building_id, {_i('sum(approved_budget)')} AS total_budget, {_i('sum(actual_cost_to_date)')} AS total_actual_cost,
             {_i('sum(earned_value)')} AS total_earned_value, {_i('sum(planned_value)')} AS total_planned_value
      FROM cost_fact GROUP BY building_id),
s AS (SELECT building_id, {_evm_ratios('total_budget', 'total_actual_cost', 'total_earned_value', 'total_planned_value')},
             total_budget, total_actual_cost, total_earned_value FROM t)
SELECT *, round(total_actual_cost / NULLIF(total_earned_value, 0), 3) AS cost_per_dollar,
       CASE WHEN cpi IS NULL THEN 'No Data' WHEN cpi >= {DEFAULT_CPI_GREEN} THEN 'Green'
            WHEN cpi < {DEFAULT_CPI_RED} THEN 'Red' ELSE 'Amber' END AS status
FROM s"""

TREND = f"""{COST},
m AS (SELECT building_id, period_start,
             {_i('sum(approved_budget)')} AS b, {_i('sum(actual_cost_to_date)')} AS a,
             {_i('sum(earned_value)')} AS e, {_i('sum(planned_value)')} AS p
      FROM cost_raw GROUP BY ALL),
c AS (SELECT m.building_id, m.period_start,
             {_i('sum(x.b)')} AS cum_budget, {_i('sum(x.a)')} AS cum_actual_cost,
             {_i('sum(x.e)')} AS cum_earned_value, {_i('sum(x.p)')} AS cum_planned_value
      FROM m JOIN m x ON x.building_id IS NOT DISTINCT FROM m.building_id
           AND (x.period_start <= m.period_start OR (x.period_start IS NULL AND m.period_start IS NULL))
      GROUP BY m.building_id, m.period_start),
r AS (SELECT *, round(cum_earned_value / NULLIF(cum_actual_cost, 0), 3) AS cpi,
             round(cum_earned_value / NULLIF(cum_planned_value, 0), 3) AS spi,
             round(cum_budget / NULLIF(cum_earned_value / NULLIF(cum_actual_cost, 0), 0), 0) AS eac FROM c),
l AS (SELECT r.*, y.cpi AS prev FROM r LEFT JOIN r y ON y.building_id IS NOT DISTINCT FROM r.building_id
           AND y.period_start + INTERVAL 1 MONTH = r.period_start)
SELECT building_id, strftime(period_start, '%Y-%m') AS period, cum_budget, cum_actual_cost, cum_earned_value,
       cum_planned_value, cpi, spi, eac, round(cpi - prev, 3) AS cpi_change,
       CASE WHEN prev IS NULL OR cpi IS NULL THEN 'n/a' WHEN cpi > prev THEN 'improving'
            WHEN cpi < prev THEN 'worsening' ELSE 'flat' END AS cpi_direction
FROM l"""


TREND_MONTHS = f"""{COST},
h AS (SELECT building_id, period_start, count(*) AS n FROM cost_raw GROUP BY ALL),
e AS (SELECT building_id, min(period_start) AS lo, max(period_start) AS hi FROM cost_raw GROUP BY building_id),
g AS (SELECT building_id, unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::DATE AS period_start FROM e
      UNION ALL SELECT DISTINCT building_id, NULL::DATE FROM cost_raw WHERE period_start IS NULL),
c AS (SELECT g.building_id, g.period_start,
             {_i('sum(x.approved_budget)')} AS cum_budget, {_i('sum(x.actual_cost_to_date)')} AS cum_actual_cost,
             {_i('sum(x.earned_value)')} AS cum_earned_value, {_i('sum(x.planned_value)')} AS cum_planned_value,
             coalesce(bool_or(x.period_start IS NOT DISTINCT FROM g.period_start), false) AS has_rows
      FROM g JOIN (SELECT building_id, period_start, sum(approved_budget) AS approved_budget,
                          sum(actual_cost_to_date) AS actual_cost_to_date, sum(earned_value) AS earned_value,
                          sum(planned_value) AS planned_value FROM cost_raw GROUP BY ALL) x
           ON x.building_id IS NOT DISTINCT FROM g.building_id
           AND (x.period_start <= g.period_start OR (x.period_start IS NULL AND g.period_start IS NULL))
      GROUP BY g.building_id, g.period_start),
r AS (SELECT *, round(cum_earned_value / NULLIF(cum_actual_cost, 0), 3) AS cpi,
             round(cum_earned_value / NULLIF(cum_planned_value, 0), 3) AS spi,
             round(cum_budget / NULLIF(cum_earned_value / NULLIF(cum_actual_cost, 0), 0), 0) AS eac FROM c),
l AS (SELECT r.*, y.cpi AS prev FROM r LEFT JOIN r y ON y.building_id IS NOT DISTINCT FROM r.building_id
           AND y.period_start + INTERVAL 1 MONTH = r.period_start)
SELECT building_id, strftime(period_start, '%Y-%m') AS period, has_rows, cum_budget, cum_actual_cost, cum_earned_value,
       cum_planned_value, cpi, spi, eac, round(cpi - prev, 3) AS cpi_change,
       CASE WHEN prev IS NULL OR cpi IS NULL THEN 'n/a' WHEN cpi > prev THEN 'improving'
            WHEN cpi < prev THEN 'worsening' ELSE 'flat' END AS cpi_direction
FROM l"""


def _matrix() -> str:
    cols = []
    for b in [*C.BUILDINGS, None]:
        n = "other" if b is None else b.lower().replace("-", "_")
        where = (f"building_id IS NULL OR building_id NOT IN ({', '.join(_q(x) for x in C.BUILDINGS)})" if b is None
                 else f"building_id = {_q(b)}")
        v, bb = (_i(f"sum({x}) FILTER (WHERE {where})") for x in ("variance", "approved_budget"))
        cols += [f"{v} AS variance_{n}", f"round({v} / NULLIF({bb}, 0) * 100, 2) AS variance_pct_{n}"]
    return f"""{COST},
m AS (SELECT wbs_level_1, {', '.join(cols)}, {_i('sum(variance)')} AS total_variance,
             round({_i('sum(variance)')} / NULLIF({_i('sum(approved_budget)')}, 0) * 100, 2) AS total_variance_pct
      FROM cost_fact GROUP BY wbs_level_1)
SELECT *, CASE WHEN total_variance_pct < -2.0 THEN 'overrun' WHEN total_variance_pct < 0 THEN 'watch' ELSE 'ok' END AS band
FROM m"""


DRILL = f"""{COST},
c AS (SELECT wbs_level_1, building_id, cost_code, {_i('sum(variance)')} AS variance,
             {_i('sum(approved_budget)')} AS approved_budget FROM cost_fact GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY wbs_level_1, building_id ORDER BY variance ASC NULLS LAST, cost_code)
                AS rank_in_cell,
             sum(greatest(-variance, 0)) OVER (PARTITION BY wbs_level_1, building_id) AS cell_overrun FROM c)
SELECT wbs_level_1, building_id, cost_code, variance, approved_budget, CAST(rank_in_cell AS INTEGER) AS rank_in_cell,
       round(greatest(-variance, 0) / NULLIF(CAST(cell_overrun AS DOUBLE), 0), 4) AS share_of_overrun
FROM r"""

DRILL_WORST = f"""{COST},
c AS (SELECT building_id, cost_code, {_i('sum(variance)')} AS variance,
             {_i('sum(approved_budget)')} AS approved_budget FROM cost_fact GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY variance ASC NULLS LAST, cost_code) AS rank_in_cell,
             sum(greatest(-variance, 0)) OVER (PARTITION BY building_id) AS cell_overrun FROM c)
SELECT building_id, cost_code, variance, approved_budget, CAST(rank_in_cell AS INTEGER) AS rank_in_cell,
       round(greatest(-variance, 0) / NULLIF(CAST(cell_overrun AS DOUBLE), 0), 4) AS share_of_overrun
FROM r WHERE rank_in_cell <= 5"""

SLIPPAGE = f"""{SCH}
SELECT building_id, wbs_level_1, count(*) AS activity_count,
       count(*) FILTER (WHERE actual_finish IS NOT NULL) AS finished_count,
       count(*) FILTER (WHERE actual_start IS NOT NULL AND actual_finish IS NULL) AS in_progress_count,
       count(*) FILTER (WHERE actual_start IS NULL AND actual_finish IS NULL) AS not_started_count,
       count(*) FILTER (WHERE actual_start IS NULL AND actual_finish IS NOT NULL) AS finished_without_start_count,
       avg(datediff('day', planned_start, actual_start)) AS avg_start_slip_days,
       avg(datediff('day', planned_finish, actual_finish)) AS avg_finish_slip_days,
       {_i("sum(CASE WHEN actual_finish IS NOT NULL THEN greatest(actual_duration - baseline_duration, 0) END)")}
         AS duration_overrun_days,
       count(*) FILTER (WHERE critical_path_flag = 'Y') AS critical_count,
       count(*) FILTER (WHERE total_float_days < 0) AS negative_float_count
FROM sched_fact GROUP BY building_id, wbs_level_1"""

STAR_JOIN = f"""{_with(COST_BASE, CO_BASE, SCHED, PAY)},
span AS (SELECT min(submitted_date) AS s, max(submitted_date) AS e FROM co_fact),
cal AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter
        FROM (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM span)),
bld AS (SELECT DISTINCT building_id, {_q(C.CAMPUS)} AS campus FROM
          (SELECT building_id FROM cost_raw UNION ALL SELECT building_id FROM co_base
           UNION ALL SELECT building_id FROM sched_fact UNION ALL SELECT building_id FROM pay_raw)),
codes AS (SELECT cost_code AS wbs_code, wbs_level_1, wbs_level_2 FROM cost_raw
          UNION ALL SELECT wbs_code, wbs_level_1, NULL FROM sched_fact
          UNION ALL SELECT wbs_code, wbs_level_1, NULL FROM co_base),
wbs AS (SELECT wbs_code, wbs_level_1, max(wbs_level_2) AS wbs_level_2 FROM codes GROUP BY ALL),
f AS (SELECT building_id, wbs_code, wbs_level_1, cost_impact,
             CAST(strftime(submitted_date, '%Y%m%d') AS INTEGER) AS date_key FROM co_fact)
SELECT cal.year, cal.quarter, bld.campus, f.building_id, f.wbs_level_1, count(*) AS co_count,
       {_money('sum', 'f.cost_impact')} AS total_cost_impact, count(wbs.wbs_level_2) AS with_level_2
FROM f LEFT JOIN cal ON f.date_key = cal.date_key
       LEFT JOIN bld ON f.building_id = bld.building_id
       LEFT JOIN wbs ON f.wbs_code = wbs.wbs_code AND f.wbs_level_1 = wbs.wbs_level_1
GROUP BY ALL"""

STAR_COST = f"""{COST},
g AS (SELECT {_q(C.CAMPUS)} AS campus, building_id, wbs_level_1, wbs_level_2,
             {_i('sum(approved_budget)')} AS total_budget, {_i('sum(actual_cost_to_date)')} AS total_actual_cost,
             {_i('sum(earned_value)')} AS total_earned_value, {_i('sum(planned_value)')} AS total_planned_value
      FROM cost_fact GROUP BY ALL)
SELECT CASE WHEN building_id IS NOT NULL THEN campus END AS campus, building_id, wbs_level_1, wbs_level_2,
       total_budget, total_actual_cost, total_earned_value, total_planned_value,
       {_evm_ratios('total_budget', 'total_actual_cost', 'total_earned_value', 'total_planned_value')}
FROM g"""

STAR_QUARTER = f"""{CO}
SELECT CAST(year(submitted_date) AS INTEGER) AS year, CAST(quarter(submitted_date) AS INTEGER) AS quarter, building_id, status,
       count(*) AS co_count, {_money('sum', 'cost_impact')} AS total_cost_impact
FROM co_fact WHERE year(submitted_date) = {C.QUARTER[0]} AND quarter(submitted_date) = {C.QUARTER[1]}
GROUP BY ALL"""

# Vendors of the cost fact as the job names them: rules, else the best fuzzy match.
_FUZZY_VENDORS = FUZZY.rsplit("\nSELECT cost_key, vendor_name AS vendor_raw,", 1)[0]
ETL_JOB = f"""{_FUZZY_VENDORS}, {CO_BASE}, {SCHED}, {PAY},
vendors AS (SELECT CASE WHEN {_rule_hit('vendor_name', RULES)} THEN {_rule_case('vendor_name', RULES)}
                        ELSE coalesce(best.canonical, vendor_name) END AS vendor_name
            FROM cost_raw LEFT JOIN best ON cost_raw.vendor_name = best.raw
            UNION SELECT contractor_name FROM pay_fact),
dv AS (SELECT DISTINCT v.vendor_name, p.trade FROM vendors v
       LEFT JOIN (SELECT DISTINCT contractor_name, trade FROM pay_fact) p ON p.contractor_name = v.vendor_name
       WHERE v.vendor_name IS NOT NULL),
codes AS (SELECT cost_code AS wbs_code, wbs_level_1, wbs_level_2 FROM cost_raw
          UNION ALL SELECT wbs_code, wbs_level_1, NULL FROM sched_fact
          UNION ALL SELECT wbs_code, wbs_level_1, NULL FROM co_base),
wbs AS (SELECT wbs_code, wbs_level_1, max(wbs_level_2) AS wbs_level_2 FROM codes GROUP BY ALL),
ids AS (SELECT building_id FROM cost_raw UNION SELECT building_id FROM co_base
        UNION SELECT building_id FROM sched_fact UNION SELECT building_id FROM pay_raw),
cal AS ({DIM_DATE})
SELECT 'fact_project_cost' AS table_name, count(*) AS row_count, {_i('sum(approved_budget)')} AS checksum FROM cost_fact
UNION ALL SELECT 'fact_change_orders', count(*), {_i('sum(CAST(round(cost_impact * 100) AS BIGINT))')} FROM co_fact
UNION ALL SELECT 'fact_schedule', count(*), {_i('sum(baseline_duration)')} FROM sched_fact
UNION ALL SELECT 'fact_pay_applications', count(*), {_i('sum(scheduled_value)')} FROM pay_fact
UNION ALL SELECT 'dim_building', count(*), count(building_id) FROM ids
UNION ALL SELECT 'dim_wbs', count(*), count(wbs_level_2) FROM wbs
UNION ALL SELECT 'dim_vendor', count(*), {_i('count(*) * (count(*) + 1) // 2')} FROM dv
UNION ALL SELECT 'dim_date', count(*), {_i('sum(date_key)')} FROM cal"""


def _answer_key() -> str:
    """The key's differences, told from the sums: BLD-1's CPI is 0.01 off, BLD-2 is
    missing, BLD-9 repeats BLD-0's metrics under an id that does not exist."""
    base = SUMMARY.split("\nSELECT building_id,", 1)[0]
    ratios = _evm_ratios("total_budget", "total_actual_cost", "total_earned_value", "total_planned_value")
    rows = []
    for metric, tolerance in (("cpi", 0.0005), ("spi", 0.0005), ("eac", 1.5), ("vac", 1.5)):
        off = f"CASE WHEN building_id = 'BLD-1' THEN round({metric} + 0.01, 3) ELSE {metric} END" if metric == "cpi" else metric
        rows.append(f"SELECT building_id, {_q(metric)} AS metric, {metric} AS computed, "
                    f"CASE WHEN building_id IS DISTINCT FROM 'BLD-2' THEN {off} END AS expected, "
                    f"CASE WHEN building_id = 'BLD-2' THEN 'MISSING_EXPECTED' "
                    f"WHEN building_id = 'BLD-1' AND {_q(metric)} = 'cpi' THEN 'FAIL' ELSE 'PASS' END AS status FROM comp")
        rows.append(f"SELECT 'BLD-9', {_q(metric)}, NULL, {metric}, 'MISSING_COMPUTED' FROM comp WHERE building_id = 'BLD-0'")
    return f"""{base}, comp AS (SELECT building_id, {ratios} FROM t)
{' UNION ALL '.join(rows)}"""


ORACLE_SQL: dict[str, str] = {
    "csv_ingest_typed": f"{CO} SELECT {', '.join(CO_RAW_COLS)} FROM co_raw",
    "csv_line_breaks": f"{CO} SELECT {', '.join(CO_RAW_COLS).replace('description', _BROKEN + ' AS description')} FROM co_raw",
    "csv_quarantine": f"""{CO} SELECT concat_ws(',', change_order_id, co_type,
        '"' || replace({_BROKEN}, '"', '""') || '"', coalesce(submitted_date, ''), coalesce(approved_date, ''),
        coalesce(status, ''), {_q(B.JUNK_TEXT)}, schedule_impact_days, responsible_party, coalesce(building_id, ''), wbs_code,
        wbs_level_1) AS text FROM co_raw WHERE okey % {B.CO_BAD_AMOUNT_MOD} = 0""",
    "source_row_audit": AUDIT,
    "sink_overwrite_roundtrip": f"{COST} SELECT {FACT_COST_COLS} FROM cost_fact",
    "normalize_date": f"{CO} SELECT change_order_id, {_clean_date('sub_true', 'okey')} AS submitted_date, "
                      f"CASE WHEN status IN ('Pending', 'Under Review') OR okey % {B.APPROVED_JUNK_MOD} = 0 THEN NULL "
                      f"ELSE {_clean_date('dec_true', 'okey')} END AS approved_date FROM co_base",
    "normalize_period": f"{_with(COST_BASE, PAY)} SELECT pay_app_id AS row_id, period_label AS period, period_start "
                        f"FROM pay_fact UNION ALL SELECT CAST(cost_key AS VARCHAR), strftime(period_start, '%Y-%m'), "
                        f"period_start FROM cost_raw",
    "sentinel_date": f"{CO} SELECT change_order_id, approved_date FROM co_fact",
    "approval_lag": f"{CO} SELECT change_order_id, status, co_approval_lag_days FROM co_fact",
    "variance_backfill": f"{COST} SELECT cost_key, building_id, variance FROM cost_fact",
    "vendor_rule_map": f"{COST} SELECT cost_key, vendor_name AS vendor_raw, {_rule_case('vendor_name', RULES)} AS vendor_name "
                       f"FROM cost_raw",
    "vendor_rule_table": RULE_TABLE,
    "vendor_fuzzy_match": FUZZY,
    "null_profile": NULL_PROFILE,
    "evm_row_metrics": f"{COST} SELECT cost_key, cpi, spi, eac, vac, cost_variance_pct FROM cost_fact",
    "fact_project_cost": f"{COST} SELECT {FACT_COST_COLS} FROM cost_fact",
    "fact_change_orders": f"{CO} SELECT {FACT_CO_COLS} FROM co_fact",
    "fact_schedule": f"{SCH} SELECT * FROM sched_fact",
    "fact_pay_applications": f"{PAYW} SELECT {FACT_PAY_COLS} FROM pay_fact",
    "fact_pay_applications_as_written": f"{PAYW} SELECT {FACT_PAY_COLS.replace('contractor_name', 'contractor_raw AS contractor_name')} "
                                        f"FROM pay_fact",
    "dim_building": DIM_BUILDING,
    "dim_wbs": DIM_WBS,
    "dim_vendor": DIM_VENDOR,
    "dim_date": DIM_DATE,
    "dense_surrogate_key": "SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS row_id, "
                           "l_orderkey, l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
    "evm_summary_by_building": SUMMARY,
    "change_order_aging": AGING,
    "cash_flow_forecast": f"{PAYW} SELECT building_id, period, period_sequence, {CASH_SUMS} FROM pay_fact "
                          f"GROUP BY building_id, period, period_sequence",
    "cash_flow_by_period": CASH_BY_PERIOD,
    "pay_app_reconciliation": RECON,
    "cost_variance_by_wbs": VARIANCE_TOP,
    "evm_cube": CUBE,
    "evm_cube_stored": CUBE_STORED,
    "evm_traffic_light": TRAFFIC,
    "evm_trend_monthly": TREND,
    "co_open_exposure": EXPOSURE,
    "co_waterfall": WATERFALL,
    "variance_matrix": _matrix(),
    "variance_drill_through": DRILL,
    "variance_drill_worst": DRILL_WORST,
    "retainage_audit": RETAINAGE,
    "schedule_slippage": SLIPPAGE,
    "pay_app_current_position": CURRENT,
    "scurve_vs_baseline": SCURVE,
    "scurve_every_month": SCURVE_MONTHS,
    "evm_trend_every_month": TREND_MONTHS,
    "star_publication": ETL_JOB,
    "star_read": f"{CO} SELECT submitted_date, status, count(*) AS co_count, {_i('sum(schedule_impact_days)')} AS impact_days "
                 f"FROM co_fact WHERE submitted_date BETWEEN DATE '{C.READ_FROM}' AND DATE '{C.READ_TO}' "
                 f"GROUP BY submitted_date, status",
    "star_join_report": STAR_JOIN,
    "star_cost_report": STAR_COST,
    "star_quarter_report": STAR_QUARTER,
    "star_cost_bucketed": STAR_COST,
    "etl_job": ETL_JOB,
    "answer_key_check": _answer_key(),
}
