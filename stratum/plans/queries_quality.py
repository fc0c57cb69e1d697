"""Registered queries: data quality, quarantine splits, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import row_hash_sql
from ..operators import quality as Q
from ..operators import quarantine as QR
from ..operators import recon as R
from . import derived as D
from .catalog import Tables, register

AS_OF = "2002-01-01 00:00:00"
YEAR = 365 * 86400

# Fixed rule set over the silver orders (thresholds are minimum pass rates).
RULES = [
    Q.Rule("r_not_null_segment", "NOT_NULL", "c_mktsegment", threshold=0.95, action="WARN"),
    Q.Rule("r_unique_order", "UNIQUE", "o_orderkey", threshold=1.0, action="FAIL"),
    Q.Rule("r_range_price", "RANGE", "o_totalprice", "1000,400000", threshold=0.9, action="QUARANTINE"),
    Q.Rule("r_pattern_priority", "PATTERN", "o_orderpriority", "^[1-5]-(URGENT|HIGH|MEDIUM|LOW)$",
           threshold=0.8, action="WARN"),
    Q.Rule("r_ref_customer", "REFERENTIAL", "o_custkey", parent="customer_good", parent_column="c_custkey",
           threshold=0.9, action="QUARANTINE"),
    Q.Rule("r_custom_status", "CUSTOM_SQL", rule_expression="o_orderstatus <> 'P' OR o_totalprice < 300000",
           threshold=0.9, action="WARN"),
    Q.Rule("r_accepted_status", "ACCEPTED_VALUES", "o_orderstatus", values=("F", "O"), threshold=0.5, action="WARN"),
    Q.Rule("r_fresh_orders", "FRESHNESS", "o_orderdate", max_age_seconds=YEAR, threshold=1.0, action="FAIL"),
]
BY_ID = {r.rule_id: r for r in RULES}
SRC_SQL = f"src AS ({D.SILVER_ORDERS_SQL}), good_c AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"


def _parents(t):
    return {"customer_good": t.customer.where(F.col("c_acctbal") >= 0)}


def fail_sql(r: Q.Rule, src: str = "src") -> str:
    """The rule's failure test as SQL text over ``src`` (oracle only)."""
    c = r.column_name
    if r.rule_type == "NOT_NULL":
        return f"{c} IS NULL"
    if r.rule_type == "RANGE":
        lo, hi = r.rule_expression.split(",")
        return f"COALESCE({c} < {lo} OR {c} > {hi}, FALSE)"
    if r.rule_type == "PATTERN":
        return f"COALESCE(NOT regexp_matches(CAST({c} AS VARCHAR), '{r.rule_expression}'), FALSE)"
    if r.rule_type == "ACCEPTED_VALUES":
        vals = ", ".join(f"'{v}'" for v in r.values)
        return f"COALESCE({c} NOT IN ({vals}), FALSE)"
    if r.rule_type == "CUSTOM_SQL":
        return f"NOT COALESCE(({r.rule_expression}), FALSE)"
    if r.rule_type == "UNIQUE":
        return (f"{c} IN (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
    if r.rule_type == "REFERENTIAL":
        return f"{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM good_c p WHERE p.{r.parent_column} = {src}.{c})"
    if r.rule_type == "FRESHNESS":
        return (f"COALESCE((SELECT FLOOR(epoch(TIMESTAMP '{AS_OF}') - epoch(MAX({c}))) FROM {src}) > {r.max_age_seconds}, "
                f"TRUE)")
    raise ValueError(r.rule_type)


def result_sql(r: Q.Rule, src: str = "src") -> str:
    rate = "CASE WHEN COUNT(*) = 0 THEN 1.0 ELSE (COUNT(*) - SUM(CASE WHEN f THEN 1 ELSE 0 END)) / COUNT(*) END"
    col = f"'{r.column_name}'" if r.column_name else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{r.rule_id}' AS rule_id, '{r.rule_name}' AS rule_name, CAST(NULL AS VARCHAR) AS target,
  {col} AS column_name, '{r.rule_type}' AS rule_type, CAST(COUNT(*) AS BIGINT) AS total_count,
  CAST(COALESCE(SUM(CASE WHEN f THEN 1 ELSE 0 END), 0) AS BIGINT) AS failed_count,
  CAST(ROUND({rate}, 6) AS DECIMAL(10,6)) AS pass_rate, CAST({r.threshold} AS DECIMAL(10,6)) AS threshold,
  ({rate}) >= {r.threshold} AS passed, '{r.action}' AS action
FROM (SELECT ({fail_sql(r, src)}) AS f FROM {src})"""


@register("dq_results", ops=("A6", "Q9", "Q11"), sql=f"WITH {SRC_SQL}\n" + "\nUNION ALL\n".join(result_sql(r) for r in RULES))
def dq_results(spark, sf):
    t = Tables(spark, sf)
    return Q.evaluate(D.silver_orders(t), RULES, _parents(t), as_of=AS_OF)


def _single(rule_id: str, op: str):
    r = BY_ID[rule_id]

    @register(f"dq_{r.rule_type.lower()}", ops=(op,), sql=f"WITH {SRC_SQL}\n{result_sql(r)}")
    def _q(spark, sf):
        t = Tables(spark, sf)
        return Q.evaluate(D.silver_orders(t), [r], _parents(t), as_of=AS_OF)
    return _q


for _rid, _op in [("r_not_null_segment", "Q1"), ("r_unique_order", "Q2"), ("r_range_price", "Q3"),
                  ("r_pattern_priority", "Q4"), ("r_ref_customer", "Q5"), ("r_custom_status", "Q6"),
                  ("r_fresh_orders", "Q7"), ("r_accepted_status", "Q8")]:
    _single(_rid, _op)


ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
            "c_custkey", "c_mktsegment"]
ORD_OUT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_mktsegment"]


def _flags_sql() -> str:
    return ", ".join(f"({fail_sql(r)}) AS f_{r.rule_id}" for r in RULES)


def _ids_sql(rules) -> str:
    parts = ", ".join(f"CASE WHEN f_{r.rule_id} THEN '{r.rule_id}' END" for r in rules)
    return f"concat_ws(',', {parts})"


QUAR = [r for r in RULES if r.action == "QUARANTINE"]
IS_BAD_SQL = " OR ".join(f"f_{r.rule_id}" for r in QUAR)
FLAGGED_SQL = f"WITH {SRC_SQL}, fl AS (SELECT *, {_flags_sql()} FROM src)\n"
OUT_SQL = ", ".join(ORD_OUT) + ", CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice"


def _ord_out(df, *extra):
    return df.select(*ORD_OUT, F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), *extra)


@register("dq_split_good", ops=("Q10",), sql=FLAGGED_SQL + f"""SELECT {OUT_SQL},
  {_ids_sql([r for r in RULES if r.action == 'WARN'])} AS dq_warnings FROM fl WHERE NOT ({IS_BAD_SQL})""")
def dq_split_good(spark, sf):
    t = Tables(spark, sf)
    good, _, _ = Q.apply_rules(D.silver_orders(t), RULES, _parents(t), as_of=AS_OF)
    return _ord_out(good.withColumn("dq_warnings", F.concat_ws(",", "_dq_warnings")), "dq_warnings")


@register("dq_split_bad", ops=("Q10",), sql=FLAGGED_SQL + f"""SELECT {OUT_SQL},
  {_ids_sql(RULES)} AS dq_failed_rules FROM fl WHERE {IS_BAD_SQL}""")
def dq_split_bad(spark, sf):
    t = Tables(spark, sf)
    _, bad, _ = Q.apply_rules(D.silver_orders(t), RULES, _parents(t), as_of=AS_OF)
    return _ord_out(bad.withColumn("dq_failed_rules", F.concat_ws(",", "_dq_failed_rules")), "dq_failed_rules")


@register("dq_duplicate_keys_lineitem", ops=("A7",), sql="""SELECT l_orderkey, l_linenumber,
  CAST(COUNT(*) AS BIGINT) AS dup_count FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def dq_duplicate_keys_lineitem(spark, sf):
    return Q.duplicate_keys(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"])


LI_UNIQUE = Q.Rule("r_unique_line", "UNIQUE", "l_orderkey, l_linenumber", threshold=0.99, action="QUARANTINE")


@register("dq_unique_lineitem", ops=("Q2", "A7"), sql="""WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1),
fl AS (SELECT (d.l_orderkey IS NOT NULL) AS f FROM lineitem l LEFT JOIN d
  ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber)
SELECT 'r_unique_line' AS rule_id, 'r_unique_line' AS rule_name, CAST(NULL AS VARCHAR) AS target,
  'l_orderkey, l_linenumber' AS column_name, 'UNIQUE' AS rule_type, CAST(COUNT(*) AS BIGINT) AS total_count,
  CAST(SUM(CASE WHEN f THEN 1 ELSE 0 END) AS BIGINT) AS failed_count,
  CAST(ROUND((COUNT(*) - SUM(CASE WHEN f THEN 1 ELSE 0 END)) / COUNT(*), 6) AS DECIMAL(10,6)) AS pass_rate,
  CAST(0.99 AS DECIMAL(10,6)) AS threshold,
  (COUNT(*) - SUM(CASE WHEN f THEN 1 ELSE 0 END)) / COUNT(*) >= 0.99 AS passed, 'QUARANTINE' AS action FROM fl""")
def dq_unique_lineitem(spark, sf):
    return Q.evaluate(Tables(spark, sf).lineitem, [LI_UNIQUE])


@register("dq_orphans", ops=("J4", "Q5"), sql="""SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)""")
def dq_orphans(spark, sf):
    t = Tables(spark, sf)
    return Q.referential_orphans(t.orders.select("o_orderkey", "o_custkey"), _parents(t)["customer_good"],
                                 "o_custkey", "c_custkey")


@register("dq_freshness_events", ops=("A8", "Q7"), sql="""SELECT MAX(ts) AS max_ts,
  CAST(FLOOR(epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(MAX(ts))) AS BIGINT) AS age_seconds,
  FLOOR(epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(MAX(ts))) <= 86400 AS fresh FROM events""")
def dq_freshness_events(spark, sf):
    return Q.freshness(Tables(spark, sf).events, "ts", "2024-02-01 00:00:00", 86400)


# ---------------------------------------------------------------- quarantine

RUN_ID = "run-20020101-0001"
Q_TS = "2002-01-01 06:00:00"
Q_PAYLOAD = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
             "c_mktsegment"]


@register("quarantine_stamp", ops=("L24", "F4", "F12"), sql=FLAGGED_SQL + f"""SELECT *,
  'q_' || substr({row_hash_sql([f"'{RUN_ID}'", "'DQ_FAILURE'"] + Q_PAYLOAD)}, 1, 32) AS quarantine_id,
  '{RUN_ID}' AS run_id, 'DQ_FAILURE' AS reason_category, 'failed quarantine rules' AS reason_detail,
  TIMESTAMP '{Q_TS}' AS quarantine_timestamp, CAST(TIMESTAMP '{Q_TS}' AS DATE) AS quarantine_date
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
  o_orderdate, o_orderpriority, c_mktsegment FROM fl WHERE {IS_BAD_SQL})""")
def quarantine_stamp(spark, sf):
    t = Tables(spark, sf)
    _, bad, _ = Q.apply_rules(D.silver_orders(t), RULES, _parents(t), as_of=AS_OF)
    payload = bad.select(*[F.col(c).cast("decimal(18,2)").alias(c) if c == "o_totalprice" else F.col(c)
                           for c in Q_PAYLOAD])
    return QR.stamp(payload, QR.QuarantineReason.DQ_FAILURE, RUN_ID, "failed quarantine rules", ts=Q_TS)


@register("missing_key_split", ops=("P7",), sql=f"""SELECT o_orderkey, o_custkey, c_custkey
FROM ({D.SILVER_ORDERS_SQL}) WHERE c_custkey IS NULL""")
def missing_key_split(spark, sf):
    _, bad = QR.split_missing_keys(D.silver_orders(Tables(spark, sf)), ["c_custkey"])
    return bad.select("o_orderkey", "o_custkey", "c_custkey")


@register("safe_cast_bad", ops=("P6",), sql="""SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
  'c_acctbal' AS cast_failed_columns FROM customer WHERE TRY_CAST(c_acctbal AS DECIMAL(5,2)) IS NULL""")
def safe_cast_bad(spark, sf):
    _, bad = QR.safe_cast(Tables(spark, sf).customer, {"c_acctbal": "decimal(5,2)"})
    return bad.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
                      F.concat_ws(",", "_cast_failed_columns").alias("cast_failed_columns"))


@register("safe_cast_clean", ops=("P6", "E5"), sql="""SELECT c_custkey, c_name, c_nationkey,
  TRY_CAST(c_acctbal AS DECIMAL(5,2)) AS c_acctbal, c_mktsegment
FROM customer WHERE TRY_CAST(c_acctbal AS DECIMAL(5,2)) IS NOT NULL""")
def safe_cast_clean(spark, sf):
    clean, _ = QR.safe_cast(Tables(spark, sf).customer, {"c_acctbal": "decimal(5,2)"})
    return clean


DRIFT_SQL = """SELECT c.*, n.n_name, n.n_regionkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""


def _drifted(t):
    return t.customer.join(t.nation, t.customer.c_nationkey == t.nation.n_nationkey) \
                     .select(*t.customer.columns, "n_name", "n_regionkey")


@register("drift_capture", ops=("P8", "E7", "F2"), sql=f"""SELECT c_custkey, c_name, c_nationkey,
  CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
  to_json(struct_pack(n_name := n_name, n_regionkey := n_regionkey)) AS _rescued_data
FROM ({DRIFT_SQL})""")
def drift_capture(spark, sf):
    t = Tables(spark, sf)
    _, q = QR.capture_drift(_drifted(t), t.customer.columns)
    return q.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))


@register("drift_clean", ops=("P8", "E10"), sql="""SELECT c_custkey, c_name, c_nationkey,
  CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer""")
def drift_clean(spark, sf):
    t = Tables(spark, sf)
    clean, _ = QR.capture_drift(_drifted(t), t.customer.columns)
    return clean.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))


# ---------------------------------------------------------------- reconciliation

def line_total():
    """Line amount with tax and discount: exact decimal product, rounded to money (DECIMAL(18,2))."""
    return (F.col("l_extendedprice").cast("decimal(18,2)") * (1 + F.col("l_tax").cast("decimal(18,2)"))
            * (1 - F.col("l_discount").cast("decimal(18,2)"))).cast("decimal(18,2)")
LINE_TOTAL_SQL = ("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(18,2))) "
                  "* (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2))")


def _bal_sql(src: str, tgt: str, tol_pct: float) -> str:
    pct = f"ROUND(100.0 * CAST({src} - {tgt} AS DOUBLE) / CAST(ABS({src}) AS DOUBLE), 4)"
    return f"""CAST({src} - {tgt} AS DECIMAL(38,2)) AS variance,
  CAST(CASE WHEN {src} = 0 THEN NULL ELSE {pct} END AS DECIMAL(18,4)) AS variance_percent,
  CAST({tol_pct} AS DECIMAL(18,4)) AS tolerance_percent,
  COALESCE(CASE WHEN {src} = 0 THEN {tgt} = 0 ELSE ABS({pct}) <= {tol_pct} END, FALSE) AS balanced"""


def _count_rule(t):
    return R.ReconRule("rc_order_count", "ROW_COUNT", t.orders, t.lineitem.select("l_orderkey").distinct())


def _total_rule(t):
    o = t.orders.withColumn("o_year", F.year("o_orderdate"))
    # lines are summed per order before they meet the orders
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(line_total()).alias("line_total"))
    li = per_order.join(o.select("o_orderkey", "o_year"), per_order.l_orderkey == o.o_orderkey)
    return R.ReconRule("rc_order_total", "CONTROL_TOTAL", o, li, "o_totalprice", "line_total",
                       group_by=["o_year"], tolerance=0.01, on_break="FAIL", scale=2)


def _hash_rule(t):
    return R.ReconRule("rc_customer_hash", "HASH_TOTAL", D.day1(t), D.day2(t), group_by=["c_nationkey"],
                       hash_columns=["c_custkey", "c_name", "tier"])


COUNT_SQL = f"""SELECT 'rc_order_count' AS recon_rule_id, 'ROW_COUNT' AS recon_type, '*' AS group_key,
  CAST(s AS DECIMAL(38,2)) AS source_value, CAST(t AS DECIMAL(38,2)) AS target_value, {_bal_sql('s', 't', 0.0)},
  'WARN' AS on_break
FROM (SELECT (SELECT COUNT(*) FROM orders) AS s, (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS t)"""

TOTAL_SQL = f"""SELECT 'rc_order_total' AS recon_rule_id, 'CONTROL_TOTAL' AS recon_type,
  CAST(COALESCE(a.o_year, b.o_year) AS VARCHAR) AS group_key,
  CAST(COALESCE(a.s, 0) AS DECIMAL(38,2)) AS source_value, CAST(COALESCE(b.t, 0) AS DECIMAL(38,2)) AS target_value,
  {_bal_sql('CAST(COALESCE(a.s, 0) AS DECIMAL(38,2))', 'CAST(COALESCE(b.t, 0) AS DECIMAL(38,2))', 1.0)},
  'FAIL' AS on_break
FROM (SELECT year(o_orderdate) AS o_year, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders GROUP BY 1) a
FULL OUTER JOIN (SELECT year(o.o_orderdate) AS o_year, SUM({LINE_TOTAL_SQL}) AS t
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1) b ON a.o_year = b.o_year"""

HB = "CAST(('0x' || substr({h}, 1, 15)) AS BIGINT)".format(h=row_hash_sql(["c_custkey", "c_name", "tier"]))
HASH_SQL = f"""WITH {D.DAYS_SQL}
SELECT 'rc_customer_hash' AS recon_rule_id, 'HASH_TOTAL' AS recon_type,
  CAST(COALESCE(a.k, b.k) AS VARCHAR) AS group_key,
  CAST(COALESCE(a.s, 0) AS DECIMAL(38,2)) AS source_value, CAST(COALESCE(b.t, 0) AS DECIMAL(38,2)) AS target_value,
  {_bal_sql('CAST(COALESCE(a.s, 0) AS DECIMAL(38,2))', 'CAST(COALESCE(b.t, 0) AS DECIMAL(38,2))', 0.0)},
  'WARN' AS on_break
FROM (SELECT c_nationkey AS k, SUM(CAST({HB} AS DECIMAL(38,0))) AS s FROM d1 GROUP BY 1) a
FULL OUTER JOIN (SELECT c_nationkey AS k, SUM(CAST({HB} AS DECIMAL(38,0))) AS t FROM d2 GROUP BY 1) b ON a.k = b.k"""


@register("recon_count", ops=("A1", "A4"), sql=COUNT_SQL)
def recon_count(spark, sf):
    return R.reconcile(_count_rule(Tables(spark, sf)))


@register("recon_total", ops=("A2", "A4"), sql=TOTAL_SQL)
def recon_total(spark, sf):
    return R.reconcile(_total_rule(Tables(spark, sf)))


@register("recon_hash", ops=("A3",), sql=HASH_SQL)
def recon_hash(spark, sf):
    return R.reconcile(_hash_rule(Tables(spark, sf)))


@register("recon_rules", ops=("A5",), sql=f"{COUNT_SQL}\nUNION ALL\n{TOTAL_SQL}\nUNION ALL\nSELECT * FROM ({HASH_SQL})")
def recon_rules(spark, sf):
    t = Tables(spark, sf)
    return R.reconcile_all([_count_rule(t), _total_rule(t), _hash_rule(t)])


@register("recon_keys_customer", ops=("J8",), sql=f"""WITH {D.DAYS_SQL}
SELECT COALESCE(a.c_custkey, b.c_custkey) AS c_custkey,
  CASE WHEN b.c_custkey IS NULL THEN 'MISSING_IN_TARGET' WHEN a.c_custkey IS NULL THEN 'MISSING_IN_SOURCE'
       WHEN a.spend IS DISTINCT FROM b.spend THEN 'DIFFERENT' ELSE 'MATCH' END AS status,
  a.spend AS src_spend, b.spend AS tgt_spend, CAST(a.spend - b.spend AS DECIMAL(38,2)) AS diff_spend
FROM d1 a FULL OUTER JOIN d2 b ON a.c_custkey = b.c_custkey""")
def recon_keys_customer(spark, sf):
    t = Tables(spark, sf)
    return R.recon_keys(D.day1(t), D.day2(t), ["c_custkey"], ["spend"])


@register("run_balance_dq", ops=("G18",), sql=FLAGGED_SQL + f"""SELECT CAST(COUNT(*) AS BIGINT) AS rows_read,
  CAST(SUM(CASE WHEN NOT ({IS_BAD_SQL}) THEN 1 ELSE 0 END) AS BIGINT) AS rows_written,
  CAST(SUM(CASE WHEN {IS_BAD_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS rows_rejected,
  CAST(0 AS BIGINT) AS balance_delta, 'PASS' AS balance_status FROM fl""")
def run_balance_dq(spark, sf):
    t = Tables(spark, sf)
    src = D.silver_orders(t)
    good, bad, _ = Q.apply_rules(src, RULES, _parents(t), as_of=AS_OF)
    m = src.agg(F.count(F.lit(1)).cast("bigint").alias("rows_read")) \
           .withColumn("rows_written", good.agg(F.count(F.lit(1))).scalar().cast("bigint")) \
           .withColumn("rows_rejected", bad.agg(F.count(F.lit(1))).scalar().cast("bigint"))
    return R.run_balance(m)


@register("recon_lost_rows", ops=("A1", "A2", "A3", "A4", "A5"), sql="""WITH m AS (SELECT MAX(l_orderkey) AS k FROM lineitem),
c AS (SELECT COUNT(*) AS s, COUNT(*) FILTER (l_orderkey <> k) AS t, SUM(CAST(l_quantity AS DECIMAL(18,6))) AS q,
  SUM(CAST(l_quantity AS DECIMAL(18,6))) FILTER (l_orderkey <> k) AS p FROM lineitem, m)
SELECT 'rows' AS recon_rule_id, s = t AS balanced FROM c
UNION ALL SELECT 'rows_1pct', 100 * abs(s - t) <= abs(s) FROM c
UNION ALL SELECT 'quantity', q = p FROM c
UNION ALL SELECT 'hash_1pct', FALSE FROM c""")
def recon_lost_rows(spark, sf):
    """The lines of one order missing from the target: unbalanced at tolerance 0 at any number of rows, and for hashes at any tolerance."""
    li = Tables(spark, sf).lineitem
    kept = li.where(F.col("l_orderkey") != li.agg(F.max("l_orderkey")).scalar())
    rules = [R.ReconRule("rows", "ROW_COUNT", li, kept), R.ReconRule("rows_1pct", "ROW_COUNT", li, kept, tolerance=0.01),
             R.ReconRule("quantity", "CONTROL_TOTAL", li, kept, "l_quantity"),
             R.ReconRule("hash_1pct", "HASH_TOTAL", li, kept, hash_columns=["l_orderkey", "l_linenumber"], tolerance=0.01)]
    return R.reconcile_all(rules).select("recon_rule_id", "balanced")
