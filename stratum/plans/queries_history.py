"""Registered queries for the merge / history family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import row_hash_sql
from ..operators import history as H
from ..operators import merge as M
from ..session import cut_lineage
from . import derived as D
from .catalog import Tables, register

K = D.SNAP_KEYS
SNAP = ", ".join(D.SNAP_COLS)
META = "__start_at, __end_at, __is_current, __row_hash"
EQ_ALL = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in D.SNAP_COLS if c not in K)


def _history(t, snapshot: bool):
    h1, _, _ = H.scd2_merge(None, D.day1(t), K, D.T1, tracked=D.SNAP_TRACKED)
    return H.scd2_merge(h1, D.day2(t), K, D.T2, tracked=D.SNAP_TRACKED,
                        delete_detection="snapshot" if snapshot else None)


def _scd2_sql(snapshot: bool) -> str:
    close = "act IN ('changed', 'absent')" if snapshot else "act = 'changed'"
    return f"""WITH {D.DAYS_SQL},
h1 AS (SELECT *, {D.SNAP_HASH_SQL} AS __row_hash FROM d1),
b AS (SELECT *, {D.SNAP_HASH_SQL} AS __row_hash FROM d2),
dec AS (SELECT COALESCE(b.c_custkey, h1.c_custkey) AS c_custkey,
  CASE WHEN h1.c_custkey IS NULL THEN 'new' WHEN b.c_custkey IS NULL THEN 'absent'
       WHEN b.__row_hash <> h1.__row_hash THEN 'changed' ELSE 'unchanged' END AS act
  FROM b FULL OUTER JOIN h1 ON b.c_custkey = h1.c_custkey),
hist AS (
  SELECT {SNAP}, TIMESTAMP '{D.T1}' AS __start_at,
    CASE WHEN {close} THEN TIMESTAMP '{D.T2}' ELSE CAST(NULL AS TIMESTAMP) END AS __end_at,
    CASE WHEN {close} THEN FALSE ELSE TRUE END AS __is_current, __row_hash
  FROM h1 JOIN dec USING (c_custkey)
  UNION ALL
  SELECT {SNAP}, TIMESTAMP '{D.T2}', CAST(NULL AS TIMESTAMP), TRUE, __row_hash
  FROM b JOIN dec USING (c_custkey) WHERE act IN ('new', 'changed'))
"""


# ---------------------------------------------------------------- SCD1

@register("scd1_customer", ops=("L5", "L7", "L19", "J2"), sql=f"""WITH {D.DAYS_SQL}
SELECT * FROM d1 WHERE NOT EXISTS (SELECT 1 FROM d2 WHERE d2.c_custkey = d1.c_custkey)
UNION ALL SELECT * FROM d2""")
def scd1_customer(spark, sf):
    t = Tables(spark, sf)
    base, _ = M.scd1_merge(None, D.day1(t), K)
    out, _ = M.scd1_merge(base, D.day2(t), K)
    return out


@register("scd1_metrics", ops=("L6",), sql=f"""WITH {D.DAYS_SQL}
SELECT 'SCD1' AS operation,
  CAST(SUM(CASE WHEN a.c_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted,
  CAST(SUM(CASE WHEN a.c_custkey IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated,
  CAST(SUM(CASE WHEN a.c_custkey IS NOT NULL AND {EQ_ALL} THEN 1 ELSE 0 END) AS BIGINT) AS rows_unchanged,
  CAST(COUNT(*) AS BIGINT) AS rows_written
FROM d2 b LEFT JOIN d1 a ON a.c_custkey = b.c_custkey""")
def scd1_metrics(spark, sf):
    t = Tables(spark, sf)
    _, m = M.scd1_merge(D.day1(t), D.day2(t), K)
    return m


@register("scd1_skip_unchanged", ops=("L6",), sql=f"""WITH {D.DAYS_SQL}
SELECT * FROM d1 a WHERE NOT EXISTS (SELECT 1 FROM d2 b WHERE b.c_custkey = a.c_custkey AND NOT ({EQ_ALL}))
UNION ALL
SELECT b.* FROM d2 b LEFT JOIN d1 a ON a.c_custkey = b.c_custkey WHERE a.c_custkey IS NULL OR NOT ({EQ_ALL})""")
def scd1_skip_unchanged(spark, sf):
    t = Tables(spark, sf)
    out, _ = M.scd1_merge(D.day1(t), D.day2(t), K, skip_unchanged=True)
    return out


# ---------------------------------------------------------------- SCD2

@register("scd2_customer", ops=("L8", "L9", "L11", "J1", "J2", "U1"),
          sql=_scd2_sql(False) + f"SELECT {SNAP}, {META} FROM hist")
def scd2_customer(spark, sf):
    return _history(Tables(spark, sf), snapshot=False)[0]


@register("scd2_snapshot_delete", ops=("L10", "J3"), sql=_scd2_sql(True) + f"SELECT {SNAP}, {META} FROM hist")
def scd2_snapshot_delete(spark, sf):
    return _history(Tables(spark, sf), snapshot=True)[0]


@register("scd2_metrics", ops=("L11",), sql=f"""WITH {D.DAYS_SQL},
h1 AS (SELECT *, {D.SNAP_HASH_SQL} AS __row_hash FROM d1),
b AS (SELECT *, {D.SNAP_HASH_SQL} AS __row_hash FROM d2),
dec AS (SELECT CASE WHEN h1.c_custkey IS NULL THEN 'new' WHEN b.c_custkey IS NULL THEN 'absent'
       WHEN b.__row_hash <> h1.__row_hash THEN 'changed' ELSE 'unchanged' END AS act
  FROM b FULL OUTER JOIN h1 ON b.c_custkey = h1.c_custkey)
SELECT 'SCD2' AS operation,
  CAST(SUM(CASE WHEN act IN ('new', 'changed') THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted,
  CAST(SUM(CASE WHEN act = 'changed' THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated,
  CAST(SUM(CASE WHEN act = 'absent' THEN 1 ELSE 0 END) AS BIGINT) AS rows_closed,
  CAST(SUM(CASE WHEN act = 'unchanged' THEN 1 ELSE 0 END) AS BIGINT) AS rows_unchanged,
  CAST(0 AS BIGINT) AS rows_rejected,
  CAST(SUM(CASE WHEN act = 'new' THEN 1 WHEN act = 'changed' THEN 2 ELSE 0 END) AS BIGINT) AS num_output_rows
FROM dec""")
def scd2_metrics(spark, sf):
    return _history(Tables(spark, sf), snapshot=True)[1]


ASOF_T = "2000-07-01 00:00:00"


@register("scd2_asof", ops=("L14",), sql=_scd2_sql(False) + f"""SELECT {SNAP}, {META} FROM hist
WHERE __start_at <= TIMESTAMP '{ASOF_T}' AND (__end_at IS NULL OR __end_at > TIMESTAMP '{ASOF_T}')""")
def scd2_asof(spark, sf):
    return H.as_of(_history(Tables(spark, sf), snapshot=False)[0], ASOF_T)


@register("scd2_current", ops=("L15",), sql=_scd2_sql(True) + f"SELECT {SNAP}, {META} FROM hist WHERE __is_current")
def scd2_current(spark, sf):
    return H.current(_history(Tables(spark, sf), snapshot=True)[0])


@register("scd2_idempotent", ops=("L8",), sql=_scd2_sql(False) + f"SELECT {SNAP}, {META} FROM hist")
def scd2_idempotent(spark, sf):
    t = Tables(spark, sf)
    h2, _, _ = _history(t, snapshot=False)
    h3, _, _ = H.scd2_merge(h2, D.day2(t), K, "2002-01-01 00:00:00", tracked=D.SNAP_TRACKED)
    return h3


@register("scd6_customer", ops=("L17",), sql=_scd2_sql(False) + f"""SELECT {SNAP}, {META}, c.current_tier
FROM hist LEFT JOIN (SELECT c_custkey, tier AS current_tier FROM hist WHERE __is_current) c USING (c_custkey)""")
def scd6_customer(spark, sf):
    return H.scd6_view(_history(Tables(spark, sf), snapshot=False)[0], K, ["tier"])


# ---------------------------------------------------------------- SCD3, diff

@register("scd3_customer", ops=("L16",), sql=f"""WITH {D.DAYS_SQL}
SELECT {SNAP}, CAST(NULL AS VARCHAR) AS prev_tier FROM d1 a
WHERE NOT EXISTS (SELECT 1 FROM d2 b WHERE b.c_custkey = a.c_custkey)
UNION ALL
SELECT b.c_custkey, b.c_name, b.c_nationkey, b.c_mktsegment, b.tier, b.spend,
  CASE WHEN a.c_custkey IS NOT NULL AND b.tier IS DISTINCT FROM a.tier THEN a.tier ELSE NULL END AS prev_tier
FROM d2 b LEFT JOIN d1 a ON a.c_custkey = b.c_custkey""")
def scd3_customer(spark, sf):
    t = Tables(spark, sf)
    base = M.scd3_merge(None, D.day1(t), K, ["tier"])
    return M.scd3_merge(base, D.day2(t), K, ["tier"])


@register("table_diff_customer", ops=("L22",), sql=f"""WITH {D.DAYS_SQL}
SELECT b.*, 'insert' AS _change_type FROM d2 b WHERE NOT EXISTS (SELECT 1 FROM d1 a WHERE a.c_custkey = b.c_custkey)
UNION ALL SELECT a.*, 'delete' FROM d1 a WHERE NOT EXISTS (SELECT 1 FROM d2 b WHERE a.c_custkey = b.c_custkey)
UNION ALL SELECT a.*, 'update_preimage' FROM d1 a JOIN d2 b ON a.c_custkey = b.c_custkey WHERE NOT ({EQ_ALL})
UNION ALL SELECT b.*, 'update_postimage' FROM d1 a JOIN d2 b ON a.c_custkey = b.c_custkey WHERE NOT ({EQ_ALL})""")
def table_diff_customer(spark, sf):
    t = Tables(spark, sf)
    return M.table_diff(D.day1(t), D.day2(t), K)


# ---------------------------------------------------------------- lineitem / orders plans

LI_OUT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_DEC = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}


def _li_out(df):
    return df.select(*[F.col(c).cast("decimal(18,2)").alias(c) if c in LI_DEC else F.col(c) for c in LI_OUT])


LI_OUT_SQL = ", ".join(f"CAST({c} AS DECIMAL(18,2)) AS {c}" if c in LI_DEC else c for c in LI_OUT)
RESTATE_FROM = "2001-06-01 00:00:00"


@register("delete_insert_lineitem", ops=("L18",), sql=f"""WITH b AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '{RESTATE_FROM}'),
r AS (SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = l.l_orderkey)
      UNION ALL SELECT * FROM b)
SELECT {LI_OUT_SQL} FROM r""")
def delete_insert_lineitem(spark, sf):
    li = Tables(spark, sf).lineitem
    batch = (li.where(F.col("l_shipdate") >= F.lit(RESTATE_FROM).cast("timestamp_ntz"))
             .withColumn("l_quantity", F.col("l_quantity") + 1))
    return _li_out(M.delete_insert(li, batch, ["l_orderkey"]))


LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_REST_DESC = ", ".join(f"{c} DESC" for c in LI_OUT if c not in LI_KEYS and c != "l_shipdate")


@register("dedupe_lineitem", ops=("L23", "W1"), sql=f"""SELECT {LI_OUT_SQL} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {LI_REST_DESC}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_lineitem(spark, sf):
    return _li_out(M.dedupe_latest(Tables(spark, sf).lineitem, LI_KEYS, ["l_shipdate"]))


@register("dedupe_losers_lineitem", ops=("L23",), sql=f"""SELECT {LI_OUT_SQL} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {LI_REST_DESC}) AS rn
  FROM lineitem) WHERE rn > 1""")
def dedupe_losers_lineitem(spark, sf):
    _, losers = M.dedupe_split(Tables(spark, sf).lineitem, LI_KEYS, ["l_shipdate"])
    return _li_out(losers)


ORD_OUT_SQL = ("o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, "
               "o_orderdate, o_orderpriority, o_year")


@register("partition_overwrite_orders", ops=("L4",), sql=f"""WITH t AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders),
b AS (SELECT * FROM t WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01 00:00:00')
SELECT {ORD_OUT_SQL} FROM (
  SELECT * FROM t WHERE o_year NOT IN (SELECT DISTINCT o_year FROM b) UNION ALL SELECT * FROM b)""")
def partition_overwrite_orders(spark, sf):
    o = Tables(spark, sf).orders.withColumn("o_year", F.year("o_orderdate").cast("int"))
    batch = o.where((F.col("o_orderpriority") == "1-URGENT") &
                    (F.col("o_orderdate") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))
    out = M.partition_overwrite(o, batch, ["o_year"])
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)")
                      .alias("o_totalprice"), "o_orderdate", "o_orderpriority", "o_year")


# ---------------------------------------------------------------- CDC apply

CDC_OP = "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END"
CDC_SPLIT = "2024-01-15 00:00:00"


def _changes(t):
    return t.events.withColumn("op", F.when(F.col("event_type") == "signup", "I")
                               .when(F.col("event_type") == "error", "D").otherwise("U"))


@register("apply_changes_events", ops=("L21", "L20"), sql=f"""WITH ch AS (SELECT *, {CDC_OP} AS op FROM events),
e AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
      FROM ch WHERE ts < TIMESTAMP '{CDC_SPLIT}') WHERE rn = 1),
t0 AS (SELECT event_id, ts, user_id, event_type, value, props FROM e WHERE op <> 'D'),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
      FROM ch WHERE ts >= TIMESTAMP '{CDC_SPLIT}') WHERE rn = 1),
r AS (SELECT * FROM t0 WHERE user_id NOT IN (SELECT user_id FROM l)
      UNION ALL SELECT event_id, ts, user_id, event_type, value, props FROM l WHERE op <> 'D')
SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, props FROM r""")
def apply_changes_events(spark, sf):
    ch = _changes(Tables(spark, sf))
    split = F.lit(CDC_SPLIT).cast("timestamp_ntz")
    seq = ["ts", "event_id"]
    t0 = M.apply_changes(None, ch.where(F.col("ts") < split), ["user_id"], seq, "op", tombstones=True)
    t1 = M.apply_changes(t0, ch.where(F.col("ts") >= split), ["user_id"], seq, "op")
    return t1.select("event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"),
                     "props")


# ---------------------------------------------------------------- history rebuild and as-of join

TIER_HIST_HASH = row_hash_sql(["c_mktsegment", "tier"])
TIER_HIST_SQL = f"""cy AS ({D.CUSTOMER_YEARS_SQL}),
hh AS (SELECT *, {TIER_HIST_HASH} AS __row_hash FROM cy),
lg AS (SELECT *, LAG(__row_hash) OVER (PARTITION BY c_custkey ORDER BY as_of) AS prev_h FROM hh),
kp AS (SELECT * FROM lg WHERE prev_h IS NULL OR prev_h <> __row_hash),
th AS (SELECT c_custkey, c_mktsegment, tier, as_of, as_of AS __start_at,
  LEAD(as_of) OVER (PARTITION BY c_custkey ORDER BY as_of) AS __end_at,
  LEAD(as_of) OVER (PARTITION BY c_custkey ORDER BY as_of) IS NULL AS __is_current, __row_hash FROM kp)"""


def tier_history(t):
    cy = D.customer_years(t.customer, t.orders)
    return H.scd2_from_log(cy, ["c_custkey"], "as_of", tracked=["c_mktsegment", "tier"])


@register("customer_tier_history", ops=("W4",), sql=f"WITH {TIER_HIST_SQL} SELECT * FROM th")
def customer_tier_history(spark, sf):
    return tier_history(Tables(spark, sf))


@register("customer_tier_spliced", ops=("ST8", "L20"), sql=f"WITH {TIER_HIST_SQL} SELECT * FROM th")
def customer_tier_spliced(spark, sf):
    """The log in three parts, the latest years first, each spliced into what is there, must give the history of the whole."""
    log = D.customer_years(Tables(spark, sf).customer, Tables(spark, sf).orders)
    year = F.year("as_of")
    state = None
    for part in (year >= 1997, (year < 1997) & (F.pmod(year, F.lit(2)) == 0), (year < 1997) & (F.pmod(year, F.lit(2)) == 1)):
        state = cut_lineage(H.apply_feed(state, log.where(part), ["c_custkey"], ["as_of"], 2, tracked=["c_mktsegment", "tier"]))
    return H.versions(state).select(tier_history(Tables(spark, sf)).columns)


@register("asof_orders_customer", ops=("J9",), sql=f"""WITH {TIER_HIST_SQL}
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, th.tier AS order_tier, th.c_mktsegment
FROM orders o LEFT JOIN th ON o.o_custkey = th.c_custkey AND o.o_orderdate >= th.__start_at
  AND (th.__end_at IS NULL OR o.o_orderdate < th.__end_at)""")
def asof_orders_customer(spark, sf):
    t = Tables(spark, sf)
    j = H.join_asof_history(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), cut_lineage(tier_history(t)),
                            {"o_custkey": "c_custkey"}, "o_orderdate")
    return j.select("o_orderkey", "o_custkey", "o_orderdate", F.col("tier").alias("order_tier"), "c_mktsegment")


@register("history_validate", ops=("W8",), sql=f"""WITH {TIER_HIST_SQL},
n AS (SELECT *, LEAD(__start_at) OVER (PARTITION BY c_custkey ORDER BY __start_at, __row_hash) AS nx FROM th)
SELECT c_custkey, CAST(COUNT(*) AS BIGINT) AS n_versions,
  CAST(SUM(CASE WHEN __is_current THEN 1 ELSE 0 END) AS BIGINT) AS n_current,
  CAST(SUM(CASE WHEN nx IS NOT NULL AND (__end_at IS NULL OR nx < __end_at) THEN 1 ELSE 0 END) AS BIGINT) AS n_overlaps,
  CAST(SUM(CASE WHEN nx IS NOT NULL AND __end_at IS NOT NULL AND nx > __end_at THEN 1 ELSE 0 END) AS BIGINT) AS n_gaps,
  CAST(SUM(CASE WHEN (__end_at IS NULL) <> __is_current THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_open,
  (SUM(CASE WHEN __is_current THEN 1 ELSE 0 END) = 1
   AND SUM(CASE WHEN nx IS NOT NULL AND (__end_at IS NULL OR nx <> __end_at) THEN 1 ELSE 0 END) = 0
   AND SUM(CASE WHEN (__end_at IS NULL) <> __is_current THEN 1 ELSE 0 END) = 0) AS ok
FROM n GROUP BY c_custkey""")
def history_validate(spark, sf):
    return H.validate_history(tier_history(Tables(spark, sf)), ["c_custkey"])


@register("version_no", ops=("W7",), sql=f"""WITH {TIER_HIST_SQL}
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY __start_at, __row_hash) AS BIGINT) AS version_no
FROM th""")
def version_no(spark, sf):
    return H.version_no(tier_history(Tables(spark, sf)), ["c_custkey"])


# ---------------------------------------------------------------- SCD2 with event time

def _with_last_order(t, snap, day: int):
    last = D.day_orders(t.orders, day).groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order_ts"))
    return snap.join(last, snap.c_custkey == last.o_custkey).drop("o_custkey")


def _last_sql(name: str, day: int) -> str:
    return f"""{name} AS (SELECT d.*, l.last_order_ts FROM d{day} d JOIN (SELECT o_custkey, MAX(o_orderdate) AS last_order_ts
  FROM orders WHERE {D.day_filter_sql(day)} GROUP BY o_custkey) l ON d.c_custkey = l.o_custkey)"""


@register("scd2_event_time", ops=("L12", "L8"), sql=f"""WITH {D.DAYS_SQL},
{_last_sql("e1", 1)}, {_last_sql("e2", 2)},
h1 AS (SELECT *, {D.SNAP_HASH_SQL} AS __row_hash FROM e1),
b AS (SELECT *, {D.SNAP_HASH_SQL} AS __row_hash FROM e2),
dec AS (SELECT COALESCE(b.c_custkey, h1.c_custkey) AS c_custkey, b.last_order_ts AS b_eff,
  CASE WHEN h1.c_custkey IS NULL THEN 'new' WHEN b.c_custkey IS NULL THEN 'absent'
       WHEN b.last_order_ts < h1.last_order_ts THEN 'rejected'
       WHEN b.__row_hash <> h1.__row_hash THEN 'changed' ELSE 'unchanged' END AS act
  FROM b FULL OUTER JOIN h1 ON b.c_custkey = h1.c_custkey)
SELECT {SNAP}, last_order_ts, last_order_ts AS __start_at,
  CASE WHEN act = 'changed' THEN b_eff ELSE CAST(NULL AS TIMESTAMP) END AS __end_at,
  act <> 'changed' AS __is_current, __row_hash FROM h1 JOIN dec USING (c_custkey)
UNION ALL
SELECT {SNAP}, last_order_ts, last_order_ts, CAST(NULL AS TIMESTAMP), TRUE, __row_hash
FROM b JOIN dec USING (c_custkey) WHERE act IN ('new', 'changed')""")
def scd2_event_time(spark, sf):
    t = Tables(spark, sf)
    e1 = _with_last_order(t, D.day1(t), 1)
    e2 = _with_last_order(t, D.day2(t), 2)
    h1, _, _ = H.scd2_merge(None, e1, K, D.T1, tracked=D.SNAP_TRACKED, event_ts_col="last_order_ts")
    h2, _, _ = H.scd2_merge(h1, e2, K, D.T2, tracked=D.SNAP_TRACKED, event_ts_col="last_order_ts")
    return h2


# ---------------------------------------------------------------- what a merge leaves out

REJECT_UNTIL = "2000-07-01 00:00:00"


@register("scd2_rejects", ops=("L8", "L12", "L23", "P7"), sql=f"""WITH r AS (
  SELECT c.c_custkey, o_orderpriority AS v, o_orderdate AS ts, o_orderkey FROM orders o
  LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c ON o.o_custkey = c.c_custkey),
cur AS (SELECT c_custkey, MAX(ts) AS since FROM r WHERE ts >= TIMESTAMP '{D.CUT}' AND c_custkey IS NOT NULL GROUP BY c_custkey),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY ts DESC, v DESC, o_orderkey DESC) AS rn
  FROM r WHERE ts < TIMESTAMP '{REJECT_UNTIL}')
SELECT b.c_custkey, v, ts, o_orderkey, CASE WHEN b.c_custkey IS NULL THEN 'MISSING_KEY' WHEN rn > 1 THEN 'DUP_KEY'
  ELSE 'LATE_DATA' END AS reject_reason
FROM b LEFT JOIN cur ON b.c_custkey = cur.c_custkey WHERE b.c_custkey IS NULL OR rn > 1 OR ts < since""")
def scd2_rejects(spark, sf):
    r = D.silver_orders(Tables(spark, sf)).select("c_custkey", F.col("o_orderpriority").alias("v"),
                                                  F.col("o_orderdate").alias("ts"), "o_orderkey")
    h, _, _ = H.scd2_merge(None, r.where(F.col("ts") >= F.lit(D.CUT).cast("timestamp_ntz")), ["c_custkey"], D.T2,
                           tracked=["v"], event_ts_col="ts")
    late = r.where(F.col("ts") < F.lit(REJECT_UNTIL).cast("timestamp_ntz"))
    return H.scd2_merge(h, late, ["c_custkey"], D.T2, tracked=["v"], event_ts_col="ts").rejects


CDC_THIRDS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


@register("apply_changes_replayed", ops=("L20", "L21"), sql=f"""SELECT event_id, ts, user_id, event_type,
  CAST(value AS DECIMAL(18,2)) AS value, props FROM (
  SELECT *, {CDC_OP} AS op, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn = 1 AND op <> 'D'""")
def apply_changes_replayed(spark, sf):
    """All batches, out of order and some twice: the tombstones make the result that of the whole feed."""
    ch = _changes(Tables(spark, sf))
    a, b = (F.lit(x).cast("timestamp_ntz") for x in CDC_THIRDS)
    parts = [ch.where(F.col("ts") < a), ch.where((F.col("ts") >= a) & (F.col("ts") < b)), ch.where(F.col("ts") >= b)]
    state = None
    for i in (2, 0, 1, 0, 2):
        state = M.apply_changes(state, parts[i], ["user_id"], ["ts", "event_id"], "op", tombstones=True)
    return M.live_rows(state).select("event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"),
                                     "props")


# ---------------------------------------------------------------- a key of two columns

def _segments(t, day: int):
    return D.customer_day(t.customer, t.orders, day).groupBy("c_nationkey", "c_mktsegment").agg(
        F.sum(F.when(F.col("tier") == "GOLD", 1).otherwise(0)).cast("int").alias("n_gold"))


SEG_HASH = row_hash_sql(["n_gold"])


@register("scd2_two_keys", ops=("L8", "L13"), sql=f"""WITH {D.DAYS_SQL},
s1 AS (SELECT c_nationkey, c_mktsegment, CAST(SUM(CASE WHEN tier = 'GOLD' THEN 1 ELSE 0 END) AS INTEGER) AS n_gold FROM d1 GROUP BY 1, 2),
s2 AS (SELECT c_nationkey, c_mktsegment, CAST(SUM(CASE WHEN tier = 'GOLD' THEN 1 ELSE 0 END) AS INTEGER) AS n_gold FROM d2 GROUP BY 1, 2),
h AS (SELECT *, {SEG_HASH} AS __row_hash FROM s1), b AS (SELECT *, {SEG_HASH} AS __row_hash FROM s2)
SELECT h.c_nationkey, h.c_mktsegment, h.n_gold, TIMESTAMP '{D.T1}' AS __start_at,
  CASE WHEN b.n_gold <> h.n_gold THEN TIMESTAMP '{D.T2}' ELSE CAST(NULL AS TIMESTAMP) END AS __end_at,
  COALESCE(b.n_gold = h.n_gold, TRUE) AS __is_current, h.__row_hash
FROM h LEFT JOIN b ON h.c_nationkey = b.c_nationkey AND h.c_mktsegment = b.c_mktsegment
UNION ALL SELECT b.c_nationkey, b.c_mktsegment, b.n_gold, TIMESTAMP '{D.T2}', CAST(NULL AS TIMESTAMP), TRUE, b.__row_hash
FROM b LEFT JOIN h ON h.c_nationkey = b.c_nationkey AND h.c_mktsegment = b.c_mktsegment WHERE h.n_gold IS NULL OR h.n_gold <> b.n_gold""")
def scd2_two_keys(spark, sf):
    t = Tables(spark, sf)
    keys = ["c_nationkey", "c_mktsegment"]
    h, _, _ = H.scd2_merge(None, _segments(t, 1), keys, D.T1)
    return H.scd2_merge(h, _segments(t, 2), keys, D.T2).history
