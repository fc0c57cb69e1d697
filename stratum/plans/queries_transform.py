"""Registered queries: lineage, config-as-data, canonical mapping, cleansing,
sources (incremental / CDC / Kafka payloads / union), arrivals, Gold."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import standardize as S
from ..operators import config as C
from ..operators import evolve as E
from ..operators import lineage as L
from ..operators import masking as MK
from ..operators import transform as TR
from ..sources import readers as RD
from ..streaming import streams as ST
from . import derived as D
from .catalog import Tables, register
from .queries_quality import LINE_TOTAL_SQL, line_total

# ---------------------------------------------------------------- lineage graph


def data_edges(t):
    """Lineage of the TPC-H-style hierarchy: line -> order -> customer -> nation -> region."""
    li = t.lineitem.select(F.concat(F.lit("L:"), F.col("l_orderkey").cast("string"), F.lit(":"),
                                    F.col("l_linenumber").cast("string")).alias("node"),
                           F.concat(F.lit("O:"), F.col("l_orderkey").cast("string")).alias("parent"))
    o = t.orders.select(F.concat(F.lit("O:"), F.col("o_orderkey").cast("string")).alias("node"),
                        F.concat(F.lit("C:"), F.col("o_custkey").cast("string")).alias("parent"))
    c = t.customer.select(F.concat(F.lit("C:"), F.col("c_custkey").cast("string")).alias("node"),
                          F.concat(F.lit("N:"), F.col("c_nationkey").cast("string")).alias("parent"))
    n = t.nation.select(F.concat(F.lit("N:"), F.col("n_nationkey").cast("string")).alias("node"),
                        F.concat(F.lit("R:"), F.col("n_regionkey").cast("string")).alias("parent"))
    return li.unionByName(o).unionByName(c).unionByName(n)


EDGES_SQL = """e AS (SELECT DISTINCT node, ancestor FROM (
  SELECT 'L:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS node,
         'O:' || CAST(l_orderkey AS VARCHAR) AS ancestor FROM lineitem
  UNION ALL SELECT 'O:' || CAST(o_orderkey AS VARCHAR), 'C:' || CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'C:' || CAST(c_custkey AS VARCHAR), 'N:' || CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'N:' || CAST(n_nationkey AS VARCHAR), 'R:' || CAST(n_regionkey AS VARCHAR) FROM nation))"""

CLOSURE_SQL = f"""WITH RECURSIVE {EDGES_SQL},
cl(node, ancestor, depth, path) AS (
  SELECT node, ancestor, 1, [node, ancestor] FROM e
  UNION ALL
  SELECT cl.node, e.ancestor, cl.depth + 1, list_append(cl.path, e.ancestor) FROM cl JOIN e ON cl.ancestor = e.node)"""


@register("lineage_closure", ops=("G12",), sql=CLOSURE_SQL + """
SELECT node, ancestor, CAST(min({'d': depth, 'p': path}).d AS INTEGER) AS depth, min({'d': depth, 'p': path}).p AS path
FROM cl GROUP BY node, ancestor""")
def lineage_closure(spark, sf):
    return L.transitive_closure(data_edges(Tables(spark, sf)))


def trade_edges(t):
    """Each supplying nation depends on the foreign nation it sells most to. Every nation has one edge, so there are cycles."""
    li = t.lineitem.select("l_orderkey", "l_suppkey", line_total().alias("v"))
    sold = (li.groupBy("l_orderkey", "l_suppkey").agg(F.sum("v").alias("v"))
            .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", "l_suppkey").agg(F.sum("v").alias("v"))
            .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .where("c_nationkey <> s_nationkey").groupBy("s_nationkey", "c_nationkey").agg(F.sum("v").alias("v")))
    best = sold.groupBy("s_nationkey").agg(F.max(F.struct("v", "c_nationkey")).alias("m"))
    name = lambda c: F.concat(F.lit("N:"), c.cast("string"))
    return best.select(name(F.col("s_nationkey")).alias("node"), name(F.col("m.c_nationkey")).alias("parent"))


TRADE_SQL = f"""sold AS (SELECT s_nationkey AS s, c_nationkey AS c, SUM({LINE_TOTAL_SQL}) AS v
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
te AS (SELECT 'N:' || CAST(s AS VARCHAR) AS node, 'N:' || CAST(c AS VARCHAR) AS ancestor FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY s ORDER BY v DESC, c DESC) AS rn FROM sold) WHERE rn = 1)"""


@register("dependency_cycles", ops=("G14",), sql=f"""WITH RECURSIVE {TRADE_SQL},
w(node, ancestor, depth, path) AS (SELECT node, ancestor, 1, [node, ancestor] FROM te
  UNION ALL SELECT w.node, te.ancestor, w.depth + 1, list_append(w.path, te.ancestor) FROM w JOIN te ON w.ancestor = te.node
  WHERE w.ancestor <> w.node AND w.depth < 26)
SELECT node, ancestor, CAST(depth AS INTEGER) AS depth, path FROM w WHERE node = ancestor""")
def dependency_cycles(spark, sf):
    return L.find_cycles(trade_edges(Tables(spark, sf)))


@register("build_levels", ops=("G15",), sql=CLOSURE_SQL + """
SELECT node, CAST(MAX(depth) AS INTEGER) AS level, FALSE AS blocked_by_cycle FROM cl GROUP BY node
UNION ALL SELECT DISTINCT ancestor, 0, FALSE FROM e WHERE ancestor NOT IN (SELECT node FROM e)""")
def build_levels(spark, sf):
    return L.build_levels(data_edges(Tables(spark, sf)))


@register("build_levels_blocked", ops=("G15",), sql=f"""WITH {TRADE_SQL}
SELECT 'R:' || CAST(r_regionkey AS VARCHAR) AS node, 0 AS level, FALSE AS blocked_by_cycle FROM region
WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
UNION ALL SELECT 'N:' || CAST(n_nationkey AS VARCHAR),
  CASE WHEN t.node IS NULL THEN 1 END, t.node IS NOT NULL
FROM nation LEFT JOIN te t ON t.node = 'N:' || CAST(n_nationkey AS VARCHAR)""")
def build_levels_blocked(spark, sf):
    """Nations that trade are on a cycle or lead to one; regions stay free."""
    t = Tables(spark, sf)
    to_region = t.nation.select(F.concat(F.lit("N:"), F.col("n_nationkey").cast("string")).alias("node"),
                                F.concat(F.lit("R:"), F.col("n_regionkey").cast("string")).alias("parent"))
    return L.build_levels(trade_edges(t).unionByName(to_region))


@register("lineage_of_orders_upstream", ops=("G12",), sql="""SELECT 'C:' || CAST(c_custkey AS VARCHAR) AS node,
  'N:' || CAST(c_nationkey AS VARCHAR) AS ancestor, 1 AS depth FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'C:' || CAST(c_custkey AS VARCHAR), 'R:' || CAST(n_regionkey AS VARCHAR), 2
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'""")
def lineage_of_orders_upstream(spark, sf):
    """What one segment's customers depend on: the walk begins at them, not at every node."""
    t = Tables(spark, sf)
    c = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("C:"), F.col("c_custkey").cast("string")).alias("node"),
        F.concat(F.lit("N:"), F.col("c_nationkey").cast("string")).alias("parent"))
    n = t.nation.select(F.concat(F.lit("N:"), F.col("n_nationkey").cast("string")).alias("node"),
                        F.concat(F.lit("R:"), F.col("n_regionkey").cast("string")).alias("parent"))
    got = L.transitive_closure(c.unionByName(n))
    return got.where(F.col("node").startswith("C:")).select("node", "ancestor", "depth")


# ---------------------------------------------------------------- config as data (EAV)

EAV_TS = "2024-01-01 00:00:00"
EAV_LOADED = "2024-01-02 03:04:05"
EAV_COLS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
EAV_TYPES = {"c_name": "string", "c_nationkey": "int", "c_acctbal": "decimal(18,2)", "c_mktsegment": "string"}


def _eav_sql() -> str:
    parts = []
    for c in EAV_COLS:
        v = f"CAST({c} AS VARCHAR)"
        parts.append(f"""SELECT c_custkey AS JOB_SK, 'customer' AS PARAM_ZONE, '{c}' AS PARAM_NM, {v} AS PARAM_VAL,
  TIMESTAMP '{EAV_TS}' AS EFF_STRT_DTS, CAST(NULL AS TIMESTAMP) AS EFF_END_DTS, TRUE AS CURR_FLG, 1 AS REC_VER_NO,
  TIMESTAMP '{EAV_LOADED}' AS LOAD_DTS, 'loader' AS LOAD_USER
FROM customer WHERE {c} IS NOT NULL""")
    return "\nUNION ALL\n".join(parts)


@register("eav_unpivot", ops=("A24", "F8"), sql=_eav_sql())
def eav_unpivot(spark, sf):
    return C.to_param_rows(Tables(spark, sf).customer, "c_custkey", "customer", EAV_COLS, eff_ts=EAV_TS, load_ts=EAV_LOADED, load_user="loader")


@register("eav_pivot", ops=("A23",), sql="""SELECT c_custkey AS JOB_SK, c_name, c_nationkey,
  CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer""")
def eav_pivot(spark, sf):
    eav = C.to_param_rows(Tables(spark, sf).customer, "c_custkey", "customer", EAV_COLS, eff_ts=EAV_TS)
    return C.from_param_rows(eav, EAV_TYPES)


# ---------------------------------------------------------------- transforms and canonical model

SILVER_SQL = ("SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate "
              "FROM {orders} WHERE o_orderstatus = 'F'")


@register("sql_transform", ops=("P1", "P2"), sql=SILVER_SQL.replace("{orders}", "orders"))
def sql_transform(spark, sf):
    out = TR.sql_transform(spark, SILVER_SQL, orders=Tables(spark, sf).orders)
    return TR.python_transform(out, lambda df: df.select(*df.columns))


PARTY_MAP = {"party_id": "concat('P-', CAST(c_custkey AS STRING))", "name": "c_name",
             "source_party_id": "CAST(c_custkey AS STRING)"}
PARTY_DEFAULTS = {"party_type": "ORGANIZATION", "source_system": "tpch", "preferred_language": "en"}
_DUCK = {"string": "VARCHAR", "date": "DATE", "int": "INTEGER", "decimal(18,2)": "DECIMAL(18,2)"}


def _canonical_sql(entity: str, exprs: dict, defaults: dict, table: str, drop=("party_role",)) -> str:
    cols = []
    for name, typ in TR.CANONICAL[entity]:
        if name in drop:
            continue
        if name in exprs:
            cols.append(f"TRY_CAST({exprs[name]} AS {_DUCK[typ]}) AS {name}")
        elif name in defaults:
            cols.append(f"CAST('{defaults[name]}' AS {_DUCK[typ]}) AS {name}")
        else:
            cols.append(f"CAST(NULL AS {_DUCK[typ]}) AS {name}")
    return f"SELECT {', '.join(cols)} FROM {table}"


@register("canonical_party", ops=("P3", "J12"), sql=_canonical_sql(
    "party", {"party_id": "'P-' || CAST(c_custkey AS VARCHAR)", "name": "c_name",
              "source_party_id": "CAST(c_custkey AS VARCHAR)"}, PARTY_DEFAULTS, "customer"))
def canonical_party(spark, sf):
    p = TR.map_to_canonical(Tables(spark, sf).customer, PARTY_MAP, "party", PARTY_DEFAULTS)
    return p.drop("party_role")


POLICY_MAP = {
    "policy_id": "concat('POL-', CAST(o_orderkey AS STRING))",
    "policy_number": "concat('PN-', lpad(CAST(o_orderkey AS STRING), 9, '0'))",
    "party_id": "concat('P-', CAST(o_custkey AS STRING))",
    "product_type": "o_orderpriority",
    "status": "CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'PENDING' END",
    "effective_date": "CAST(o_orderdate AS DATE)",
    "expiration_date": "date_add(CAST(o_orderdate AS DATE), 365)",
    "issue_date": "CAST(o_orderdate AS DATE)",
    "premium_amount": "o_totalprice",
    "source_policy_id": "CAST(o_orderkey AS STRING)",
}
POLICY_DEFAULTS = {"currency": "USD", "payment_frequency": "ANNUAL", "source_system": "tpch"}


@register("canonical_policy", ops=("P3",), sql=_canonical_sql("policy", {
    "policy_id": "'POL-' || CAST(o_orderkey AS VARCHAR)",
    "policy_number": "'PN-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')",
    "party_id": "'P-' || CAST(o_custkey AS VARCHAR)", "product_type": "o_orderpriority",
    "status": "CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'PENDING' END",
    "effective_date": "CAST(o_orderdate AS DATE)", "expiration_date": "CAST(o_orderdate AS DATE) + 365",
    "issue_date": "CAST(o_orderdate AS DATE)", "premium_amount": "o_totalprice",
    "source_policy_id": "CAST(o_orderkey AS VARCHAR)"}, POLICY_DEFAULTS, "orders"))
def canonical_policy(spark, sf):
    return TR.map_to_canonical(Tables(spark, sf).orders, POLICY_MAP, "policy", POLICY_DEFAULTS)


SEGMENT_CODES = {"AUTOMOBILE": "AUTO", "BUILDING": "BLDG", "FURNITURE": "FURN", "HOUSEHOLD": "HHLD",
                 "MACHINERY": "MACH"}


@register("cleanse_customer", ops=("P4",), sql="""SELECT c_custkey, upper(trim(c_name)) AS c_name, c_nationkey,
  c_acctbal, CASE nullif(trim(c_mktsegment), '') """ + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_CODES.items()) + """ ELSE nullif(trim(c_mktsegment), '') END
  AS c_mktsegment FROM customer""")
def cleanse_customer(spark, sf):
    c = Tables(spark, sf).customer
    return TR.cleanse(c, trim=["c_name"], upper=["c_name"], blank_to_null=["c_mktsegment"],
                      code_maps={"c_mktsegment": SEGMENT_CODES})


PHONE = MK.DETECTORS["PHONE"]


@register("phone_standardize", ops=("F5",), sql=f"""WITH p AS (SELECT doc_id, unnest(regexp_extract_all(text, '{PHONE}')) AS raw
  FROM documents), d AS (SELECT doc_id, raw, regexp_replace(raw, '[^0-9]', '', 'g') AS dg FROM p),
f AS (SELECT doc_id, raw, CASE WHEN length(dg) = 10 THEN '1' || dg ELSE dg END AS fl2 FROM d)
SELECT doc_id, raw, CASE WHEN length(fl2) < 11 THEN NULL ELSE '+' || substr(fl2, 1, length(fl2) - 10) || '-'
  || substr(fl2, length(fl2) - 9, 3) || '-' || substr(fl2, length(fl2) - 6, 3) || '-' || right(fl2, 4) END AS phone
FROM f""")
def phone_standardize(spark, sf):
    d = Tables(spark, sf).documents
    p = d.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(PHONE), 0)).alias("raw"))
    return p.select("doc_id", "raw", S.phone_e164("raw").alias("phone"))


@register("policy_number_parse", ops=("F7",), sql="""SELECT c_custkey,
  nullif(upper(regexp_extract(trim(c_name), '^([A-Za-z]+)[#-]?0*([0-9]+)$', 1)), '') AS prefix,
  CAST(nullif(regexp_extract(trim(c_name), '^([A-Za-z]+)[#-]?0*([0-9]+)$', 2), '') AS BIGINT) AS number,
  CASE WHEN nullif(upper(regexp_extract(trim(c_name), '^([A-Za-z]+)[#-]?0*([0-9]+)$', 1)), '') IS NOT NULL THEN
    upper(regexp_extract(trim(c_name), '^([A-Za-z]+)[#-]?0*([0-9]+)$', 1)) || '-' ||
    lpad(regexp_extract(trim(c_name), '^([A-Za-z]+)[#-]?0*([0-9]+)$', 2), 9, '0') END AS normalized
FROM customer""")
def policy_number_parse(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", S.parse_policy_number("c_name").alias("p")).select("c_custkey", "p.*")


# ---------------------------------------------------------------- sources

@register("union_null_fill", ops=("U2", "S16"), sql="""SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey,
  CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_mktsegment AS segment, 'customer' AS _source,
  CAST(NULL AS VARCHAR) AS _union_null_fill FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)), NULL, 'supplier', 'segment' FROM supplier""")
def union_null_fill(spark, sf):
    t = Tables(spark, sf)
    a = t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").cast("decimal(18,2)")
                          .alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                          F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").cast("decimal(18,2)")
                          .alias("balance"))
    return RD.union_sources([a, b], allow_mismatch=True, source_names=["customer", "supplier"])


EV_OUT = ["event_id", "ts", "user_id", "event_type", "props"]
EV_OUT_SQL = "event_id, ts, user_id, event_type, props, CAST(value AS DECIMAL(18,2)) AS value"


def _ev_out(df, *extra):
    return df.select(*EV_OUT, F.col("value").cast("decimal(18,2)").alias("value"), *extra)


LOW_MARK = "2024-01-20 00:00:00"


@register("incremental_events", ops=("S17",), sql=f"SELECT {EV_OUT_SQL} FROM events WHERE ts > TIMESTAMP '{LOW_MARK}'")
def incremental_events(spark, sf):
    return _ev_out(RD.read_incremental(Tables(spark, sf).events, "ts", low=LOW_MARK))


@register("events_high_water_mark", ops=("S17",), sql=f"""SELECT MAX(ts) AS high_water_mark FROM events
WHERE ts > TIMESTAMP '{LOW_MARK}'""")
def events_high_water_mark(spark, sf):
    return RD.high_water_mark(RD.read_incremental(Tables(spark, sf).events, "ts", low=LOW_MARK), "ts")


@register("business_day_events", ops=("S18",), sql=f"""SELECT {EV_OUT_SQL} FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'""")
def business_day_events(spark, sf):
    return _ev_out(RD.business_day_window(Tables(spark, sf).events, "ts", "2024-01-15 00:00:00",
                                          "2024-01-16 00:00:00"))


EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
EPOCH_TEXT = "1970-01-01 00:00:00"


@register("cdc_parse_events", ops=("S19", "F2"), sql=f"""SELECT {EV_OUT_SQL},
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op,
  CAST(epoch_us(ts) // 1000 AS BIGINT) AS _seq FROM events""")
def cdc_parse_events(spark, sf):
    e = Tables(spark, sf).events
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    raw = RD.to_cdc_events(e.select(*[f.name for f in EVENT_SCHEMA.fields]), op,
                           F.timestamp_diff("MILLISECOND", F.lit(EPOCH_TEXT).cast("timestamp_ntz"), F.col("ts")))
    return _ev_out(RD.parse_cdc(raw, "value", EVENT_SCHEMA, ["event_id"]), "_op", "_seq")


@register("kafka_parse_events", ops=("ST3",), sql=f"SELECT {EV_OUT_SQL}, 'events' AS topic, event_id AS offset FROM events")
def kafka_parse_events(spark, sf):
    e = Tables(spark, sf).events
    records = ST.as_kafka_records(e, key_col="user_id", topic="events", offset_col="event_id")
    parsed = ST.parse_kafka_json(records, EVENT_SCHEMA)
    return _ev_out(parsed, "topic", "offset")


@register("arrivals_tumbling", ops=("ST15",), sql="""SELECT date_trunc('day', ts) AS window_start,
  date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, CAST(COUNT(*) AS BIGINT) AS n_events
FROM events GROUP BY 1, 2, 3""")
def arrivals_tumbling(spark, sf):
    return ST.arrivals(Tables(spark, sf).events, "ts", "1 day", ["event_type"])


@register("arrival_gaps", ops=("ST15",), sql="""WITH a AS (SELECT DISTINCT event_type, time_bucket(INTERVAL 15 MINUTE, ts) AS w FROM events),
s AS (SELECT event_type, unnest(generate_series(min(w), max(w), INTERVAL 15 MINUTE)) AS window_start FROM a GROUP BY event_type)
SELECT s.event_type, s.window_start, s.window_start + INTERVAL 15 MINUTE AS window_end
FROM s ANTI JOIN a ON a.event_type = s.event_type AND a.w = s.window_start""")
def arrival_gaps(spark, sf):
    return ST.arrival_gaps(Tables(spark, sf).events, "ts", "15 minutes", ["event_type"])


DAY1_OLD = "c_custkey, c_name, c_nationkey, c_mktsegment, spend"


@register("evolve_additive", ops=("E4", "E5", "E10"), sql=f"""WITH {D.DAYS_SQL}
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, spend, CAST(NULL AS VARCHAR) AS tier
FROM d1
UNION ALL SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT), c_mktsegment, NULL, tier FROM d2""")
def evolve_additive(spark, sf):
    t = Tables(spark, sf)
    target = D.day1(t).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "spend")
    batch = D.day2(t).select("c_custkey", "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
                             "c_mktsegment", "tier")
    return E.evolve_union(target, batch)


# ---------------------------------------------------------------- Gold

GOLD_DIMS = ["r_name", "c_mktsegment"]


def policies(t):
    """Premium, losses and policy counts per customer, with its region and segment.

    Losses are summed per order (partial aggregate over lines), orders are
    summed per customer before the customer dimension is joined, so the join
    moves one row per customer rather than one per order.
    """
    li = t.lineitem
    loss = li.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", line_total()).otherwise(F.lit(0))).alias("loss"),
        F.max(F.col("l_returnflag") == "R").alias("has_claim"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    per_cust = (o.join(loss, o.o_orderkey == loss.l_orderkey, "left")
                .groupBy("o_custkey").agg(
                    F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("premium"),
                    F.sum(F.coalesce("loss", F.lit(0))).alias("loss"),
                    F.count(F.lit(1)).alias("n_policies"),
                    F.sum(F.when(F.coalesce("has_claim", F.lit(False)), 1).otherwise(0)).alias("n_claims")))
    geo = t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey).select("n_nationkey", "r_name")
    cust = t.customer.join(geo, t.customer.c_nationkey == geo.n_nationkey).select("c_custkey", "c_mktsegment", "r_name")
    return per_cust.join(cust, per_cust.o_custkey == cust.c_custkey).select(
        "r_name", "c_mktsegment", "premium", "loss", "n_policies", "n_claims")


GOLD_SQL = f"""WITH loss AS (SELECT l_orderkey, SUM(CASE WHEN l_returnflag = 'R' THEN {LINE_TOTAL_SQL} ELSE 0 END) AS loss,
  MAX(l_returnflag = 'R') AS has_claim FROM lineitem GROUP BY l_orderkey),
p AS (SELECT o.o_orderkey, r.r_name, c.c_mktsegment, o.o_totalprice, COALESCE(l.loss, 0) AS loss,
  COALESCE(l.has_claim, FALSE) AS has_claim
  FROM orders o LEFT JOIN loss l ON o.o_orderkey = l.l_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
g AS (SELECT r_name, c_mktsegment, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS premium,
  CAST(SUM(loss) AS DECIMAL(38,2)) AS losses, CAST(COUNT(*) AS BIGINT) AS n_policies,
  CAST(SUM(CASE WHEN has_claim THEN 1 ELSE 0 END) AS BIGINT) AS n_policies_with_claims
  FROM p GROUP BY ROLLUP (r_name, c_mktsegment))
SELECT COALESCE(r_name, 'ALL') AS r_name, COALESCE(c_mktsegment, 'ALL') AS c_mktsegment, premium, losses,
  CAST(CASE WHEN premium > 0 THEN ROUND(CAST(losses AS DOUBLE) / CAST(premium AS DOUBLE), 6) END AS DECIMAL(18,6)) AS loss_ratio,
  n_policies, n_policies_with_claims,
  CAST(ROUND(n_policies_with_claims / n_policies, 6) AS DECIMAL(18,6)) AS claim_frequency FROM g"""


@register("gold_loss_ratio", ops=("A18", "J12"), sql=GOLD_SQL)
def gold_loss_ratio(spark, sf):
    return TR.gold_summary(policies(Tables(spark, sf)), GOLD_DIMS, "premium", "loss", n_policies="n_policies",
                           n_claims="n_claims")


# ---------------------------------------------------------------- joins for lineage and cost

@register("customers_with_orders", ops=("J6",), sql="""SELECT c_custkey, c_name FROM customer c
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def customers_with_orders(spark, sf):
    t = Tables(spark, sf)
    open_orders = t.orders.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(open_orders, "c_custkey", "left_semi").select("c_custkey", "c_name")


@register("order_lineage", ops=("J7",), sql="""SELECT DISTINCT l.l_orderkey, o.o_custkey, c.c_nationkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey""")
def order_lineage(spark, sf):
    t = Tables(spark, sf)
    # one row per order before the joins, so there is nothing to make distinct after them
    j = (t.lineitem.select("l_orderkey").distinct()
         .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")))
    return j.select("l_orderkey", "o_custkey", "c_nationkey")


@register("cost_attribution", ops=("J11", "A12"), sql="""SELECT s.s_nationkey AS nationkey,
  CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS list_cost,
  CAST(COUNT(*) AS BIGINT) AS n_lines
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY s.s_nationkey""")
def cost_attribution(spark, sf):
    # Usage x list price x attribution key. The price and supplier tables grow
    # with the data, so no broadcast hint: AQE broadcasts them only after
    # measuring their size at run time.
    t = Tables(spark, sf)
    j = (t.lineitem.select("l_partkey", "l_suppkey", "l_quantity")
         .join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
         .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    cost = F.col("l_quantity").cast("decimal(18,2)") * F.col("p_retailprice").cast("decimal(18,2)")
    return j.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.sum(cost).cast("decimal(38,2)").alias("list_cost"), F.count(F.lit(1)).cast("bigint").alias("n_lines"))


@register("drift_audit", ops=("A22",), sql="""SELECT CAST(COUNT(*) AS BIGINT) AS drift_row_count,
  'n_name,n_regionkey' AS columns_added FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def drift_audit(spark, sf):
    from ..operators.quarantine import capture_drift
    from .queries_quality import _drifted
    t = Tables(spark, sf)
    _, q = capture_drift(_drifted(t), t.customer.columns)
    s = E.drift_summary(q, ["n_name", "n_regionkey"])
    return s.select("drift_row_count", F.concat_ws(",", "columns_added").alias("columns_added"))


@register("dq_policy_rules", ops=("Q12",), sql="""SELECT 'policy_dates' AS rule_id, CAST(COUNT(*) AS BIGINT) AS total_count,
  CAST(SUM(CASE WHEN COALESCE(o_orderdate <= x, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS failed_count
FROM orders LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS x FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def dq_policy_rules(spark, sf):
    """The policy's own date rule, on orders that begin at their date and end with their first shipment."""
    from ..operators import quality as Q
    t = Tables(spark, sf)
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("expiration_date"))
    pol = t.orders.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("effective_date", F.col("o_orderdate"))
    rules = [Q.Rule("policy_dates", "CUSTOM_SQL", rule_expression=e) for e in Q.DEFAULT_ENTITY_RULES["policy"]]
    return Q.evaluate(pol, rules).select("rule_id", "total_count", "failed_count")


@register("dq_claim_rules", ops=("Q12",), sql="""WITH c AS (SELECT o_orderdate AS loss_date,
  l_shipdate - INTERVAL 20 DAY AS report_date, CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER) - 40) END AS close_date
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')
SELECT 'claim_1' AS rule_id, CAST(COUNT(*) AS BIGINT) AS total_count,
  CAST(SUM(CASE WHEN COALESCE(close_date IS NULL OR close_date >= loss_date, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS failed_count FROM c
UNION ALL SELECT 'claim_2', CAST(COUNT(*) AS BIGINT), CAST(SUM(CASE WHEN COALESCE(report_date >= loss_date, FALSE) THEN 0 ELSE 1 END) AS BIGINT) FROM c""")
def dq_claim_rules(spark, sf):
    """The claim's date rules, on returned lines as claims: lost when ordered, reported before the shipment's date, closed around it if at all."""
    from ..operators import quality as Q
    t = Tables(spark, sf)
    j = t.lineitem.where("l_returnflag = 'R'").join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    claims = j.selectExpr("o_orderdate AS loss_date", "l_shipdate - INTERVAL 20 DAYS AS report_date",
                          "if(l_linestatus = 'F', l_shipdate + make_dt_interval(cast(l_quantity as int) - 40), null) AS close_date")
    rules = [Q.Rule(f"claim_{i}", "CUSTOM_SQL", rule_expression=e) for i, e in enumerate(Q.DEFAULT_ENTITY_RULES["claim"], 1)]
    return Q.evaluate(claims, rules).select("rule_id", "total_count", "failed_count")


def _dictionary_sql() -> str:
    from .queries_text import ORDER_COLS, _profile_sql
    counts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct FROM orders"
                                for c in ORDER_COLS)
    return f"""SELECT p.column_name, type, null_count, n_distinct, min, max, CASE WHEN null_count = 0 AND mean IS NOT NULL
  THEN 'NOT_NULL,RANGE' WHEN null_count = 0 THEN 'NOT_NULL' WHEN mean IS NOT NULL THEN 'RANGE' END AS suggested_rules
FROM ({_profile_sql()}) p JOIN ({counts}) d ON p.column_name = d.column_name"""


@register("data_dictionary", ops=("G21",), sql=_dictionary_sql())
def data_dictionary(spark, sf):
    """Profile, exact distinct counts and suggested rules of every column of orders."""
    from ..operators import profile as PR
    from .queries_text import ORDER_COLS
    o = Tables(spark, sf).orders
    prof = PR.profile(o)
    rules = PR.suggest_rules(prof).groupBy("column_name").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("rule_type"))).alias("suggested_rules"))
    return (prof.join(PR.distinct_counts(o, ORDER_COLS), "column_name").join(rules, "column_name", "left")
            .select("column_name", "type", "null_count", "n_distinct", "min", "max", "suggested_rules"))


@register("address_normalize", ops=("F6",), sql="""SELECT c_custkey, upper(regexp_replace(trim(c_name), '\\s+', ' ', 'g')) AS line1,
  upper(trim(n_name)) AS city, upper(trim(r_name)) AS state, 'N' || CAST(n_nationkey AS VARCHAR) || 'R' || CAST(r_regionkey AS VARCHAR) AS postal_code
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def address_normalize(spark, sf):
    from ..functions.standardize import normalize_address
    t = Tables(spark, sf)
    geo = t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey)
    j = t.customer.join(geo, t.customer.c_nationkey == geo.n_nationkey)
    raw = F.struct(F.concat(F.lit("  "), F.lower("c_name"), F.lit("  ")).alias("line1"), F.lit(" ").alias("line2"), F.lower("n_name").alias("city"),
                   F.lower("r_name").alias("state"), F.concat(F.lit("n"), "n_nationkey", F.lit(" r"), "r_regionkey").alias("postal_code"),
                   F.lit(None).cast("string").alias("country"))
    a = normalize_address(raw)
    return j.select("c_custkey", a["line1"].alias("line1"), a["city"].alias("city"), a["state"].alias("state"), a["postal_code"].alias("postal_code"))
