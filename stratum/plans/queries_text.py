"""Registered queries: masking, tokens, personal-data detection, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import maps as MP
from ..operators import evolve as E
from ..operators import masking as MK
from ..operators import profile as PR
from .catalog import Tables, register

SALT = "s4lt"


def _esc(p: str) -> str:
    return p.replace("'", "''")


@register("mask_hash", ops=("M1",), sql=f"""SELECT c_custkey, sha256('{SALT}' || c_name) AS c_name,
  c_nationkey, c_mktsegment FROM customer""")
def mask_hash(spark, sf):
    c = Tables(spark, sf).customer
    return MK.apply_masks(c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
                          [{"column": "c_name", "technique": "HASH", "salt": SALT}])


@register("mask_partial", ops=("M5",), sql="""SELECT c_custkey,
  CASE WHEN length(c_name) > 4 THEN repeat('*', length(c_name) - 4) || right(c_name, 4) ELSE repeat('*', length(c_name)) END
  AS c_name FROM customer""")
def mask_partial(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_name")
    return MK.apply_masks(c, [{"column": "c_name", "technique": "PARTIAL", "keep": 4}])


@register("mask_redact", ops=("M4",), sql="""SELECT c_custkey, '***' AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal,
  c_mktsegment FROM customer""")
def mask_redact(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return MK.apply_masks(c, [{"column": "c_name", "technique": "REDACT"},
                              {"column": "c_acctbal", "technique": "REDACT"}])


TOKEN_SQL = f"'tok_' || substr(sha256('{SALT}' || c_name), 1, 24)"


@register("tokenize_roundtrip", ops=("M2", "M3", "J10"), sql=f"""SELECT c_custkey, {TOKEN_SQL} AS c_name_token,
  c_name AS c_name_clear FROM customer""")
def tokenize_roundtrip(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_name")
    vault = MK.build_vault(c, "c_name", SALT)
    tok = MK.tokenize(c, "c_name", SALT).withColumnRenamed("c_name", "c_name_token")
    return MK.detokenize(tok, vault, "c_name_token", out="c_name_clear")


COLUMN_RULES = [{"column": "c_name", "technique": "PARTIAL", "keep": 4, "exempt_groups": ["pii_reader"]},
                {"column": "c_acctbal", "technique": "REDACT", "exempt_groups": ["pii_reader", "finance"]}]


@register("column_mask_view", ops=("M6",), sql="""SELECT c_custkey,
  repeat('*', greatest(length(c_name) - 4, 0)) || CASE WHEN length(c_name) > 4 THEN right(c_name, 4) ELSE c_name END
  AS c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer""")
def column_mask_view(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    v = MK.column_mask_view(c, COLUMN_RULES, principal_groups=["finance"])
    return v.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))


@register("row_filter", ops=("M7", "P9"), sql="""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def row_filter(spark, sf):
    o = Tables(spark, sf).orders
    f = MK.row_filter(o, "o_orderpriority IN ('1-URGENT', '2-HIGH')", principal_groups=["ops_analyst"],
                      exempt_groups=["admin"])
    return f.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def _redact_sql(col: str) -> str:
    out = col
    for d in MK.REDACT_ORDER:
        out = f"regexp_replace({out}, '{_esc(MK.DETECTORS[d])}', '[{d}]', 'g')"
    return out


@register("pii_redact", ops=("M10",), sql=f"SELECT doc_id, {_redact_sql('text')} AS text FROM documents")
def pii_redact(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", MK.redact_text("text").alias("text"))


def _classify_sql() -> str:
    parts = []
    for d, p in MK.DETECTORS.items():
        n = f"len(regexp_extract_all(text, '{_esc(p)}'))"
        parts.append(f"""SELECT 'text' AS column_name, '{d}' AS detector,
  CAST(SUM(CASE WHEN {n} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_with_hit,
  CAST(SUM({n}) AS BIGINT) AS match_count,
  CAST(ROUND(SUM(CASE WHEN {n} > 0 THEN 1 ELSE 0 END) / COUNT(*), 6) AS DECIMAL(10,6)) AS hit_rate,
  '{MK.DETECTOR_CLASS[d]}' AS classification FROM documents""")
    return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE rows_with_hit > 0"


@register("pii_classify", ops=("M8",), sql=_classify_sql())
def pii_classify(spark, sf):
    return MK.classify_pii(Tables(spark, sf).documents, ["text"])


@register("pii_classify_structured", ops=("M8",), sql=r"""WITH p AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS tax_id,
  'Born ' || CASE WHEN c_custkey % 4 = 0 THEN strftime(born, '%Y/%m/%d') ELSE strftime(born, '%Y-%m-%d') END AS note
  FROM (SELECT *, DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS born FROM customer)),
h AS (SELECT 'tax_id' AS column_name, 'EIN' AS detector, 'RESTRICTED' AS classification, COALESCE(regexp_matches(tax_id, '\b[0-9]{2}-[0-9]{7}\b'), FALSE) AS hit FROM p
  UNION ALL SELECT 'note', 'DOB', 'CONFIDENTIAL', regexp_matches(note, '(dob|born|date of birth)\W{1,3}[0-9]{4}-[0-9]{2}-[0-9]{2}\b', 'i') FROM p)
SELECT column_name, detector, CAST(SUM(CAST(hit AS INTEGER)) AS BIGINT) AS rows_with_hit, CAST(SUM(CAST(hit AS INTEGER)) AS BIGINT) AS match_count,
  CAST(ROUND(AVG(CAST(hit AS DOUBLE)), 6) AS DECIMAL(10,6)) AS hit_rate, classification FROM h GROUP BY column_name, detector, classification
UNION ALL SELECT 'tax_id', 'NAME:tax_id', NULL, NULL, NULL, 'RESTRICTED'""")
def pii_classify_structured(spark, sf):
    """All detectors and the hints of names over structured text: tax numbers, and birth dates in two notations of which one counts."""
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))
    people = Tables(spark, sf).customer.select(
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"),
                                                    F.lpad(F.col("c_custkey").cast("string"), 7, "0"))).alias("tax_id"),
        F.concat(F.lit("Born "), F.when(F.col("c_custkey") % 4 == 0, F.date_format(born, "yyyy/MM/dd")).otherwise(F.date_format(born, "yyyy-MM-dd"))).alias("note"))
    return MK.classify_pii(people, detectors=tuple(MK.DETECTORS), name_hints=True)


@register("masking_suggest", ops=("M9",), sql=f"""SELECT column_name,
  CASE WHEN max(classification = 'RESTRICTED') THEN 'RESTRICTED' ELSE 'CONFIDENTIAL' END AS classification,
  CASE WHEN max(classification = 'RESTRICTED') THEN 'HASH' ELSE 'PARTIAL' END AS technique
FROM ({_classify_sql()}) GROUP BY column_name""")
def masking_suggest(spark, sf):
    return MK.suggest_masking(MK.classify_pii(Tables(spark, sf).documents, ["text"]))


@register("masking_gaps", ops=("M11",), sql=f"""SELECT DISTINCT column_name, classification FROM ({_classify_sql()})
WHERE column_name NOT IN ('c_name')""")
def masking_gaps(spark, sf):
    spark_rules = spark.createDataFrame([("c_name", "PARTIAL")], "column_name string, technique string")
    return MK.masking_gaps(MK.classify_pii(Tables(spark, sf).documents, ["text"]), spark_rules)


# ---------------------------------------------------------------- profiling

ORDER_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
          "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


def _profile_sql() -> str:
    parts = []
    for c in ORDER_PROFILE_COLS:
        num = _TYPES[c] in ("bigint", "double")
        mn = f"CAST(TRY_CAST(MIN({c}) AS DECIMAL(38,6)) AS VARCHAR)" if num else f"CAST(MIN({c}) AS VARCHAR)"
        mx = f"CAST(TRY_CAST(MAX({c}) AS DECIMAL(38,6)) AS VARCHAR)" if num else f"CAST(MAX({c}) AS VARCHAR)"
        mean = f"CAST(ROUND(AVG(CAST({c} AS DOUBLE)), 4) AS DECIMAL(38,4))" if num else "CAST(NULL AS DECIMAL(38,4))"
        sd = f"CAST(ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 4) AS DECIMAL(38,4))" if num else "CAST(NULL AS DECIMAL(38,4))"
        parts.append(f"""SELECT '{c}' AS column_name, '{_TYPES[c]}' AS type, CAST(COUNT(*) AS BIGINT) AS row_count,
  CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count, {mn} AS min, {mx} AS max, {mean} AS mean, {sd} AS stddev
FROM orders""")
    return "\nUNION ALL\n".join(parts)


@register("profile_orders", ops=("A14",), sql=_profile_sql())
def profile_orders(spark, sf):
    # distinct_approx and p50 are estimates; the exact columns are compared.
    return PR.profile(Tables(spark, sf).orders, ORDER_PROFILE_COLS).drop("distinct_approx", "p50")


ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_TEXTS = ("l_returnflag", "l_linestatus")


def _top_sql(k: int) -> str:
    counts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, CAST(COUNT(*) AS BIGINT) AS count "
                                "FROM orders GROUP BY 2" for c in ORDER_COLS)
    return f"""SELECT column_name, value, count FROM (SELECT column_name, value, count,
  ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC NULLS FIRST) rn FROM ({counts})) WHERE rn <= {k}"""


@register("profile_top_values", ops=("A14", "O3"), sql=_top_sql(3))
def profile_top_values(spark, sf):
    return PR.top_values(Tables(spark, sf).orders, ORDER_COLS, k=3)


LINE_TOP = ("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")


def _line_top_sql(k: int) -> str:
    """Columns of lineitem, and their most frequent values as one text (arrays compare differently between engines)."""
    parts = [f"""SELECT '{c}' AS column_name, (SELECT CAST(COUNT(*) AS BIGINT) FROM lineitem) AS row_count,
  (SELECT CAST(COUNT(*) - COUNT({c}) AS BIGINT) FROM lineitem) AS null_count, string_agg(v || '=' || n, ',' ORDER BY n DESC, v) AS top_values
FROM (SELECT CAST({c} AS VARCHAR) AS v, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {k})""" for c in LINE_TOP]
    return "\nUNION ALL\n".join(parts)


@register("profile_with_top_values", ops=("A14",), sql=_line_top_sql(4))
def profile_with_top_values(spark, sf):
    """Statistics and top values of one profile: columns with few values, with an even spread, and with ties."""
    prof = PR.profile(Tables(spark, sf).lineitem, LINE_TOP, top=4)
    pairs = F.transform("top_values", lambda x: F.concat(x["value"], F.lit("="), x["count"].cast("string")))
    return prof.select("column_name", "row_count", "null_count", F.array_join(pairs, ",").alias("top_values"))


def _doc_top_sql(k: int) -> str:
    parts = [f"""SELECT '{c}' AS column_name, (SELECT CAST(COUNT(*) - COUNT({c}) AS BIGINT) FROM documents) AS null_count, r AS rank,
  sha256(v) AS value_sha256, n AS count FROM (SELECT CAST({c} AS VARCHAR) AS v, CAST(COUNT(*) AS BIGINT) AS n,
  CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, CAST({c} AS VARCHAR) NULLS FIRST) AS INTEGER) AS r FROM documents GROUP BY 1) WHERE r <= {k}"""
             for c in DOC_TOP]
    return "\nUNION ALL\n".join(parts)


DOC_TOP = ("text", "lang", "source", "n_chars")


@register("profile_documents", ops=("A14",), sql=_doc_top_sql(5))
def profile_documents(spark, sf):
    """The most frequent whole texts, languages, sources and lengths, from one profile; values as digests, as texts are long."""
    prof = PR.profile(Tables(spark, sf).documents, DOC_TOP, top=5)
    each = prof.select("column_name", "null_count", F.posexplode("top_values").alias("i", "x"))
    return each.select("column_name", "null_count", (F.col("i") + 1).alias("rank"), F.sha2(F.col("x.value"), 256).alias("value_sha256"),
                       F.col("x.count").alias("count"))


KEY_SETS = [[c] for c in ORDER_COLS] + [["o_custkey", "o_orderdate"], ["o_orderkey", "o_custkey"]]


def _keys_sql() -> str:
    parts = []
    for cols in KEY_SETS:
        value = cols[0] if len(cols) == 1 else f"({', '.join(cols)})"
        parts.append(f"SELECT '{','.join(cols)}' AS column_set, COUNT(*) AS row_count, COUNT(DISTINCT {value}) AS distinct_count, "
                     f"COUNT(DISTINCT {value}) = COUNT(*) AS is_key FROM orders")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE is_key"


@register("candidate_keys", ops=("A15",), sql=_keys_sql())
def candidate_keys(spark, sf):
    return PR.candidate_keys(Tables(spark, sf).orders, KEY_SETS)


TURN_COLUMNS = ["conv_id", "turn", "role"]


def _minimal_keys_sql() -> str:
    """Every set of one and two columns, by a plain count of its distinct values; a pair that holds a key is none."""
    from itertools import combinations

    def one(cols):
        return (f"SELECT '{','.join(cols)}' AS column_set, COUNT(*) AS row_count, COUNT(DISTINCT ({', '.join(cols)})) AS d, "
                f"{len(cols)} AS k FROM conversations")
    every = " UNION ALL ".join(one(c) for k in (1, 2) for c in combinations(TURN_COLUMNS, k))
    return (f"WITH s AS ({every}), u AS (SELECT * FROM s WHERE d = row_count) SELECT column_set, row_count FROM u a "
            "WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.k < a.k AND list_contains(string_split(a.column_set, ','), b.column_set))")


@register("composite_keys", ops=("A15",), sql=_minimal_keys_sql())
def composite_keys(spark, sf):
    return PR.minimal_keys(Tables(spark, sf).conversations.select(*TURN_COLUMNS), max_size=2)


@register("watermark_descents", ops=("A16",), sql="""WITH e AS (SELECT event_id, ts, CAST(ts AS DATE) - CAST(event_id % 3 AS INTEGER) AS booked,
  CASE WHEN event_type <> 'error' THEN ts END AS served FROM events),
p AS (SELECT *, LAG(ts) OVER w AS t0, LAG(booked) OVER w AS b0, LAST_VALUE(served IGNORE NULLS) OVER (
  ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s0 FROM e WINDOW w AS (ORDER BY event_id))
SELECT 'ts' AS column_name, CAST(COUNT(*) - COUNT(ts) AS BIGINT) AS null_count, CAST(COUNT(*) FILTER (ts < t0) AS BIGINT) AS descents,
  COUNT(*) = COUNT(ts) AND COUNT(*) FILTER (ts < t0) = 0 AS is_candidate FROM p
UNION ALL SELECT 'booked', CAST(COUNT(*) - COUNT(booked) AS BIGINT), CAST(COUNT(*) FILTER (booked < b0) AS BIGINT),
  COUNT(*) = COUNT(booked) AND COUNT(*) FILTER (booked < b0) = 0 FROM p
UNION ALL SELECT 'served', CAST(COUNT(*) - COUNT(served) AS BIGINT), CAST(COUNT(*) FILTER (served < s0) AS BIGINT),
  COUNT(*) = COUNT(served) AND COUNT(*) FILTER (served < s0) = 0 FROM p""")
def watermark_descents(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "ts", F.date_sub(F.to_date("ts"), (F.col("event_id") % 3).cast("int")).alias("booked"),
                                        F.when(F.col("event_type") != "error", F.col("ts")).alias("served"))
    return PR.candidate_watermarks(e, ["event_id"]).select("column_name", "null_count", "descents", "is_candidate")


@register("candidate_watermarks", ops=("A16",), sql="""SELECT 'ts' AS column_name, 'timestamp_ntz' AS type,
  CAST(MIN(ts) AS VARCHAR) AS min, CAST(MAX(ts) AS VARCHAR) AS max, CAST(COUNT(*) - COUNT(ts) AS BIGINT) AS null_count,
  COUNT(*) = COUNT(ts) AS is_candidate FROM events""")
def candidate_watermarks(spark, sf):
    return PR.candidate_watermarks(Tables(spark, sf).events)


def _suggest_sql() -> str:
    every = (*LINE_NUMBERS, *LINE_TEXTS, "l_shipdate")
    nulls = " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n FROM lineitem" for c in every)
    dec = "CAST(CAST({f}({c}) AS DECIMAL(38,6)) AS VARCHAR)"
    ranges = " UNION ALL ".join(f"SELECT '{c}', 'RANGE', {dec.format(f='MIN', c=c)} || ',' || {dec.format(f='MAX', c=c)} FROM lineitem"
                                for c in LINE_NUMBERS)
    enums = " UNION ALL ".join(f"SELECT '{c}', 'ACCEPTED_VALUES', string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM lineitem)"
                               for c in LINE_TEXTS)
    return f"""SELECT column_name, 'NOT_NULL' AS rule_type, CAST(NULL AS VARCHAR) AS rule_expression FROM ({nulls}) WHERE n = 0
UNION ALL {ranges} UNION ALL {enums}"""


@register("dq_suggest", ops=("A17",), sql=_suggest_sql())
def dq_suggest(spark, sf):
    li = Tables(spark, sf).lineitem
    prof = PR.profile(li)
    return PR.suggest_rules(prof, values=PR.accepted_values(li, prof))


@register("mask_by_class", ops=("P11",), sql=f"""SELECT c_custkey, sha256('{SALT}' || c_name) AS c_name, c_nationkey,
  CASE WHEN length(c_mktsegment) > 3 THEN repeat('*', length(c_mktsegment) - 3) || right(c_mktsegment, 3)
       ELSE repeat('*', length(c_mktsegment)) END AS c_mktsegment FROM customer""")
def mask_by_class(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return MK.mask_by_classification(MK.mask_by_classification(c, {"c_name": "RESTRICTED"}, salt=SALT),
                                     {"c_mktsegment": "CONFIDENTIAL", "c_nationkey": "PUBLIC"}, keep=3)


@register("card_numbers", ops=("M8",), sql="""WITH n AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}')) AS t FROM documents),
d AS (SELECT doc_id, regexp_replace(t, '[^0-9]', '', 'g') AS g FROM n),
w AS (SELECT doc_id, list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 1
  THEN CAST(substr(reverse(g), i, 1) AS INT)
  ELSE CASE WHEN 2 * CAST(substr(reverse(g), i, 1) AS INT) > 9 THEN 2 * CAST(substr(reverse(g), i, 1) AS INT) - 9
            ELSE 2 * CAST(substr(reverse(g), i, 1) AS INT) END END)) AS s FROM d)
SELECT doc_id, CAST(COUNT(*) AS BIGINT) AS n_found, CAST(SUM(CASE WHEN s % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_valid
FROM w GROUP BY doc_id""")
def card_numbers(spark, sf):
    """Card-like numbers of every text, and how many of them pass the checksum."""
    d = Tables(spark, sf).documents
    found = F.regexp_extract_all("text", F.lit("(" + MK.DETECTORS["CARD"] + ")"), F.lit(1))
    n = d.select("doc_id", F.size(found).alias("n_found"), F.size(MK.valid_cards("text")).alias("n_valid"))
    return n.where("n_found > 0").select("doc_id", F.col("n_found").cast("bigint").alias("n_found"),
                                         F.col("n_valid").cast("bigint").alias("n_valid"))


@register("map_access", ops=("F10",), sql="""SELECT event_id, props->>'$.k' AS k, COALESCE(props->>'$.missing', 'none') AS missing,
  'k=' || (props->>'$.k') || ';kind=' || event_type AS tags FROM events""")
def map_access(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "event_type", MP.json_map("props").alias("m"))
    return e.select("event_id", MP.map_get("m", "k").alias("k"), MP.map_get("m", "missing", "none").alias("missing"),
                    MP.map_text(MP.map_with("m", {"kind": F.col("event_type")})).alias("tags"))


@register("renames_by_content", ops=("E3", "E6"), sql="""WITH n AS (SELECT * FROM customer WHERE c_custkey % 8 <> 0),
p AS (SELECT 'c_name' AS removed, 'client' AS added, COUNT(DISTINCT c_name) FILTER (c_name IN (SELECT c_name FROM customer)) / COUNT(DISTINCT c_name) AS share FROM n
UNION ALL SELECT 'c_mktsegment', 'client', COUNT(DISTINCT c_name) FILTER (c_name IN (SELECT c_mktsegment FROM customer)) / COUNT(DISTINCT c_name) FROM n
UNION ALL SELECT 'c_name', 'segment', COUNT(DISTINCT c_mktsegment) FILTER (c_mktsegment IN (SELECT c_name FROM customer)) / COUNT(DISTINCT c_mktsegment) FROM n
UNION ALL SELECT 'c_mktsegment', 'segment', COUNT(DISTINCT c_mktsegment) FILTER (c_mktsegment IN (SELECT c_mktsegment FROM customer)) / COUNT(DISTINCT c_mktsegment) FROM n
UNION ALL SELECT 'c_name', 'note', COUNT(DISTINCT 'x' || c_custkey) FILTER ('x' || c_custkey IN (SELECT c_name FROM customer)) / COUNT(DISTINCT c_custkey) FROM n)
SELECT removed, added, share FROM p WHERE share >= 0.5""")
def renames_by_content(spark, sf):
    """Two columns of customer moved and renamed, beside an unrelated one of their type."""
    t = Tables(spark, sf).customer
    new = t.where("c_custkey % 8 <> 0").select("c_custkey", F.concat(F.lit("x"), F.col("c_custkey").cast("string")).alias("note"),
                                               F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("client"))
    return spark.createDataFrame(E.renames_by_content(t.select("c_custkey", "c_name", "c_mktsegment"), new),
                                 "removed string, added string, share double")
