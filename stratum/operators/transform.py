"""Transforms bronze -> silver -> gold (P1-P4, A18) and the canonical
insurance model (six entity schemas).

A mapping is data (target column -> source expression, type, default); it
compiles to one ``select``, so Catalyst sees plain projections and prunes the
source columns the mapping does not use.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The canonical entities as (column, type), in the order of their table definitions; "!" marks NOT NULL.
M = "decimal(18,2)"
CANONICAL = {
    "party": [("party_id!", "string"), ("party_type!", "string"), ("party_role", "array<string>"),
              ("name!", "string"), ("first_name", "string"), ("middle_name", "string"), ("last_name", "string"),
              ("date_of_birth", "date"), ("gender", "string"), ("tax_id", "string"), ("email", "string"),
              ("phone", "string"), ("address_line1", "string"), ("address_line2", "string"), ("city", "string"),
              ("state", "string"), ("postal_code", "string"), ("country!", "string"), ("credit_score", "int"),
              ("preferred_language!", "string"), ("created_date!", "date"), ("updated_date!", "date"),
              ("source_system!", "string"), ("source_party_id!", "string")],
    "policy": [("policy_id!", "string"), ("policy_number!", "string"), ("party_id!", "string"),
               ("product_type!", "string"), ("status!", "string"), ("effective_date!", "date"),
               ("expiration_date!", "date"), ("issue_date", "date"), ("premium_amount!", M), ("currency!", "string"),
               ("payment_frequency", "string"), ("deductible_amount", M), ("policy_limit", M),
               ("agent_id", "string"), ("underwriter_id", "string"), ("created_date!", "date"),
               ("updated_date!", "date"), ("source_system!", "string"), ("source_policy_id!", "string")],
    "coverage": [("coverage_id!", "string"), ("policy_id!", "string"), ("coverage_type!", "string"),
                 ("coverage_limit!", M), ("deductible", M), ("premium!", M), ("currency!", "string"),
                 ("effective_date!", "date"), ("expiration_date!", "date"), ("created_date!", "date"),
                 ("updated_date!", "date"), ("source_system!", "string"), ("source_coverage_id!", "string")],
    "claim": [("claim_id!", "string"), ("claim_number!", "string"), ("policy_id!", "string"),
              ("coverage_id", "string"), ("claimant_id!", "string"), ("claim_type!", "string"),
              ("status!", "string"), ("loss_date!", "date"), ("report_date!", "date"), ("close_date", "date"),
              ("loss_location", "string"), ("loss_description!", "string"), ("claim_amount!", M),
              ("paid_amount!", M), ("reserved_amount!", M), ("currency!", "string"), ("adjuster_id", "string"),
              ("created_date!", "date"), ("updated_date!", "date"), ("source_system!", "string"),
              ("source_claim_id!", "string")],
    "payment": [("payment_id!", "string"), ("payment_type!", "string"), ("policy_id", "string"),
                ("claim_id", "string"), ("party_id!", "string"), ("amount!", M), ("currency!", "string"),
                ("payment_date!", "date"), ("payment_method!", "string"), ("status!", "string"),
                ("reference_number", "string"), ("created_date!", "date"), ("updated_date!", "date"),
                ("source_system!", "string"), ("source_payment_id!", "string")],
    "loss": [("loss_id!", "string"), ("claim_id!", "string"), ("loss_type!", "string"), ("loss_date!", "date"),
             ("loss_amount!", M), ("currency!", "string"), ("description", "string"), ("category", "string"),
             ("created_date!", "date"), ("updated_date!", "date"), ("source_system!", "string"),
             ("source_loss_id!", "string")],
}
NOT_NULL = {e: tuple(n[:-1] for n, _ in cols if n.endswith("!")) for e, cols in CANONICAL.items()}
CANONICAL = {e: [(n.rstrip("!"), t) for n, t in cols] for e, cols in CANONICAL.items()}


def canonical_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t), n not in NOT_NULL[entity]) for n, t in CANONICAL[entity]])


def map_to_canonical(df: DataFrame, mapping: Mapping[str, str], entity: str,
                     defaults: Mapping[str, object] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto a canonical entity.

    ``mapping``: canonical column -> SQL expression over ``df``. Unmapped
    columns get their default or NULL, every column is cast (``try_cast``) to
    its canonical type, and ``keep`` columns (lineage ids) are carried along.
    """
    defaults = dict(defaults or {})
    out = []
    for name, typ in CANONICAL[entity]:
        if name in mapping:
            e = F.expr(mapping[name])
        elif name in defaults:
            e = F.lit(defaults[name])
        else:
            e = F.lit(None)
        out.append((e.try_cast(typ) if not typ.startswith("array") else e.cast(typ)).alias(name))
    return df.select(*out, *[F.col(k) for k in keep])


def cleanse(df: DataFrame, trim: Sequence[str] = (), upper: Sequence[str] = (), lower: Sequence[str] = (),
            blank_to_null: Sequence[str] = (), code_maps: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """Standardise text columns (P4): trim, case, blank -> NULL, code maps.
    Code maps are literal ``map`` expressions (no join, no broadcast)."""
    code_maps = dict(code_maps or {})
    out = []
    for c in df.columns:
        e = F.col(c)
        if c in trim:
            e = F.trim(e)
        if c in upper:
            e = F.upper(e)
        if c in lower:
            e = F.lower(e)
        if c in blank_to_null:
            e = F.nullif(F.trim(e), F.lit(""))
        if c in code_maps:
            m = F.create_map(*[x for k, v in code_maps[c].items() for x in (F.lit(k), F.lit(v))])
            e = F.coalesce(m[e], e)
        out.append(e.alias(c))
    return df.select(*out)


def sql_transform(spark: SparkSession, sql: str, **inputs: DataFrame) -> DataFrame:
    """Run configured SQL over named inputs (P1): ``{name}`` in the text is
    bound to the DataFrame (no global views), then Catalyst optimises it."""
    return spark.sql(sql, **inputs)


def python_transform(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Configured Python transform (P2): a DataFrame -> DataFrame function."""
    return df.transform(fn)


def gold_summary(facts: DataFrame, dims: Sequence[str], premium: str, loss: str, claim_flag: str | None = None,
                 n_policies: str | None = None, n_claims: str | None = None) -> DataFrame:
    """Business aggregate with subtotals (A18): premium, losses, loss ratio and
    claim frequency per dimension level (``rollup``).

    ``facts`` is either at policy grain (one row per policy; give
    ``claim_flag``) or already aggregated above it (give the ``n_policies``
    and ``n_claims`` count columns). Every level is then plain sums: no
    distinct counts, which would multiply the data by the number of levels.
    """
    if n_policies is None:
        pol = F.count(F.lit(1))
        clm = F.sum(F.when(F.col(claim_flag), 1).otherwise(0))
    else:
        pol, clm = F.sum(n_policies), F.sum(n_claims)
    # the finest level first: only its few rows are expanded into subtotals
    fine = facts.groupBy(*dims).agg(
        F.sum(F.col(premium).cast("decimal(38,2)")).cast("decimal(38,2)").alias("premium"),
        F.sum(F.col(loss).cast("decimal(38,2)")).cast("decimal(38,2)").alias("losses"),
        pol.cast("bigint").alias("n_policies"), clm.cast("bigint").alias("n_policies_with_claims"))
    g = fine.rollup(*dims).agg(F.sum("premium").cast("decimal(38,2)").alias("premium"),
                               F.sum("losses").cast("decimal(38,2)").alias("losses"), F.sum("n_policies").alias("n_policies"),
                               F.sum("n_policies_with_claims").alias("n_policies_with_claims"))
    return g.select(
        *[F.coalesce(F.col(d).cast("string"), F.lit("ALL")).alias(d) for d in dims], "premium", "losses",
        F.when(F.col("premium") > 0, F.round(F.col("losses").cast("double") / F.col("premium").cast("double"), 6))
         .cast("decimal(18,6)").alias("loss_ratio"),
        "n_policies", "n_policies_with_claims",
        F.round(F.col("n_policies_with_claims") / F.col("n_policies"), 6).cast("decimal(18,6)").alias("claim_frequency"))
