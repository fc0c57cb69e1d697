"""Reconciliation: counts, control totals, hash totals, key-level diffs
(A1-A5, J8, G18) and the balance rule (A4).

Measures are summed as exact decimals, so totals do not depend on row order or
partitioning: integers and decimals in their own scale, floating point values with
``FLOAT_SCALE`` digits after the point. Both sides are
aggregated before they meet (map-side partial sums), so the join is between
two small per-group tables.

Balance rule (one reading of the reference's two versions):
``variance = source - target``; ``variance_percent = 100 * variance / |source|``;
at ``source = 0`` the percent is NULL and the check balances only when
``target = 0``; otherwise it balances when ``100 * |variance| <= tolerance_percent * |source|``,
in exact decimals: the percent is rounded for show only. At tolerance 0 both totals must be
equal, and hash totals must be equal at any tolerance. Tolerances are stored as fractions on rules and shown in percent points.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_bigint

RECON_TYPES = ("ROW_COUNT", "CONTROL_TOTAL", "HASH_TOTAL", "CROSS_LAYER", "SOURCE_OF_RECORD")
ON_BREAK = ("WARN", "FAIL")


FLOAT_SCALE = 6


def exact(df: DataFrame, c: str | Column, scale: int | None = None) -> Column:
    """The measure as a decimal, of the column's own scale unless ``scale`` is given."""
    col = F.col(c) if isinstance(c, str) else c
    dtype = df.select(col.alias("m")).schema["m"].dataType
    if scale is None:
        scale = dtype.scale if isinstance(dtype, T.DecimalType) else 0 if isinstance(dtype, T.IntegralType) else FLOAT_SCALE
    return col.cast(f"decimal(38,{scale})")


def balance_columns(src: Column, tgt: Column, tolerance_percent: float, scale: int = 2, equal: bool = False) -> list[Column]:
    """variance, variance_percent, tolerance_percent, balanced for two totals; with ``equal`` the tolerance doesn't count."""
    variance = (src - tgt)
    pct = F.when(src == 0, F.lit(None)).otherwise(
        F.round(F.lit(100.0) * variance.cast("double") / F.abs(src).cast("double"), 4))
    tol = F.lit(float(tolerance_percent))
    if equal or tolerance_percent == 0:
        balanced = src == tgt
    else:
        # the share as a fraction of whole numbers, so nothing is divided; what passes 38 digits doesn't balance
        share = (Decimal(str(round(float(tolerance_percent), 10))) / 100).normalize()
        below = 10 ** max(0, -share.as_tuple().exponent)
        wide = f"decimal(38,{max(scale, 6)})"
        lost = F.try_multiply(F.abs(variance).cast(wide), F.lit(Decimal(below)))
        allowed = F.try_multiply(F.abs(src).cast(wide), F.lit(Decimal(int(share * below))))
        balanced = F.when(src == 0, tgt == 0).otherwise(lost <= allowed)
    return [variance.cast(f"decimal(38,{scale})").alias("variance"),
            pct.cast("decimal(18,4)").alias("variance_percent"),
            tol.cast("decimal(18,4)").alias("tolerance_percent"),
            F.coalesce(balanced, F.lit(False)).alias("balanced")]


def balance(df: DataFrame, source_col: str = "source_value", target_col: str = "target_value",
            tolerance_percent: float = 0.0) -> DataFrame:
    """Add the balance columns to any frame with two total columns (A4)."""
    return df.select("*", *balance_columns(F.col(source_col), F.col(target_col), tolerance_percent))


@dataclass
class ReconRule:
    recon_rule_id: str
    recon_type: str
    source: DataFrame
    target: DataFrame
    source_measure: str | Column | None = None
    target_measure: str | Column | None = None
    group_by: Sequence[str] = ()
    hash_columns: Sequence[str] = ()
    tolerance: float = 0.0            # fraction, 0.01 = 1 %
    on_break: str = "WARN"
    scale: int | None = None          # digits after the point that totals keep; None: the measure's own

    def __post_init__(self):
        self.recon_type = self.recon_type.upper()
        if self.recon_type not in RECON_TYPES:
            raise ValueError(f"unknown recon type {self.recon_type}")
        if self.on_break.upper() not in ON_BREAK:
            raise ValueError(f"unknown on_break {self.on_break}")
        if not 0.0 <= self.tolerance <= 1.0:
            raise ValueError("tolerance is a fraction in [0, 1]")


class ReconBreak(Exception):
    """A rule with ``on_break`` FAIL doesn't balance."""


def recon_rule_from_row(row: Mapping, resolve: Callable[[str], DataFrame]) -> ReconRule:
    """A rule from a ``cfg_recon_rule`` row; ``resolve`` turns its references into DataFrames."""
    measure = row.get("measure_column")
    return ReconRule(row["recon_rule_id"], row["recon_type"], resolve(row["source_ref"]), resolve(row["target_ref"]),
                     measure, measure, hash_columns=[measure] if measure else (),
                     tolerance=float(row.get("tolerance_percent") or 0.0), on_break=row.get("on_break") or "WARN")


def _kind(rule: ReconRule) -> str:
    """Layers and sources of record are compared by their totals where a measure is named, else by their rows."""
    if rule.recon_type in ("CROSS_LAYER", "SOURCE_OF_RECORD"):
        return "CONTROL_TOTAL" if rule.source_measure is not None else "ROW_COUNT"
    return rule.recon_type


def _side_total(df: DataFrame, rule: ReconRule, measure, name: str) -> DataFrame:
    kind = _kind(rule)
    if kind == "ROW_COUNT":
        total = F.count(F.lit(1))
    elif kind == "CONTROL_TOTAL":
        total = F.coalesce(F.sum(exact(df, measure, rule.scale)), F.lit(0))
    else:
        total = F.coalesce(F.sum(hash_bigint(list(rule.hash_columns)).cast("decimal(38,0)")), F.lit(0))
    return df.groupBy(*[F.col(c) for c in rule.group_by]).agg(total.alias(name))


def reconcile(rule: ReconRule) -> DataFrame:
    """One result row per group (one row without grouping) for a rule (A1-A3).

    Columns: recon_rule_id, recon_type, group_key, source_value, target_value,
    variance, variance_percent, tolerance_percent, balanced, on_break.
    """
    s = _side_total(rule.source, rule, rule.source_measure, "source_value")
    t = _side_total(rule.target, rule, rule.target_measure or rule.source_measure, "target_value")
    if rule.group_by:
        j = s.join(t, list(rule.group_by), "full_outer")
        gk = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in rule.group_by])
    else:
        # Two one-row aggregates: read the target total as a scalar subquery.
        j = s.withColumn("target_value", t.select("target_value").scalar())
        gk = F.lit("*")
    digits = [d.scale for d in (j.schema["source_value"].dataType, j.schema["target_value"].dataType) if isinstance(d, T.DecimalType)]
    digits = max([2 if rule.scale is None else rule.scale, *digits])
    both = [F.coalesce(F.col(c), F.lit(0)).cast(f"decimal(38,{digits})").alias(c) for c in ("source_value", "target_value")]
    j = j.select(gk.alias("group_key"), *both)
    return j.select(F.lit(rule.recon_rule_id).alias("recon_rule_id"), F.lit(rule.recon_type).alias("recon_type"),
                    "group_key", "source_value", "target_value",
                    *balance_columns(F.col("source_value"), F.col("target_value"), rule.tolerance * 100.0, digits, _kind(rule) == "HASH_TOTAL"),
                    F.lit(rule.on_break.upper()).alias("on_break"))


def enforce_recon(results: DataFrame) -> None:
    """Raise if a rule that must hold is broken. Reads the broken rules' ids only."""
    broken = results.where((F.col("on_break") == "FAIL") & ~F.col("balanced")).select("recon_rule_id").distinct().collect()
    if broken:
        raise ReconBreak(f"reconciliation broken: {', '.join(sorted(r[0] for r in broken))}")


def reconcile_all(rules: Sequence[ReconRule]) -> DataFrame:
    """Many rules in one result table (A5)."""
    out = None
    for r in rules:
        df = reconcile(r)
        out = df if out is None else out.unionByName(df)
    return out


def recon_keys(source: DataFrame, target: DataFrame, keys: Sequence[str],
               measures: Sequence[str] = (), scale: int | None = None) -> DataFrame:
    """Key-level comparison across layers.

    One row per key present on either side with ``status`` in
    (MISSING_IN_TARGET, MISSING_IN_SOURCE, DIFFERENT, MATCH) and, per measure,
    ``src_<m>``, ``tgt_<m>`` and ``diff_<m>``.
    """
    keys = list(keys)
    s = source.select(*keys, *[exact(source, m, scale).alias(f"src_{m}") for m in measures], F.lit(True).alias("__s"))
    t = target.select(*keys, *[exact(target, m, scale).alias(f"tgt_{m}") for m in measures], F.lit(True).alias("__t"))
    j = s.join(t, keys, "full_outer")
    same = F.lit(True)
    for m in measures:
        same = same & F.col(f"src_{m}").eqNullSafe(F.col(f"tgt_{m}"))
    status = (F.when(F.col("__t").isNull(), "MISSING_IN_TARGET").when(F.col("__s").isNull(), "MISSING_IN_SOURCE")
              .when(~same, "DIFFERENT").otherwise("MATCH"))
    out = [F.col(k) for k in keys] + [status.alias("status")]
    for m in measures:
        out += [F.col(f"src_{m}"), F.col(f"tgt_{m}"),
                (F.col(f"src_{m}") - F.col(f"tgt_{m}")).alias(f"diff_{m}")]
    return j.select(*out)


def run_balance(metrics: DataFrame, read: str = "rows_read", written: str = "rows_written",
                rejected: str = "rows_rejected") -> DataFrame:
    """rows_read - rows_written - rows_rejected must be 0."""
    delta = (F.col(read) - F.col(written) - F.col(rejected)).cast("bigint")
    return metrics.select("*", delta.alias("balance_delta"),
                          F.when(delta == 0, "PASS").otherwise("FAIL").alias("balance_status"))
