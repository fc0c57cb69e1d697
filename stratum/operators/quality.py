"""Data-quality rules evaluated as one annotated scan.

Every row rule becomes a boolean "fails" column; one aggregate over the
annotated frame yields the counts of all rules, and the same frame splits into
good and bad rows. UNIQUE and REFERENTIAL need key sets: the duplicate keys
come from a partial aggregate (a hot key is combined map-side) and parent keys
from a distinct; both are joined back on the key, so no key group is ever
collected into a single task.

NULL semantics: NOT_NULL owns NULL; RANGE, PATTERN, ACCEPTED_VALUES and
REFERENTIAL let NULL pass; UNIQUE ignores NULL keys; CUSTOM_SQL fails unless
the expression is TRUE. FRESHNESS fails the whole table when
``as_of - max(ts) > max_age``. Verdict: ``pass_rate >= threshold`` (fraction),
empty input passes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("WARN", "FAIL", "QUARANTINE")
# Accepted rule-type names; REGEX is PATTERN, CUSTOM is CUSTOM_SQL, IN is ACCEPTED_VALUES.
RULE_TYPES = ("NOT_NULL", "UNIQUE", "RANGE", "PATTERN", "REGEX", "REFERENTIAL", "CUSTOM_SQL",
              "CUSTOM", "FRESHNESS", "ACCEPTED_VALUES", "IN")
_ALIAS = {"REGEX": "PATTERN", "CUSTOM": "CUSTOM_SQL", "IN": "ACCEPTED_VALUES"}


class DataQualityError(Exception):
    """Raised by :func:`enforce` when a FAIL rule's verdict is false."""


@dataclass
class Rule:
    rule_id: str
    rule_type: str
    column_name: str | None = None
    rule_expression: str | None = None
    threshold: float = 1.0
    action: str = "WARN"
    rule_name: str | None = None
    target: str | None = None
    values: Sequence = field(default_factory=tuple)     # ACCEPTED_VALUES
    parent: str | None = None                          # REFERENTIAL: name in ``parents``
    parent_column: str | None = None
    max_age_seconds: int | None = None                 # FRESHNESS

    def __post_init__(self):
        self.rule_type = _ALIAS.get(self.rule_type.upper(), self.rule_type.upper())
        self.action = self.action.upper()
        if self.rule_type not in RULE_TYPES:
            raise ValueError(f"unknown rule type {self.rule_type}")
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action}")
        if not 0.0 <= float(self.threshold) <= 1.0:
            raise ValueError("threshold is a fraction in [0, 1]")
        if self.rule_type != "CUSTOM_SQL" and self.rule_type != "FRESHNESS" and not self.column_name:
            raise ValueError(f"{self.rule_type} needs a column")
        self.rule_name = self.rule_name or self.rule_id

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in (self.column_name or "").split(",") if c.strip()]


def rule_from_row(row: Mapping) -> Rule:
    """Build a rule from a config row (``dq_rule`` table layout)."""
    expr = row.get("rule_expression")
    kw = dict(rule_id=row["dq_rule_id"], rule_type=row["rule_type"], column_name=row.get("column_name"),
              rule_expression=expr, threshold=1.0 if row.get("threshold_percent") is None else float(row["threshold_percent"]),
              action=row.get("on_failure", "WARN"), rule_name=row.get("rule_name"), target=row.get("target_id"))
    rt = _ALIAS.get(str(row["rule_type"]).upper(), str(row["rule_type"]).upper())
    if rt == "ACCEPTED_VALUES" and expr:
        kw["values"] = tuple(v.strip() for v in expr.split(","))
    if rt == "REFERENTIAL" and expr:
        parent, _, pcol = expr.partition(".")
        kw["parent"], kw["parent_column"] = parent, pcol
    if rt == "FRESHNESS" and expr:
        kw["max_age_seconds"] = int(expr)
    return Rule(**kw)


def _range_fail(c: Column, expr: str, dtype) -> Column:
    """Bounds are cast to the column's own type (numbers, dates, timestamps)."""
    lo, _, hi = expr.partition(",")
    cond = F.lit(False)
    if lo.strip():
        cond = cond | (c < F.lit(lo.strip()).cast(dtype))
    if hi.strip():
        cond = cond | (c > F.lit(hi.strip()).cast(dtype))
    return F.coalesce(cond, F.lit(False))


def annotate(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None,
             as_of=None) -> DataFrame:
    """Add one boolean ``__fail_<rule_id>`` column per rule."""
    parents = dict(parents or {})
    out = df
    flags: list[Column] = []
    for r in rules:
        name = f"__fail_{r.rule_id}"
        if r.rule_type == "NOT_NULL":
            cond = F.lit(False)
            for c in r.columns:
                cond = cond | F.col(c).isNull()
            flags.append(cond.alias(name))
        elif r.rule_type == "RANGE":
            flags.append(_range_fail(F.col(r.column_name), r.rule_expression or ",",
                                     df.schema[r.column_name].dataType).alias(name))
        elif r.rule_type == "PATTERN":
            flags.append(F.coalesce(~F.col(r.column_name).cast("string").rlike(r.rule_expression), F.lit(False))
                         .alias(name))
        elif r.rule_type == "ACCEPTED_VALUES":
            flags.append(F.coalesce(~F.col(r.column_name).isin(list(r.values)), F.lit(False)).alias(name))
        elif r.rule_type == "CUSTOM_SQL":
            flags.append((~F.coalesce(F.expr(r.rule_expression), F.lit(False))).alias(name))
        elif r.rule_type == "UNIQUE":
            ks = r.columns
            present = F.lit(True)
            for k in ks:
                present = present & F.col(k).isNotNull()
            dups = (df.where(present).groupBy(*ks).agg(F.count(F.lit(1)).alias("__n"))
                    .where(F.col("__n") > 1).select(*ks, F.lit(True).alias(name)))
            out = out.join(dups, ks, "left")
            flags.append(F.coalesce(F.col(name), F.lit(False)).alias(name))
        elif r.rule_type == "REFERENTIAL":
            parent = parents[r.parent]
            pk = parent.select(F.col(r.parent_column).alias(f"__pk_{r.rule_id}")).distinct() \
                       .withColumn(f"__ok_{r.rule_id}", F.lit(True))
            out = out.join(pk, F.col(r.column_name) == F.col(f"__pk_{r.rule_id}"), "left")
            flags.append((F.col(r.column_name).isNotNull() & F.col(f"__ok_{r.rule_id}").isNull()).alias(name))
        elif r.rule_type == "FRESHNESS":
            if as_of is None:
                raise ValueError("FRESHNESS needs an as_of instant")
            ts = F.lit(str(as_of)).cast("timestamp_ntz")
            # Scalar subquery: the newest timestamp is computed once, no join.
            mx = df.agg(F.max(F.col(r.column_name).cast("timestamp_ntz"))).scalar()
            age = F.timestamp_diff("SECOND", mx, ts)
            flags.append(F.coalesce(age > F.lit(r.max_age_seconds), F.lit(True)).alias(name))
    keep = [F.col(c) for c in df.columns]
    return out.select(*keep, *flags)


def _results(annotated: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.sum(F.when(F.col(f"__fail_{r.rule_id}"), 1).otherwise(0)).alias(f"f{i}") for i, r in enumerate(rules)]
    one = annotated.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        failed = F.coalesce(F.col(f"f{i}"), F.lit(0)).cast("bigint")
        total = F.col("__total").cast("bigint")
        rate = F.when(total == 0, F.lit(1.0)).otherwise((total - failed) / total)
        rows.append(F.struct(
            F.lit(r.rule_id).alias("rule_id"), F.lit(r.rule_name).alias("rule_name"),
            F.lit(r.target).cast("string").alias("target"), F.lit(r.column_name).cast("string").alias("column_name"),
            F.lit(r.rule_type).alias("rule_type"), total.alias("total_count"), failed.alias("failed_count"),
            F.round(rate, 6).cast("decimal(10,6)").alias("pass_rate"),
            F.lit(float(r.threshold)).cast("decimal(10,6)").alias("threshold"),
            (rate >= F.lit(float(r.threshold))).alias("passed"), F.lit(r.action).alias("action")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def evaluate(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None,
             as_of=None) -> DataFrame:
    """One result row per rule (A6): counts from a single aggregate."""
    rules = list(rules)
    return _results(annotate(df, rules, parents, as_of), rules)


def failed_rule_array(rules: Iterable[Rule], actions: Iterable[str] | None = None) -> Column:
    acts = set(actions) if actions else set(ACTIONS)
    ids = [F.when(F.col(f"__fail_{r.rule_id}"), F.lit(r.rule_id)) for r in rules if r.action in acts]
    if not ids:
        return F.array().cast("array<string>")
    return F.filter(F.array(*ids), lambda x: x.isNotNull())


def apply_rules(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None,
                as_of=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Evaluate and act (Q10): returns ``(good, bad, results)``.

    ``bad`` holds rows failing any QUARANTINE rule, with ``_dq_failed_rules``
    (every failed rule id). ``good`` holds the rest with ``_dq_warnings`` (failed
    WARN rule ids). QUARANTINE diverts failing rows whatever the threshold; FAIL
    is enforced by :func:`enforce` on ``results`` after all rules ran.
    """
    rules = list(rules)
    ann = annotate(df, rules, parents, as_of)
    q_rules = [r for r in rules if r.action == "QUARANTINE"]
    is_bad = F.lit(False)
    for r in q_rules:
        is_bad = is_bad | F.col(f"__fail_{r.rule_id}")
    flags = [f"__fail_{r.rule_id}" for r in rules]
    good = ann.where(~is_bad).withColumn("_dq_warnings", failed_rule_array(rules, ["WARN"])).drop(*flags)
    bad = ann.where(is_bad).withColumn("_dq_failed_rules", failed_rule_array(rules)).drop(*flags)
    return good, bad, _results(ann, rules)


def enforce(results: DataFrame) -> None:
    """Raise if any FAIL rule did not pass. Reads only the small results table."""
    failed = [r.rule_id for r in results.where((F.col("action") == "FAIL") & ~F.col("passed"))
              .select("rule_id").collect()]
    if failed:
        raise DataQualityError(f"data-quality rules failed: {', '.join(sorted(failed))}")


def referential_orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    pk = parent.select(F.col(parent_col).alias("__pk")).distinct()
    return child.where(F.col(child_col).isNotNull()).join(pk, F.col(child_col) == F.col("__pk"), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("dup_count"))
            .where(F.col("dup_count") > 1))


def freshness(df: DataFrame, ts_col: str, as_of, max_age_seconds: int) -> DataFrame:
    """One row: newest timestamp, its age at ``as_of`` and whether it is fresh."""
    ts = F.lit(str(as_of)).cast("timestamp_ntz")
    m = df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("max_ts"))
    age = F.timestamp_diff("SECOND", F.col("max_ts"), ts).cast("bigint")
    return m.select("max_ts", age.alias("age_seconds"), F.coalesce(age <= max_age_seconds, F.lit(False)).alias("fresh"))


# Business rules shipped as CUSTOM_SQL defaults for canonical entities (Q12).
DEFAULT_ENTITY_RULES = {
    "policy": ["effective_date <= expiration_date"],
    "coverage": ["effective_date <= expiration_date"],
    "claim": ["close_date IS NULL OR close_date >= loss_date", "report_date >= loss_date"],
}
