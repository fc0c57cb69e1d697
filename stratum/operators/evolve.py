"""Schema evolution (E1-E10): policy resolution, compatibility of two
schemas, and the plans that apply an allowed change.

Resolution and compatibility look only at schemas (driver-side metadata, no
data). Applying a change is a projection: cast to the wider type, rename by
mapping, NULL-fill a column the batch no longer sends.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("addNewColumns", "rescue", "failOnNewColumns", "none")


@dataclass
class EvolutionContext:
    layer: str = "BRONZE"
    engine: str = "BATCH"                     # BATCH (non-declarative) | DECLARATIVE
    scd_type: str | None = None
    source_system_type: str = "stable"       # stable | regulated | volatile
    governance_tier: str = "standard"        # standard | high
    review_required: bool = True             # what "regulated" sources need
    zero_downtime: bool = False
    paranoid: bool = False
    renames_expected: bool = False
    type_changes: str = "none"                # none | widening | strict
    dimensional: bool = False


@dataclass
class EvolutionConfig:
    mode: str
    evolve_and_rescue: bool = False
    enable_type_widening: bool = False
    enable_column_mapping: bool = False
    column_mapping_mode: str = "none"         # none | name
    require_approval: bool = False
    engine: str = "BATCH"
    merge_schema: bool = False
    overwrite_schema: bool = False
    enable_rescued_data: bool = False          # declarative engines only
    capture_drift_to_quarantine: bool = False  # batch engines only
    quarantine_override_mode: str | None = None
    reasons: list[str] = field(default_factory=list)


def _scd(ctx_type: str | None) -> str:
    return str(ctx_type or "").upper().removeprefix("SCD")


def resolve_schema_evolution(ctx: EvolutionContext) -> EvolutionConfig:
    """Policy by precedence (E1): frozen SCD0 > regulated with review > zero downtime > paranoid > layer and source defaults."""
    layer, scd, batch = ctx.layer.upper(), _scd(ctx.scd_type), ctx.engine.upper() != "DECLARATIVE"

    def config(mode: str, why: str, **more) -> EvolutionConfig:
        more.setdefault("enable_type_widening", ctx.type_changes.lower() == "widening")
        more.setdefault("enable_column_mapping", ctx.renames_expected)
        more.setdefault("require_approval", layer == "SILVER" and ctx.governance_tier.lower() == "high")
        rescues = mode == "rescue" or more.get("evolve_and_rescue", False)
        return EvolutionConfig(
            mode, column_mapping_mode="name" if more["enable_column_mapping"] else "none", engine="BATCH" if batch else "DECLARATIVE",
            merge_schema=batch and mode == "addNewColumns", enable_rescued_data=rescues and not batch,
            capture_drift_to_quarantine=rescues and batch, reasons=[why], **more)

    if scd == "0":
        return config("none", "SCD0: the schema is frozen", enable_type_widening=False, enable_column_mapping=False,
                      require_approval=True)
    if ctx.source_system_type.lower() == "regulated" and ctx.review_required:
        return config("failOnNewColumns", "regulated source under review", require_approval=True)
    if ctx.zero_downtime:
        return config("rescue", "zero downtime")
    if ctx.paranoid:
        return config("addNewColumns", "paranoid: evolve and rescue", evolve_and_rescue=True)
    if layer == "BRONZE":
        if ctx.source_system_type.lower() == "volatile":
            return config("rescue", "volatile source")
        return config("addNewColumns", "bronze default", enable_type_widening=ctx.type_changes.lower() != "strict")
    if layer == "SILVER":
        return config("addNewColumns", "silver default")
    if ctx.dimensional and scd == "1":
        return config("addNewColumns", "gold SCD1: additions only", enable_column_mapping=False)
    if ctx.dimensional and scd == "2":
        return config("addNewColumns", "gold SCD2: additions and renames", enable_column_mapping=True)
    return config("addNewColumns", "gold default: no renames or type changes unless explicit")


def validate_config(cfg: EvolutionConfig) -> list[str]:
    """Conflicting settings (E2); empty list = valid."""
    checks = (
        (cfg.mode not in MODES, f"unknown mode {cfg.mode}"),
        (cfg.engine.upper() != "DECLARATIVE" and cfg.enable_rescued_data, "enable_rescued_data is for declarative engines only"),
        (cfg.engine.upper() == "DECLARATIVE" and cfg.capture_drift_to_quarantine,
         "capture_drift_to_quarantine is for batch engines only"),
        (cfg.merge_schema and cfg.overwrite_schema, "merge_schema and overwrite_schema exclude each other"),
        (cfg.column_mapping_mode == "name" and not cfg.enable_column_mapping, "column mapping by name must be enabled"),
        (cfg.quarantine_override_mode == "failOnNewColumns", "the quarantine must never fail"),
        (cfg.evolve_and_rescue and cfg.mode == "failOnNewColumns", "evolve_and_rescue cannot refuse new columns"),
    )
    return [text for broken, text in checks if broken]


# ---------------------------------------------------------------- compatibility

_INT_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}
_INT_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


_NESTED = (T.ArrayType, T.MapType, T.StructType)


def is_widening(old: T.DataType, new: T.DataType) -> bool:
    """Lossless widening: byte<short<int<long; byte/short/int -> double;
    integral -> decimal with enough integral digits; float -> double;
    date -> timestamp_ntz; decimal growth without losing integral or
    fractional digits. long -> double is lossy and refused."""
    if old == new:
        return True
    o, n = type(old), type(new)
    if o in _INT_RANK and n in _INT_RANK:
        return _INT_RANK[o] <= _INT_RANK[n]
    if o in (T.ByteType, T.ShortType, T.IntegerType) and n is T.DoubleType:
        return True
    if o in _INT_DIGITS and n is T.DecimalType:
        return new.precision - new.scale >= _INT_DIGITS[o]
    if o is T.FloatType and n is T.DoubleType:
        return True
    if o is T.DateType and n is T.TimestampNTZType:
        return True
    if o is T.DecimalType and n is T.DecimalType:
        return (new.precision - new.scale) >= (old.precision - old.scale) and new.scale >= old.scale
    return False


@dataclass
class CompatibilityResult:
    allowed: bool
    requires_rebuild: bool
    added: list[str]
    removed: list[str]
    widened: list[str]
    narrowed: list[str]
    suspected_renames: list[tuple[str, str]]
    reasons: list[str]


def validate_schema_compatibility(incoming: T.StructType, target: T.StructType,
                                  cfg: EvolutionConfig, scd_type: str | None = None,
                                  renames: Sequence[tuple[str, str]] | None = None) -> CompatibilityResult:
    """Compare an incoming schema with the target (E3). Renames are those given (:func:`renames_by_content`), or else
    suspected where a column of the same type stands in the same place."""
    tin = {f.name: f.dataType for f in incoming.fields}
    ttg = {f.name: f.dataType for f in target.fields}
    added = [c for c in tin if c not in ttg]
    removed = [c for c in ttg if c not in tin]
    widened, narrowed = [], []
    for c in tin:
        if c in ttg and tin[c] != ttg[c]:
            (widened if is_widening(ttg[c], tin[c]) else narrowed).append(c)
    pos_in = {f.name: i for i, f in enumerate(incoming.fields)}
    pos_tg = {f.name: i for i, f in enumerate(target.fields)}
    if renames is None:
        renames = [(r, a) for r in removed for a in added if ttg[r] == tin[a] and pos_tg[r] == pos_in[a]]
    renames = list(renames)
    reasons = []
    allowed, rebuild = True, False
    if _scd(scd_type) == "0" and (added or removed or widened or narrowed):
        allowed, reasons = False, ["SCD0 target: no schema change allowed"]
    else:
        if narrowed:
            allowed, rebuild = False, True
            reasons.append(f"type narrowing or incompatible change: {narrowed}")
        if widened and not cfg.enable_type_widening:
            allowed = False
            reasons.append(f"type widening not enabled: {widened}")
        if renames and not cfg.enable_column_mapping:
            allowed, rebuild = False, True
            reasons.append(f"rename without column mapping: {renames}")
        if added and cfg.mode == "failOnNewColumns":
            allowed = False
            reasons.append(f"new columns refused: {added}")
    return CompatibilityResult(allowed, rebuild, added, removed, widened, narrowed, renames, reasons)


#: Distinct values of a new column that are looked for in the columns that went, and the share to be found there.
RENAME_VALUES = 256
RENAME_SHARE = 0.5
#: NULL shares of two columns that hold the same thing differ by no more.
RENAME_NULLS = 0.25


def renames_by_content(stored: DataFrame, batch: DataFrame, least: float = RENAME_SHARE,
                       values: int = RENAME_VALUES) -> list[tuple[str, str, float]]:
    """(removed, added, share): columns of ``stored`` that ``batch`` has under another name, wherever it stands.

    Of each new column the ``values`` distinct values with the smallest hashes are its fingerprint, a sample that doesn't depend on
    how large the batch is against the table. One scan of the stored table counts, for each column that went and that the new type
    fits, which of them it holds. A pair is a rename if its share is at least ``least``, the NULL shares are alike, and each
    is the other's only best match: two columns that share a domain with a third one are left undecided. Only fingerprints and
    counts come to the driver.
    """
    removed = [f for f in stored.schema.fields if f.name not in batch.columns and not isinstance(f.dataType, _NESTED)]
    added = [f for f in batch.schema.fields if f.name not in stored.columns and not isinstance(f.dataType, _NESTED)]
    pairs = [(r, a) for r in removed for a in added if is_widening(r.dataType, a.dataType)]
    if not pairs:
        return []

    def value(name: str, dtype: T.DataType) -> Column:
        return F.xxhash64(F.col(name).cast(dtype).cast("string"))

    prints = {a.name: [r[0] for r in batch.where(F.col(a.name).isNotNull()).select(value(a.name, a.dataType).alias("h")).distinct()
                       .orderBy("h").limit(values).collect()] for a in added}
    pairs = [(r, a) for r, a in pairs if prints[a.name]]
    if not pairs:
        return []
    hits = [F.size(F.collect_set(F.when(value(r.name, a.dataType).isin(prints[a.name]), value(r.name, a.dataType)))).alias(f"p{i}")
            for i, (r, a) in enumerate(pairs)]

    def nulls(df: DataFrame, fields, *more) -> dict:
        one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(f.name).alias(f"c{i}") for i, f in enumerate(fields)], *more).first().asDict()
        return one | {f.name: 1 - one[f"c{i}"] / max(1, one["n"]) for i, f in enumerate(fields)}

    old, new = nulls(stored, removed, *hits), nulls(batch, added)
    share = {(r.name, a.name): old[f"p{i}"] / len(prints[a.name]) for i, (r, a) in enumerate(pairs)
             if abs(old[r.name] - new[a.name]) <= RENAME_NULLS}
    out = []
    for (r, a), x in share.items():
        rivals = [y for (r2, a2), y in share.items() if (r2 == r) != (a2 == a)]
        if x >= least and all(y < x for y in rivals):
            out.append((r, a, x))
    return sorted(out)


class ContractBreach(ValueError):
    """A frame has columns that its contract doesn't name, lacks some, or has them in other types."""


def project_contract(df: DataFrame, contract: T.StructType, drop_extra: bool = False) -> DataFrame:
    """Exactly the contract's columns, in its order and types (P10): never ``select *`` into a sink.

    Extra columns are refused, or dropped if that is asked for by name; missing columns, and types that don't widen
    into the contract's, are refused.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    extra = [c for c in have if c not in contract.fieldNames()]
    missing = [f.name for f in contract.fields if f.name not in have]
    wrong = [f"{f.name} {have[f.name].simpleString()} for {f.dataType.simpleString()}" for f in contract.fields
             if f.name in have and not is_widening(have[f.name], f.dataType)]
    faults = [f"{what}: {', '.join(x)}" for what, x in (("extra", [] if drop_extra else extra), ("missing", missing), ("types", wrong)) if x]
    if faults:
        raise ContractBreach("; ".join(faults))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


# ---------------------------------------------------------------- applying changes

def align_to(batch: DataFrame, target: T.StructType, renames: Mapping[str, str] | None = None,
             keep_new: bool = True) -> DataFrame:
    """Project a batch onto the target's columns.

    ``renames`` maps incoming -> target names (column mapping); target columns
    the batch lacks are NULL-filled (a dropped column stays and stops being
    populated); widened types are cast to the wider of the two; with
    ``keep_new`` new batch columns are appended (additive evolution).
    """
    b = batch
    for src, dst in (renames or {}).items():
        if src in b.columns:
            b = b.withColumnRenamed(src, dst)
    out = []
    for f in target.fields:
        if f.name in b.columns:
            bt = b.schema[f.name].dataType
            typ = bt if is_widening(f.dataType, bt) and bt != f.dataType else f.dataType
            out.append(F.col(f.name).cast(typ).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_new:
        out += [F.col(c) for c in b.columns if c not in target.fieldNames()]
    return b.select(*out)


def evolve_union(target: DataFrame, batch: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Target rows plus the aligned batch with additive / widened schema."""
    aligned = align_to(batch, target.schema, renames)
    wide = {f.name: f.dataType for f in aligned.schema.fields}
    t = target.select(*[F.col(c).cast(wide[c]).alias(c) if c in wide else F.col(c) for c in target.columns])
    return t.unionByName(aligned, allowMissingColumns=True)


def write_options(cfg: EvolutionConfig) -> dict[str, str]:
    """Writer / reader options that carry the decision."""
    return {"mergeSchema": "true"} if cfg.mode == "addNewColumns" or cfg.evolve_and_rescue else {}


def schema_change_record(run_id: str, trace_id: str, entity: str, cfg: EvolutionConfig,
                         res: CompatibilityResult, drift_rows: int, status: str) -> dict:
    """One ``schema_change_audit`` row (A22, G8): decision and outcome."""
    return {"run_id": run_id, "trace_id": trace_id, "entity": entity, "resolved_mode": cfg.mode,
            "evolve_and_rescue": cfg.evolve_and_rescue, "columns_added": res.added,
            "columns_rescued": res.added if cfg.mode == "rescue" else [], "drift_row_count": drift_rows,
            "type_changes": res.widened + res.narrowed, "compat_allowed": res.allowed,
            "compat_reasons": res.reasons, "approval_status": status, "requires_rebuild": res.requires_rebuild}


def drift_summary(quarantine: DataFrame, extra_columns: Sequence[str]) -> DataFrame:
    """Drift rows and the columns they added (A22): one row."""
    return quarantine.agg(F.count(F.lit(1)).cast("bigint").alias("drift_row_count")) \
                     .withColumn("columns_added", F.lit(sorted(extra_columns)).cast("array<string>"))
