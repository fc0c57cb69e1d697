"""Ingestion and harmonisation runs (X1-X5): read -> decide on the schema ->
split -> load -> balance -> ledger, composed from the operators.

The driver only makes decisions from schemas and one-row metrics; the data
path is one lazy plan per step, persisted once where several consumers read it
(the clean / quarantine split) and released however the run ends.

What a run guarantees: every row read is written, equal to what is stored, or in
the quarantine. Nothing is committed before all decisions are made.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evolve as E
from ..operators import history as H
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import quarantine as QR
from ..sources.readers import with_read_retry
from ..session import cut_lineage
from ..sinks.ledger import RunHandle, RunLedger
from ..sinks.store import TableStore

LOAD_PATTERNS = ("APPEND", "OVERWRITE", "PARTITION_OVERWRITE", "SCD1", "MERGE", "UPSERT", "SCD2", "CDC")


@dataclass
class IngestionConfig:
    entity: str
    target_table: str
    load_pattern: str = "APPEND"
    keys: Sequence[str] = ()
    sequence: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    rules: Sequence[Q.Rule] = ()
    evolution: E.EvolutionContext = field(default_factory=E.EvolutionContext)
    renames: Mapping[str, str] = field(default_factory=dict)
    batch_ts: str | None = None
    tracked: Sequence[str] | None = None
    delete_detection: str | None = None
    event_ts_col: str | None = None
    op_col: str | None = None             # CDC: operation column
    delete_ops: Sequence[str] = ("D",)
    find_renames: bool = False            # look for renamed columns by their values; mapped if the policy maps columns
    watermark: str | None = None          # incremental: only rows above the stored mark are read


@dataclass
class RunResult:
    status: str                           # SUCCESS | DEFERRED | REJECTED | FAILED
    rows_read: int
    rows_written: int
    rows_rejected: int
    balance_delta: int
    messages: list = field(default_factory=list)


def _decide(cfg: IngestionConfig, evo: E.EvolutionConfig, compat: E.CompatibilityResult | None) -> str:
    """apply, rescue, defer or reject the batch as a whole (E7-E9), from schemas alone."""
    if compat is None:
        return "apply"
    changed = compat.added or compat.widened or compat.narrowed or compat.suspected_renames
    if compat.narrowed or (compat.widened and not evo.enable_type_widening):
        return "reject"
    if compat.suspected_renames and not evo.enable_column_mapping and evo.mode != "rescue":
        return "reject"
    if changed and evo.require_approval:
        return "defer"
    if compat.added and evo.mode == "failOnNewColumns":
        return "defer"
    if compat.added and evo.mode in ("rescue", "none"):
        return "rescue"
    return "apply"


def _whole_as_json(df: DataFrame) -> DataFrame:
    """A batch whose types may not fit the quarantine's columns: each row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("_rescued_data"))


class _Run:
    """One run: collects what goes to quarantine and counts it."""

    def __init__(self, store: TableStore, ledger: RunLedger, cfg: IngestionConfig, h: RunHandle):
        self.store, self.ledger, self.cfg, self.h = store, ledger, cfg, h
        self.parts: list[DataFrame] = []

    def aside(self, df: DataFrame, reason: str, detail: str = "") -> None:
        self.parts.append(QR.stamp(df, reason, self.h.run_id, detail))

    def write_quarantine(self) -> int:
        n = 0
        for part in self.parts:
            n += self.store.append(f"{self.cfg.target_table}_quarantine", part, ("quarantine_date",)).num_output_rows
        self.parts = []
        return n


def run_ingestion(spark: SparkSession, store: TableStore, ledger: RunLedger, cfg: IngestionConfig,
                  read: Callable[[], DataFrame], run_type: str = "BATCH", parents: Mapping[str, DataFrame] | None = None,
                  as_of=None) -> RunResult:
    """One batch run (X1, X2, X4). Balance: read = written or unchanged + quarantined."""
    if cfg.load_pattern.upper() not in LOAD_PATTERNS:
        raise ValueError(f"unknown load pattern {cfg.load_pattern}")
    h = ledger.start_run("ingestion", cfg.entity, run_type)
    run = _Run(store, ledger, cfg, h)
    held: DataFrame | None = None
    try:
        target = store.read(cfg.target_table)

        def taken() -> tuple[DataFrame, int]:
            df = read()
            df = (_not_loaded(store, cfg, df, target) if cfg.watermark else df).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                return df, df.count()  # the read happens here, so here it can be tried again
            except Exception:
                df.unpersist()
                raise

        src, n_read = with_read_retry(taken)
        held = src
        evo = E.resolve_schema_evolution(cfg.evolution)
        clean, compat, decision = src, None, "apply"
        if cfg.watermark:
            clean = src.where(F.col(_PLACE).isin("above", "tied")).drop(_PLACE)
            run.aside(src.where(F.col(_PLACE) == "none").drop(_PLACE), "MISSING_KEY", f"no value in {cfg.watermark}")
            run.aside(src.where(F.col(_PLACE) == "under").drop(_PLACE), "LATE_DATA", f"{cfg.watermark} under the stored mark")
            src = src.drop(_PLACE)
        for a, b in (cfg.renames if evo.enable_column_mapping else {}).items():
            clean = clean.withColumnRenamed(a, b) if a in clean.columns else clean
        if target is not None and cfg.load_pattern.upper() != "OVERWRITE":
            hidden = {*H.META, M.TOMBSTONE}
            known = target.select(*[c for c in target.columns if c not in hidden])
            payload = clean.drop(cfg.op_col) if cfg.op_col else clean
            moved = [(r, a) for r, a, _ in E.renames_by_content(known, payload)] if cfg.find_renames else None
            if moved and evo.enable_column_mapping:
                clean, payload = (df.withColumnsRenamed({a: r for r, a in moved}) for df in (clean, payload))
                moved = []
            compat = E.validate_schema_compatibility(payload.schema, known.schema, evo, cfg.evolution.scd_type, moved)
            decision = _decide(cfg, evo, compat)
            ledger.log_decision(h, E.schema_change_record(h.run_id, h.trace_id, cfg.entity, evo, compat, 0, "PENDING"))
        if decision in ("reject", "defer"):
            reasons = "; ".join(compat.reasons) or "schema change needs approval"
            run.parts = []
            run.aside(_whole_as_json(src), "SCHEMA_DRIFT", reasons)
            return _finish(run, n_read, 0, run.write_quarantine(), "REJECTED" if decision == "reject" else "DEFERRED",
                           compat.reasons, evo, compat)
        rescued = None
        if compat is not None and compat.added and (decision == "rescue" or evo.evolve_and_rescue):
            expected = [c for c in clean.columns if c not in compat.added]
            without, rescued = QR.capture_drift(clean, expected, only_populated=True)
            clean = without if decision == "rescue" else clean
        if cfg.keys:
            clean, bad_keys = QR.split_missing_keys(clean, cfg.keys)
            run.aside(bad_keys, "MISSING_KEY")
        if cfg.rules:
            clean, bad, results = Q.apply_rules(clean, list(cfg.rules), parents, as_of or cfg.batch_ts)
            clean = clean.drop("_dq_warnings")
            run.aside(bad.withColumn("_dq_failed_rules", F.concat_ws(",", "_dq_failed_rules")), "DQ_FAILURE")
            ledger.log_dq(h, results)
            Q.enforce(results)  # a FAIL rule ends the run before anything is written
        p = cfg.load_pattern.upper()
        if p in ("SCD1", "MERGE", "UPSERT"):
            clean, losers = M.dedupe_split(clean, cfg.keys, cfg.sequence)
            run.aside(losers, "DUP_KEY")
        if compat is not None and (compat.widened or compat.removed or compat.added) and decision != "rescue":
            clean = E.align_to(clean, known.schema) if not cfg.op_col else clean
            if compat.widened:  # stored files take the wider types first
                wide = clean.schema
                store.replace(cfg.target_table, store.read(cfg.target_table).select(*[
                    F.col(c).cast(wide[c].dataType).alias(c) if c in compat.widened else F.col(c) for c in target.columns]),
                    cfg.partition_by, _layout_keys(cfg))
        elif compat is not None and compat.removed:
            clean = E.align_to(clean, known.schema)
        try:
            written, extra = _load(store, cfg, clean)
        except Exception as e:
            run.parts = []  # the whole batch goes aside, once
            run.aside(_whole_as_json(src), "WRITE_FAILURE", f"{type(e).__name__}: {e}")
            run.write_quarantine()
            raise
        if extra is not None:
            for reason in ("MISSING_KEY", "DUP_KEY", "LATE_DATA"):
                run.aside(extra.where(F.col("reject_reason") == reason).drop("reject_reason"), reason)
        rejected = run.write_quarantine()
        if rescued is not None:  # copies of rows that were written, so they don't count as rejected
            store.append(f"{cfg.target_table}_rescued", QR.stamp(rescued, "SCHEMA_DRIFT", h.run_id, "columns not in the target"))
        if cfg.watermark:
            _store_mark(store, cfg, clean)
        return _finish(run, n_read, written, rejected, None, compat.reasons if compat else [], evo, compat)
    except Exception as e:
        ledger.log_exception(h, e, "ingestion")
        ledger.end_run(h, "FAILED")
        raise
    finally:
        if held is not None:
            held.unpersist()


def _finish(run: _Run, n_read: int, written: int, rejected: int, status: str | None, messages: Sequence[str],
            evo: E.EvolutionConfig, compat: E.CompatibilityResult | None) -> RunResult:
    delta = n_read - written - rejected
    status = status or ("SUCCESS" if delta == 0 else "FAILED")
    if compat is not None:
        run.ledger.log_decision(run.h, E.schema_change_record(run.h.run_id, run.h.trace_id, run.cfg.entity, evo, compat, rejected,
                                                              status))
    run.ledger.log_audit(run.h, {"rows_read": n_read, "rows_written": written, "rows_rejected": rejected})
    run.ledger.log_balance(run.h, run.store.spark.createDataFrame(
        [(n_read, written, rejected, delta, delta == 0)],
        "rows_read long, rows_written long, rows_rejected long, balance_delta long, balanced boolean"))
    run.ledger.end_run(run.h, "SUCCESS" if status == "SUCCESS" else "FAILED", attributes={"outcome": status})
    return RunResult(status, n_read, written, rejected, delta, list(messages))


def _layout_keys(cfg: IngestionConfig) -> Sequence[str]:
    return cfg.keys if cfg.load_pattern.upper() in ("SCD1", "MERGE", "UPSERT", "SCD2", "CDC") else ()


def _load(store: TableStore, cfg: IngestionConfig, clean: DataFrame) -> tuple[int, DataFrame | None]:
    """(rows accounted for, rows the load itself rejects)."""
    p = cfg.load_pattern.upper()
    if p == "APPEND":
        return store.append(cfg.target_table, clean, cfg.partition_by).num_output_rows, None
    if p == "OVERWRITE":
        return store.replace(cfg.target_table, clean, cfg.partition_by).num_output_rows, None
    if p == "PARTITION_OVERWRITE":
        return store.overwrite_partitions(cfg.target_table, clean, cfg.partition_by).num_output_rows, None
    if p in ("SCD1", "MERGE", "UPSERT"):
        r = store.merge(cfg.target_table, lambda cur: (
            clean.withColumn("__action", F.lit("insert")) if cur is None else M.scd1_actions(cur, clean, cfg.keys),
            M.scd1_metrics()), cfg.keys, clean)
        return int(r["rows_written"]), None
    if p == "CDC":
        if not cfg.op_col or not cfg.sequence:
            raise ValueError("CDC needs op_col and sequence")
        # older changes of a key are superseded, not lost: every change was weighed
        n = clean.count()
        store.merge(cfg.target_table, lambda cur: M.apply_changes(cur, clean, cfg.keys, cfg.sequence, cfg.op_col, cfg.delete_ops,
                                                                  tombstones=True), cfg.keys, clean)
        return n, None
    ts = cfg.batch_ts or "1970-01-01 00:00:00"
    done: list[H.Scd2Result] = []

    def plan(cur):
        # the join is written once: metrics, history and late rows read it, whatever becomes of the table
        done.append(H.scd2_merge(cur, clean, cfg.keys, ts, cfg.tracked, cfg.delete_detection, cfg.event_ts_col, cut_lineage))
        return done[-1]

    scoped = None if cfg.delete_detection == "snapshot" else clean
    r = store.merge(cfg.target_table, plan, cfg.keys, scoped)
    return int(r["rows_inserted"] + r["rows_unchanged"]), done[-1].rejects


#: Where a row stands to the stored mark: above, tied, under, or none (no value).
_PLACE = "__place"


def _not_loaded(store: TableStore, cfg: IngestionConfig, src: DataFrame, target: DataFrame | None) -> DataFrame:
    """The rows of an incremental read, with their place to the stored mark; rows that earlier runs loaded are left out.

    At the mark, that is rows equal to a stored one; under it too, or, where the load has keys, rows whose key is stored.
    What is left under the mark came late.
    """
    c = F.col(cfg.watermark)
    top = _mark(store, cfg, src)
    place = F.when(c.isNull(), "none")
    if top is None or target is None:
        return src.withColumn(_PLACE, place.otherwise("above"))
    limit = F.lit(top)
    placed = src.withColumn(_PLACE, place.when(c > limit, "above").when(c == limit, "tied").otherwise("under"))
    same = [x for x in src.columns if x in target.columns]
    keys = [k for k in cfg.keys if k in target.columns] or same

    def unseen(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        known = target.select(*[F.col(x).alias(f"__t_{i}") for i, x in enumerate(by)])
        return rows.join(known, [F.col(x).eqNullSafe(F.col(f"__t_{i}")) for i, x in enumerate(by)], "left_anti")

    return (placed.where(F.col(_PLACE).isin("above", "none"))
            .unionByName(unseen(placed.where(F.col(_PLACE) == "tied"), same))
            .unionByName(unseen(placed.where(F.col(_PLACE) == "under"), keys)))


def _mark(store: TableStore, cfg: IngestionConfig, src: DataFrame):
    """The highest mark stored, as a value of the watermark column's type (marks of older tables were text)."""
    dtype = src.schema[cfg.watermark].dataType
    tops = [m.agg(F.max(F.col("mark").cast(dtype))).first()[0] for m in (
        store.read(f"{cfg.target_table}_{name}") for name in ("watermarks", "marks")) if m is not None]
    return max((t for t in tops if t is not None), default=None)


def _store_mark(store: TableStore, cfg: IngestionConfig, loaded: DataFrame) -> None:
    """The highest value loaded, in its own type; kept only when the load is through."""
    top = loaded.agg(F.max(cfg.watermark).alias("mark")).where("mark is not null")
    store.append(f"{cfg.target_table}_watermarks", top)


def run_harmonization_load(spark: SparkSession, store: TableStore, ledger: RunLedger, cfg: IngestionConfig, silver_sql: str,
                           inputs: Mapping[str, str | DataFrame], transform: Callable[[DataFrame], DataFrame] | None = None,
                           parents: Mapping[str, DataFrame] | None = None, as_of=None) -> RunResult:
    """Harmonisation with its load (X5): SQL over named inputs (frames, or names of stored tables), an optional Python
    transform, then rules (``parents`` for references, ``as_of`` for freshness), history or upsert, balance and
    ledger, as any run. A stored input that isn't there raises.
    """
    def read() -> DataFrame:
        frames = {n: store.read(i) if isinstance(i, str) else i for n, i in inputs.items()}
        if missing := sorted(n for n, f in frames.items() if f is None):
            raise ValueError(f"no such input: {missing}")
        df = spark.sql(silver_sql, **frames)
        return transform(df) if transform else df

    return run_ingestion(spark, store, ledger, cfg, read, "HARMONIZATION", parents, as_of)


def run_harmonization(silver_sql: str, spark: SparkSession, inputs: dict, keys: Sequence[str],
                      rules: Sequence[Q.Rule] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Harmonisation step (X5): SQL transform, then rules; returns
    (good, bad, results) ready for an SCD load."""
    df = spark.sql(silver_sql, **inputs)
    if not rules:
        return df, df.limit(0), spark.createDataFrame([], "rule_id string")
    return Q.apply_rules(df, list(rules))
