"""Type 2 history: incremental merge, rebuild from a change log, as-of reads.

History rows carry ``__start_at`` (inclusive), ``__end_at`` (exclusive, NULL
while open), ``__is_current`` and ``__row_hash`` (hash of the tracked columns,
see :mod:`stratum.functions.hashing`). Exactly one current row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from .merge import apply_changes, dedupe_split
from .sequence import carry_forward, ordered_scan

META = ["__start_at", "__end_at", "__is_current", "__row_hash"]


def _lit_ts(ts) -> Column:
    """A batch instant as TIMESTAMP_NTZ (driver tables are NTZ)."""
    if isinstance(ts, Column):
        return ts
    return F.lit(str(ts)).cast("timestamp_ntz")


def tracked_columns(df: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None) -> list[str]:
    if tracked:
        return list(tracked)
    return [c for c in df.columns if c not in keys and c not in META]


class Scd2Result(NamedTuple):
    """What one batch does to a history. Every batch row is in ``history`` (as a version, or equal to the current one) or
    in ``rejects`` (payload plus ``reject_reason``: MISSING_KEY, DUP_KEY or LATE_DATA)."""

    history: DataFrame
    metrics: DataFrame
    rejects: DataFrame


def scd2_merge(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], batch_ts,
               tracked: Sequence[str] | None = None, delete_detection: str | None = None,
               event_ts_col: str | None = None, once: Callable[[DataFrame], DataFrame] | None = None) -> Scd2Result:
    """Merge one batch into a type 2 history.

    new key -> insert a current version; changed tracked columns -> close the
    current version and insert a new one; unchanged -> nothing; in
    ``delete_detection="snapshot"`` mode current keys missing from the batch
    are closed (never deleted). Of several batch rows with one key, the latest (by
    event time, then by content) counts and the others are rejected as DUP_KEY;
    rows with a NULL key are rejected as MISSING_KEY. With ``event_ts_col`` the
    version starts at the event time; a row older than the current version's
    start is rejected as LATE_DATA.

    Current versions and batch meet in one full outer join; each key expands to
    at most two rows, closed versions pass through. Metrics columns: operation,
    rows_inserted, rows_updated, rows_closed, rows_unchanged, rows_rejected,
    num_output_rows (= inserted + updated).

    History, metrics and late rows all come from that join. ``once`` (such as ``cut_lineage``) is applied to its
    result, so that whoever uses several of them runs it a single time.
    """
    keys = list(keys or [])
    if not keys:
        raise ValueError("SCD2 needs merge keys")
    if delete_detection not in (None, "none", "incremental", "snapshot"):
        raise ValueError(f"unknown delete_detection {delete_detection!r}")
    t = _lit_ts(batch_ts)
    payload = [c for c in batch.columns if c not in META]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    eff = F.coalesce(F.col(event_ts_col).cast("timestamp_ntz"), t) if event_ts_col else t
    staged = batch.select(*payload, row_hash(tracked_columns(batch, keys, tracked)).alias("__row_hash"), eff.alias("__eff"))
    missing = staged.where(no_key).select(*payload, F.lit("MISSING_KEY").alias("reject_reason"))
    winners, losers = dedupe_split(staged.where(~no_key), keys, ["__eff"])
    rejects = missing.unionByName(losers.select(*payload, F.lit("DUP_KEY").alias("reject_reason")))
    left_out = staged.where(no_key).agg(F.count(F.lit(1))).scalar() + losers.agg(F.count(F.lit(1))).scalar()

    new_version = [F.col("__eff").alias("__start_at"), F.lit(None).cast("timestamp_ntz").alias("__end_at"),
                   F.lit(True).alias("__is_current"), F.col("__row_hash")]
    if target is None:
        history = winners.select(*payload, *new_version)
        dec = winners.select(F.lit("new").alias("__action"))
        return Scd2Result(history, _scd2_metrics(dec, False, left_out), rejects)

    out_cols = target.columns + [c for c in payload if c not in target.columns]
    types = {**{f.name: f.dataType for f in batch.schema.fields}, **{f.name: f.dataType for f in target.schema.fields}}
    cur = target.where(F.col("__is_current"))
    c_side = cur.select(*keys, F.struct(*[F.col(c) for c in target.columns]).alias("__c"))
    b_side = winners.select(*keys, F.struct(*[F.col(c) for c in payload], "__row_hash", "__eff").alias("__b"))
    met = c_side.join(b_side, keys, "full_outer")
    in_b, in_c = F.col("__b").isNotNull(), F.col("__c").isNotNull()
    late = F.col("__b.__eff") < F.col("__c.__start_at") if event_ts_col else F.lit(False)
    dec = met.withColumn("__action", F.when(~in_c, "new").when(~in_b, "absent").when(late, "rejected")
                         .when(F.col("__b.__row_hash") != F.col("__c.__row_hash"), "changed").otherwise("unchanged"))
    dec = once(dec) if once else dec
    snapshot = delete_detection == "snapshot"
    act = F.col("__action")
    closing = (act == "changed") | ((act == "absent") & F.lit(snapshot))

    def stored(c: str) -> Column:
        if c not in target.columns:
            return F.lit(None).cast(types[c])
        if c == "__end_at":
            return F.when(closing, F.when(act == "changed", F.col("__b.__eff")).otherwise(t)).otherwise(F.col("__c.__end_at"))
        if c == "__is_current":
            return F.col("__c.__is_current") & ~closing
        return F.col(f"__c.{c}")

    def added(c: str) -> Column:
        if c in META:
            return {"__start_at": F.col("__b.__eff"), "__end_at": F.lit(None).cast("timestamp_ntz"),
                    "__is_current": F.lit(True), "__row_hash": F.col("__b.__row_hash")}[c]
        return (F.col(f"__b.{c}") if c in payload else F.lit(None)).cast(types[c])

    old_row = F.struct(*[stored(c).cast(types[c]).alias(c) for c in out_cols])
    new_row = F.struct(*[added(c).cast(types[c]).alias(c) for c in out_cols])
    versions = F.when(act == "new", F.array(new_row)).when(act == "changed", F.array(old_row, new_row)).otherwise(F.array(old_row))
    fresh = dec.select(F.explode(versions).alias("__v")).select("__v.*")
    history = target.where(~F.coalesce(F.col("__is_current"), F.lit(False))).unionByName(fresh, allowMissingColumns=True).select(*out_cols)
    if event_ts_col:
        rejects = rejects.unionByName(dec.where(act == "rejected").select(
            *[F.col(f"__b.{c}").alias(c) for c in payload], F.lit("LATE_DATA").alias("reject_reason")))
    return Scd2Result(history, _scd2_metrics(dec, snapshot, left_out), rejects)


def _scd2_metrics(dec: DataFrame, snapshot: bool, left_out: Column) -> DataFrame:
    def n(*actions: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("__action").isin(*actions), 1).otherwise(0)), F.lit(0)).cast("bigint")

    closed = n("absent") if snapshot else F.lit(0).cast("bigint")
    return dec.agg(n("new", "changed").alias("rows_inserted"), n("changed").alias("rows_updated"), closed.alias("rows_closed"),
                   n("unchanged").alias("rows_unchanged"), n("rejected").alias("late"), n("new").alias("fresh")).select(
        F.lit("SCD2").alias("operation"), "rows_inserted", "rows_updated", "rows_closed", "rows_unchanged",
        (F.col("late") + left_out).cast("bigint").alias("rows_rejected"),
        (F.col("fresh") + 2 * F.col("rows_updated")).cast("bigint").alias("num_output_rows"))


# ---------------------------------------------------------------- reads

def as_of(history: DataFrame, ts) -> DataFrame:
    """Versions valid at instant ``ts`` (start inclusive, end exclusive)."""
    t = _lit_ts(ts)
    return history.where((F.col("__start_at") <= t) & (F.col("__end_at").isNull() | (F.col("__end_at") > t)))


def current(history: DataFrame) -> DataFrame:
    return history.where(F.col("__is_current"))


def join_asof_history(facts: DataFrame, history: DataFrame, keys: Sequence[str] | dict, ts_col: str,
                      how: str = "left", prefix: str = "") -> DataFrame:
    """Attach to each fact the history version valid at the fact's time.

    ``keys`` is a list of shared key names or a ``{fact_col: history_col}`` mapping; ``how`` is left or inner. Facts and versions go
    through one ordered stream a key, in which the last version is carried forward to the facts, across the borders of
    chunks too (:func:`stratum.operators.sequence.carry_forward`): facts are never compared with versions, and a key
    with many of both is spread over tasks. Versions of a key mustn't overlap, as the merges here leave them; of
    several with one start the one that ends last counts. NULL keys and NULL times meet nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"as-of joins are left or inner, not {how}")
    kmap = dict(keys) if isinstance(keys, dict) else {k: k for k in keys}
    ks = [f"__k{i}" for i in range(len(kmap))]
    h_cols = [c for c in history.columns if c not in kmap.values()]
    known = F.lit(True)
    for c in kmap.values():
        known = known & F.col(c).isNotNull()
    far = F.lit("9999-12-31").cast("timestamp_ntz")
    versions = history.where(known & F.col("__start_at").isNotNull()).select(
        F.col("__start_at").cast("timestamp_ntz").alias("__at"), F.lit(0).alias("__kind"), F.coalesce(F.col("__end_at").cast("timestamp_ntz"), far).alias("__to"),
        *[F.col(v).cast(facts.schema[f].dataType).alias(k) for k, (f, v) in zip(ks, kmap.items())],
        F.lit(None).cast(facts.select(F.struct("*").alias("f")).schema["f"].dataType).alias("__f"), F.struct(*[F.col(c) for c in h_cols]).alias("__h"))
    rows = facts.select(F.col(ts_col).cast("timestamp_ntz").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("timestamp_ntz").alias("__to"),
                        *[F.col(f).alias(k) for k, f in zip(ks, kmap)], F.struct("*").alias("__f"),
                        F.lit(None).cast(versions.schema["__h"].dataType).alias("__h"))
    # facts at one time are alike to the versions before them, so they need no tie-breaker
    version = F.when(F.col("__kind") == 0, F.struct("__h", "__to"))
    seen = carry_forward(versions.unionByName(rows), ks, ["__at", "__kind", "__to"], version, "__v").where(F.col("__kind") == 1)
    valid = F.coalesce(F.col("__at") < F.col("__v.__to"), F.lit(False))
    if how == "inner":
        seen = seen.where(valid)
    return seen.select("__f.*", *[F.when(valid, F.col(f"__v.__h.{c}")).alias(prefix + c) for c in h_cols])


# ---------------------------------------------------------------- rebuild from a log

def scd2_from_log(changes: DataFrame, keys: Sequence[str], ts_col: str,
                  tracked: Sequence[str] | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Build full type 2 history from a change log in one pass, in any order.

    Rows whose tracked values equal the previous row of the key are dropped;
    each kept row starts at its own time and ends where the next kept row of
    the key starts. Uses the skew-safe ordered scan twice (lag to drop
    repeats, lead to close intervals).
    """
    keys = list(keys)
    trk = tracked_columns(changes.drop(ts_col), keys, tracked)
    order = [ts_col, *tie_break]
    staged = changes.withColumn("__row_hash", row_hash(trk))
    with_prev = ordered_scan(staged, keys, order, lag_cols=["__row_hash"])
    kept = with_prev.where(F.col("prev___row_hash").isNull() | (F.col("prev___row_hash") != F.col("__row_hash"))) \
                    .drop("prev___row_hash")
    with_next = ordered_scan(kept, keys, order, lead_cols=[ts_col])
    return with_next.select(
        *[c for c in changes.columns],
        F.col(ts_col).cast("timestamp_ntz").alias("__start_at"),
        F.col(f"next_{ts_col}").cast("timestamp_ntz").alias("__end_at"),
        F.col(f"next_{ts_col}").isNull().alias("__is_current"),
        "__row_hash")


# ---------------------------------------------------------------- history in any order (ST8, L20)

#: Hash of a row that ends its key's versions.
DELETED = "deleted"


class Spliced(NamedTuple):
    """A history that takes rows in any order. Rows without a key or a time are in ``rejects`` (``reject_reason`` MISSING_KEY)."""

    history: DataFrame
    rejects: DataFrame


def splice(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], ts_col: str, tracked: Sequence[str] | None = None,
           tie_break: Sequence[str] = (), op_col: str | None = None, delete_ops: Sequence[str] = ("D",)) -> Spliced:
    """Take the rows of ``batch`` into a type 2 history, whatever their order and however often they come.

    A row splits the version it falls into, or begins one, at its own time; one that is equal to the version to its
    left begins none. Such rows, and deletes, stay in the history as empty intervals (start = end), because a row that comes
    later still may fall between them and make them count: so any cutting of one log into batches gives the same
    history, that of :func:`scd2_from_log`. :func:`versions` hides them. Rows of one key and time are ordered by
    ``tie_break``, then by content; the same row twice counts once.
    """
    keys = list(keys)
    payload = [c for c in batch.columns if c not in META and c != op_col]
    trk = tracked_columns(batch.select(*payload).drop(ts_col, *tie_break), keys, tracked)
    unplaced = F.col(ts_col).isNull()
    for k in keys:
        unplaced = unplaced | F.col(k).isNull()
    h = row_hash(trk)
    if op_col:
        h = F.when(F.col(op_col).isin(list(delete_ops)), DELETED).otherwise(h)
    staged = batch.select("*", h.alias("__row_hash"))
    rejects = staged.where(unplaced).select(*batch.columns, F.lit("MISSING_KEY").alias("reject_reason"))
    log = staged.where(~unplaced).select(*payload, "__row_hash")
    if target is not None:
        log = target.drop("__start_at", "__end_at", "__is_current").unionByName(log, allowMissingColumns=True)
    order = [ts_col, *tie_break, "__row_hash"]
    log = log.dropDuplicates([*keys, *order])
    cols = [c for c in log.columns if c != "__row_hash"]
    scanned = ordered_scan(log, keys, order, lag_cols=["__row_hash"])
    begins = ~F.col("__row_hash").eqNullSafe(F.col("prev___row_hash")) & ~(F.col("prev___row_hash").isNull() & (F.col("__row_hash") == DELETED))
    flagged = scanned.withColumn("__begins", begins).drop("prev___row_hash")
    opened = ordered_scan(flagged.where("__begins"), keys, order, lead_cols=[ts_col])
    start, end = F.col(ts_col).cast("timestamp_ntz"), F.col(f"next_{ts_col}").cast("timestamp_ntz")
    alive = F.col("__row_hash") != DELETED
    shown = opened.select(*cols, start.alias("__start_at"), F.when(alive, end).otherwise(start).alias("__end_at"),
                          (alive & end.isNull()).alias("__is_current"), "__row_hash")
    hidden = flagged.where(~F.col("__begins")).select(*cols, start.alias("__start_at"), start.alias("__end_at"),
                                                      F.lit(False).alias("__is_current"), "__row_hash")
    return Spliced(shown.unionByName(hidden), rejects)


def versions(history: DataFrame) -> DataFrame:
    """A history without the empty intervals that :func:`splice` keeps."""
    return history.where(F.col("__end_at").isNull() | (F.col("__start_at") < F.col("__end_at")))


def apply_feed(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], scd_type: int = 1,
               op_col: str | None = None, delete_ops: Sequence[str] = ("D",), tracked: Sequence[str] | None = None) -> DataFrame:
    """``KEYS ... SEQUENCE BY ... STORED AS SCD TYPE 1 | 2`` over a feed of changes in any order.

    ``sequence_by`` begins with the event time for type 2; its further columns break ties. The result is the state to
    store: :func:`stratum.operators.merge.live_rows` or :func:`versions` show it.
    """
    if scd_type == 2:
        return splice(target, changes, keys, sequence_by[0], tracked, sequence_by[1:], op_col, delete_ops).history
    if scd_type != 1:
        raise ValueError(f"unknown SCD type {scd_type}")
    op = op_col or "__op"
    return apply_changes(target, changes if op_col else changes.withColumn(op, F.lit("U")), keys, sequence_by, op, delete_ops, tombstones=True)


# ---------------------------------------------------------------- history checks

def version_no(history: DataFrame, keys: Sequence[str], start_col: str = "__start_at",
               out: str = "version_no") -> DataFrame:
    """1-based version number per key in start order."""
    return ordered_scan(history, keys, [start_col, "__row_hash"], index_col=out)


def validate_history(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: versions, current rows, overlapping or gapped intervals.

    ``ok`` is true when exactly one version is current, it is the open one,
    and every closed version ends exactly where the next one starts.
    """
    keys = list(keys)
    s = ordered_scan(versions(history), keys, ["__start_at", "__row_hash"], lead_cols=["__start_at"])
    overlap = F.col("next___start_at").isNotNull() & (F.col("__end_at").isNull() |
                                                      (F.col("next___start_at") < F.col("__end_at")))
    gap = F.col("next___start_at").isNotNull() & F.col("__end_at").isNotNull() & \
        (F.col("next___start_at") > F.col("__end_at"))
    agg = s.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_versions"),
        F.sum(F.when(F.col("__is_current"), 1).otherwise(0)).cast("bigint").alias("n_current"),
        F.sum(F.when(overlap, 1).otherwise(0)).cast("bigint").alias("n_overlaps"),
        F.sum(F.when(gap, 1).otherwise(0)).cast("bigint").alias("n_gaps"),
        F.sum(F.when(F.col("__end_at").isNull() != F.col("__is_current"), 1).otherwise(0))
         .cast("bigint").alias("n_bad_open"))
    return agg.withColumn("ok", (F.col("n_current") == 1) & (F.col("n_overlaps") == 0) &
                          (F.col("n_gaps") == 0) & (F.col("n_bad_open") == 0))


# ---------------------------------------------------------------- SCD6

def scd6_view(history: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Type 6: every version also carries the key's current value of ``cols``."""
    keys = list(keys)
    cur = history.where(F.col("__is_current")).select(*keys, *[F.col(c).alias(f"current_{c}") for c in cols])
    return history.join(cur, keys, "left")
