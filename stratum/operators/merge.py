"""Upsert-style load plans as pure DataFrame transformations.

Each plan takes the current target and a batch and returns the new target
(plus, where useful, a one-row metrics DataFrame). Nothing is written here;
``stratum.sinks`` persists results. Because the plans are pure they run the
same way on a table, inside ``foreachBatch`` and against a SQL oracle.

Scale notes: every plan is joins on the business keys plus unions. Batches are
reduced to one row per key with a partial (map-side) aggregate before any
join, so a hot key cannot inflate a join; skewed target keys are split by AQE's
skew-join handling (sort-merge joins) or by a broadcast that AQE picks only
after measuring the side at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _require_keys(keys: Sequence[str]) -> list[str]:
    keys = list(keys or [])
    if not keys:
        raise ValueError("merge keys are required")
    return keys


def null_safe_equal(left: DataFrame | None, right: DataFrame | None, cols: Sequence[str],
                    lp: str = "", rp: str = "") -> Column:
    """AND of ``l.c <=> r.c`` over ``cols`` (prefix-addressed columns)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{lp}{c}").eqNullSafe(F.col(f"{rp}{c}"))
    return cond


# ---------------------------------------------------------------- dedupe

def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t.fields)


def orderable(df: DataFrame, c: str) -> Column:
    """The column, or its JSON text where Spark can't order its type (maps)."""
    return F.to_json(F.struct(F.col(c))) if _has_map(df.schema[c].dataType) else F.col(c)


def _rank_struct(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Column:
    """``order``, then all other columns: a total order of a key's rows, up to equal rows."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return F.struct(*[orderable(df, c).alias(f"o{i}") for i, c in enumerate([*order, *rest])])


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` value.

    Ties are broken on all remaining columns, so the result does not depend
    on partitioning. A single ``max_by`` aggregate is combined map-side, so a hot
    key is reduced before the shuffle. Any column type may occur, maps too.
    """
    keys = _require_keys(keys)
    vals = [c for c in df.columns if c not in keys]
    if not vals:
        return df.distinct()
    packed = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(vals)])
    won = df.groupBy(*keys).agg(F.max_by(packed, _rank_struct(df, keys, list(order))).alias("__w"))
    out = [F.col(k) for k in keys] + [F.col(f"__w.v{i}").alias(c) for i, c in enumerate(vals)]
    return won.select(*out).select(*df.columns)


def dedupe_split(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(winners, losers): losers are every other row of a duplicated key.

    Losers are what the quarantine receives with reason ``DUP_KEY``: all rows
    below their key's winner, and all but one of the rows equal to it. Only one
    row per duplicated key meets its rows in the join, so a hot key is split by
    AQE like any skewed join.
    """
    keys = _require_keys(keys)
    rank = _rank_struct(df, keys, list(order))
    top = (df.groupBy(*keys).agg(F.max(rank).alias("__top"), F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
           .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__top"))
    same_key = F.lit(True)
    for i, k in enumerate(keys):
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    met = df.withColumn("__rank", rank).join(top, same_key)
    below = met.where(F.col("__rank") < F.col("__top")).select(*df.columns)
    twin = met.where(F.col("__rank") == F.col("__top")).groupBy("__top", *keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*df.columns)).alias("__row")).where(F.col("__n") > 1)
    twins = twin.select(F.explode(F.expr("sequence(2, __n)")).alias("__i"), "__row").select("__row.*")
    return dedupe_latest(df, keys, order), below.unionByName(twins)


# ---------------------------------------------------------------- SCD1

def _sides(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target and batch side by side per key: ``__t`` and ``__b`` are NULL where a side lacks the key."""
    t = target.select(*keys, F.struct(F.lit(1).alias("__x"), *[F.col(c) for c in target.columns if c not in keys]).alias("__t"))
    b = batch.select(*keys, F.struct(F.lit(1).alias("__x"), *[F.col(c) for c in batch.columns if c not in keys]).alias("__b"))
    return t.join(b, list(keys), "full_outer")


def scd1_actions(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The upserted table plus ``__action`` (keep, insert, update, unchanged): one full outer join."""
    keys = _require_keys(keys)
    common = [c for c in batch.columns if c in target.columns and c not in keys]
    in_t, in_b = F.col("__t").isNotNull(), F.col("__b").isNotNull()
    same = null_safe_equal(None, None, common, lp="__t.", rp="__b.")
    out = []
    for c in target.columns + [c for c in batch.columns if c not in target.columns]:
        if c in keys:
            out.append(F.col(c))
        elif c not in batch.columns:
            out.append(F.col(f"__t.{c}").alias(c))
        elif c not in target.columns:
            out.append(F.col(f"__b.{c}").alias(c))
        else:
            out.append(F.when(in_b, F.col(f"__b.{c}")).otherwise(F.col(f"__t.{c}")).alias(c))
    action = F.when(~in_b, "keep").when(~in_t, "insert").when(same, "unchanged").otherwise("update")
    return _sides(target, batch, keys).select(*out, action.alias("__action"))


def scd1_metrics(skip_unchanged: bool = False) -> list[Column]:
    """Aggregates over ``__action``: for ``agg`` or for an ``Observation`` on the write itself."""
    a = F.col("__action")
    def n(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")
    updated = a == "update" if skip_unchanged else a.isin("update", "unchanged")
    return [n(a == "insert").alias("rows_inserted"), n(updated).alias("rows_updated"),
            n(a == "unchanged").alias("rows_unchanged"), n((a == "insert") | updated).alias("rows_written")]


def scd1_merge(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
               skip_unchanged: bool = False) -> tuple[DataFrame, DataFrame]:
    """Upsert: matched keys take the batch row, unmatched batch rows are added.

    Columns only the target has keep their target value on matched keys (a
    MERGE updates only the batch's columns); columns only the batch has are
    added (NULL on untouched rows). Returns ``(new_target, metrics)`` where
    metrics has ``rows_inserted, rows_updated, rows_unchanged, rows_written``.
    ``rows_updated`` counts every matched key unless ``skip_unchanged``.
    """
    keys = _require_keys(keys)
    if target is None:  # L7 initial load: plain append of the batch
        acts = batch.withColumn("__action", F.lit("insert"))
    else:
        acts = scd1_actions(target, batch, keys)
    metrics = acts.agg(*scd1_metrics(skip_unchanged)).select(F.lit("SCD1").alias("operation"), "*")
    return acts.drop("__action"), metrics


# ---------------------------------------------------------------- SCD3

def scd3_merge(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
               cols: Sequence[str]) -> DataFrame:
    """Type 3: keep one previous value per tracked column in ``prev_<c>``.

    A changed value moves the old value into ``prev_<c>``; an unchanged value
    keeps the stored ``prev_<c>``. Keys not in the batch stay as they are;
    columns only the batch has are added.
    """
    keys = _require_keys(keys)
    cols = list(cols)
    if target is None:
        return batch.select("*", *[F.lit(None).cast(batch.schema[c].dataType).alias(f"prev_{c}") for c in cols])
    # the old values ride along in the same join
    joined = scd1_actions(target.withColumns({f"__old_{c}": F.col(c) for c in cols}), batch, keys)
    prev = {f"prev_{c}": F.when((F.col("__action") == "update") & ~F.col(c).eqNullSafe(F.col(f"__old_{c}")), F.col(f"__old_{c}"))
            .otherwise(F.col(f"prev_{c}")) for c in cols}
    out = target.columns + [c for c in batch.columns if c not in target.columns]
    return joined.withColumns(prev).select(*out)


# ---------------------------------------------------------------- delete-insert

def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace all target rows of every key present in the batch.

    The batch may hold many rows per key. The batch key set is reduced with a
    distinct (partial aggregate) before the anti join. Columns that only one
    side has are kept and NULL on the other's rows.
    """
    keys = _require_keys(keys)
    batch_keys = batch.select(*keys).distinct()
    kept = target.join(batch_keys, keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


# ---------------------------------------------------------------- CDC apply

TOMBSTONE = "__deleted"


def latest_changes(changes: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Last change per key by sequence (ties broken on the full row)."""
    return dedupe_latest(changes, keys, seq)


def apply_changes(target: DataFrame | None, changes: DataFrame, keys: Sequence[str],
                  seq: Sequence[str], op_col: str, delete_ops: Sequence[str] = ("D",),
                  tombstones: bool = False) -> DataFrame:
    """Apply a change feed (insert / update / delete by sequence), SCD1 style.

    Stored rows and changes compete for their key on the full sequence, so it
    does not matter in which order or how often batches arrive, provided that
    the stored table keeps deleted keys: with ``tombstones`` the result has the
    column ``__deleted`` and a row for each deleted key, which later calls
    take into account. :func:`live_rows` hides them. One aggregate, no join. A target
    without the sequence columns loses to any change.
    The result has the change columns minus ``op_col``; columns that only one
    side has are kept.
    """
    keys = _require_keys(keys)
    every = changes.withColumn(TOMBSTONE, F.coalesce(F.col(op_col).isin(list(delete_ops)), F.lit(False))).drop(op_col)
    if target is not None:
        stored = target if TOMBSTONE in target.columns else target.withColumn(TOMBSTONE, F.lit(False))
        every = stored.unionByName(every, allowMissingColumns=True)
    last = dedupe_latest(every, keys, list(seq))
    return last if tombstones else live_rows(last)


def live_rows(state: DataFrame) -> DataFrame:
    """A CDC state without its tombstones."""
    return state.where(~F.col(TOMBSTONE)).drop(TOMBSTONE) if TOMBSTONE in state.columns else state


# ---------------------------------------------------------------- change data feed

def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level diff of two versions keyed by ``keys``.

    Output: the row columns plus ``_change_type`` in
    (insert, update_preimage, update_postimage, delete). Unchanged rows are
    not emitted. One full outer join; each key expands to at most two rows.
    """
    keys = _require_keys(keys)
    vals = [c for c in new.columns if c not in keys]
    o = old.select(*keys, F.struct(*[F.col(c) for c in vals]).alias("__o"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in vals]).alias("__n"))
    j = o.join(n, keys, "full_outer")
    same = F.col("__o").eqNullSafe(F.col("__n"))
    events = F.when(F.col("__o").isNull(),
                    F.array(F.struct(F.lit("insert").alias("t"), F.col("__n").alias("v"))))\
        .when(F.col("__n").isNull(),
              F.array(F.struct(F.lit("delete").alias("t"), F.col("__o").alias("v"))))\
        .when(~same, F.array(F.struct(F.lit("update_preimage").alias("t"), F.col("__o").alias("v")),
                             F.struct(F.lit("update_postimage").alias("t"), F.col("__n").alias("v"))))
    x = j.where(~same).select(*keys, F.explode(events).alias("__e"))
    return x.select(*keys, *[F.col(f"__e.v.{c}").alias(c) for c in vals], F.col("__e.t").alias("_change_type"))


# ---------------------------------------------------------------- dynamic partition overwrite (L4)

def partition_overwrite(target: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Result of a dynamic partition overwrite, as a plan.

    Exactly the partition *values* present in the batch are replaced; other
    partitions are kept. An empty batch replaces nothing. One NULL-safe anti join with the distinct
    values, at plan time and at any number of columns and values; Spark broadcasts them, and
    prunes a partitioned scan by them, where they are few.
    """
    pcols = list(partition_cols)
    if not pcols:
        return batch
    touched = batch.select(*[F.col(c).alias(f"__p{i}") for i, c in enumerate(pcols)]).distinct()
    kept = target.join(touched, [F.col(c).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(pcols)], "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)
