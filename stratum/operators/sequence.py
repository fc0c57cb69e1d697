"""Per-key ordered scans (lag / lead / row index / running sums, rolling frames,
last value carried forward) that stay parallel when one key holds a large share
of the rows.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one
task; a key with a third of the table then runs on one core. Here a key's rows
are cut into chunks by a fixed bucket of the order value (an hour, a day, 1,024
numbers), so a row's chunk follows from the row alone: no sample, no physical
partition ids, no checkpoint, and the whole scan is one lazy plan. Windows run per
(key, chunk). What crosses a chunk's border comes from one summary row per
chunk (its first and last row, its counts and sums, or its last k rows), built
with partial aggregates, carried along the chunks of a key by a window over the
summaries, and joined back on (key, chunk), by which the rows are already
partitioned. A summary has as many rows as there are chunks, never more than rows.

Orders that have no such bucket (text, expressions such as ``desc()``) are range
partitioned instead; then the partition id stands for the chunk, and a reliable
``checkpoint()`` keeps both branches on the same layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..session import cut_lineage, shuffle_partitions

_PID = "__pid"
_RN = "__rn"
_CNT = "__cnt"
#: Numbers of an order column that make a chunk.
STEP = 1024


def chunk_of(df: DataFrame, order_col: str) -> Column | None:
    """The bucket of the order value that a chunk spans; it never falls as the value grows. None for other types."""
    dtype, c = df.schema[order_col].dataType, F.col(order_col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("hour", c)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return F.floor(c / F.lit(STEP)) if isinstance(dtype, T.DecimalType) else c.cast("bigint") - F.pmod(c.cast("bigint"), F.lit(STEP))
    return None


def _chunked(df: DataFrame, keys: Sequence[str], chunk: Column) -> DataFrame:
    """Adds ``__k`` (key), ``__c`` (chunk) and ``__kc`` (both). Structs meet NULL-safely and keep their partitioning."""
    k = F.struct(*[F.col(c) for c in keys], F.lit(0).alias("__0"))
    return df.select("*", k.alias("__k"), chunk.alias("__c"), F.struct(*[F.col(c) for c in keys], chunk.alias("__c")).alias("__kc"))


_BEFORE = (Window.unboundedPreceding, -1)


def rolling_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, k: int, out: str,
                   chunk: Column | None = None) -> DataFrame:
    """Adds ``out``: the ``value`` of up to ``k`` rows before each row of its key, in order, NULL values included.

    The last ``k`` rows of each chunk travel in its summary; each of the ``k`` chunks before holds a row at least, so
    their tails are enough. ``order`` must be a total order within a key, of columns, all ascending.
    """
    chunk = chunk_of(df, order[0]) if chunk is None else chunk
    base = _chunked(df, keys, F.lit(0) if chunk is None else chunk).withColumn("__v", F.struct(value.alias("v")))
    up = Window.partitionBy("__kc").orderBy(*order)
    down = Window.partitionBy("__kc").orderBy(*[F.col(c).desc() for c in order])
    own = base.withColumn("__own", F.collect_list("__v").over(up.rowsBetween(-k, -1)))
    # a limit on the rank, which Spark applies within every task before the shuffle
    tail = (base.select("__k", "__c", "__kc", "__v", *order).withColumn(_RN, F.row_number().over(down)).where(F.col(_RN) <= k)
            .groupBy("__kc", "__k", "__c").agg(F.sort_array(F.collect_list(F.struct((-F.col(_RN)).alias("at"), "__v"))).alias("__last")))
    along = Window.partitionBy("__k").orderBy("__c").rowsBetween(-k, -1)
    carried = tail.select("__kc", F.flatten(F.collect_list(F.transform("__last", lambda x: x["__v"])).over(along)).alias("__before"))
    frame = F.concat("__before", "__own")
    met = own.join(carried, "__kc").withColumn("__f", frame)
    last = F.slice("__f", F.greatest(F.size("__f") - k + 1, F.lit(1)), k)
    return met.select(*[F.col(c) for c in df.columns], F.transform(last, lambda x: x["v"]).alias(out))


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
                  chunk: Column | None = None) -> DataFrame:
    """Adds ``out``: the last ``value`` that is not NULL up to and including the row, in its key's order.

    ``order`` must be a total order within a key, as far as rows with a value go, of columns, all ascending.
    """
    chunk = chunk_of(df, order[0]) if chunk is None else chunk
    base = _chunked(df, keys, F.lit(0) if chunk is None else chunk).withColumn("__v", value)
    w = Window.partitionBy("__kc").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = base.withColumn("__own", F.last("__v", ignorenulls=True).over(w))
    at = F.when(F.col("__v").isNotNull(), F.struct(*order))
    summary = base.groupBy("__kc", "__k", "__c").agg(F.max_by("__v", at).alias("__last"))
    along = Window.partitionBy("__k").orderBy("__c").rowsBetween(*_BEFORE)
    carried = summary.select("__kc", F.last("__last", ignorenulls=True).over(along).alias("__before"))
    return own.join(carried, "__kc").select(*[F.col(c) for c in df.columns], F.coalesce("__own", "__before").alias(out))


def _by_chunk(df: DataFrame, keys: list[str], order: list[str], chunk: Column, lag_cols, lead_cols, running, index_col) -> DataFrame:
    base = _chunked(df, keys, chunk)
    w = Window.partitionBy("__kc").orderBy(*order)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.select(*df.columns, "__kc", F.row_number().over(w).alias(_RN), *[F.lag(c).over(w).alias(f"__lag_{c}") for c in lag_cols],
                        *[F.lead(c).over(w).alias(f"__lead_{c}") for c in lead_cols],
                        *[F.sum(c).over(w_run).alias(f"__run_{c}") for c in running])
    at = F.struct(*order)
    nothing = F.lit(None).alias("__none")
    summary = base.groupBy("__kc", "__k", "__c").agg(
        F.count(F.lit(1)).alias(_CNT), F.max_by(F.struct(nothing, *lag_cols), at).alias("last"),
        F.min_by(F.struct(nothing, *lead_cols), at).alias("first"), *[F.sum(c).alias(f"tot_{c}") for c in running])
    along = Window.partitionBy("__k").orderBy("__c")
    before = along.rowsBetween(*_BEFORE)
    carried = summary.select("__kc", _CNT, F.lag("last").over(along).alias("__prev"), F.lead("first").over(along).alias("__next"),
                             F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias("__rows"),
                             *[F.sum(f"tot_{c}").over(before).alias(f"__in_{c}") for c in running])
    out = [F.col(c) for c in df.columns]
    out += [F.when(F.col(_RN) == 1, F.col(f"__prev.{c}")).otherwise(F.col(f"__lag_{c}")).alias(f"prev_{c}") for c in lag_cols]
    out += [F.when(F.col(_RN) == F.col(_CNT), F.col(f"__next.{c}")).otherwise(F.col(f"__lead_{c}")).alias(f"next_{c}") for c in lead_cols]
    for c in running:  # a sum over NULLs alone is NULL
        run, came = F.col(f"__run_{c}"), F.col(f"__in_{c}")
        out.append(F.when(run.isNull(), came).when(came.isNull(), run).otherwise(run + came).alias(f"cum_{c}"))
    if index_col:
        out.append((F.col(_RN) + F.col("__rows")).cast("bigint").alias(index_col))
    return local.join(carried, "__kc").select(*out)


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence, *,
                 lag_cols: Sequence[str] = (), lead_cols: Sequence[str] = (),
                 running: Sequence[str] = (), index_col: str | None = None,
                 num_partitions: int | None = None, chunk: Column | None = None) -> DataFrame:
    """Add per-key ordered values to ``df``.

    * ``lag_cols``  -> ``prev_<c>``: value of ``c`` on the previous row of the key
    * ``lead_cols`` -> ``next_<c>``: value of ``c`` on the next row of the key
    * ``running``   -> ``cum_<c>``: running sum of ``c`` up to and including the row
    * ``index_col`` -> 1-based position of the row within its key

    ``order`` must be a total order within a key (add tie-breakers), as with
    any window function whose result should be deterministic. ``chunk`` replaces the bucket of the first
    order column (see :func:`chunk_of`); it must not fall along the order.
    """
    keys = list(keys)
    if all(isinstance(o, str) for o in order):
        chunk = chunk_of(df, order[0]) if chunk is None else chunk
        if chunk is not None:
            return _by_chunk(df, keys, list(order), chunk, lag_cols, lead_cols, running, index_col)
    order_c = _order_cols(order)
    n = num_partitions or shuffle_partitions(df.sparkSession)
    base_cols = df.columns

    ranged = (df.repartitionByRange(n, *[F.col(k) for k in keys], *order_c)
                .withColumn(_PID, F.spark_partition_id()))
    chunk = Window.partitionBy(_PID, *keys)
    w = chunk.orderBy(*order_c)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    sel = [F.col(c) for c in base_cols] + [F.col(_PID)]
    sel.append(F.row_number().over(w).alias(_RN))
    sel.append(F.count(F.lit(1)).over(chunk).alias(_CNT))
    sel += [F.lag(c).over(w).alias(f"__lag_{c}") for c in lag_cols]
    sel += [F.lead(c).over(w).alias(f"__lead_{c}") for c in lead_cols]
    sel += [F.sum(c).over(w_run).alias(f"__run_{c}") for c in running]
    sel += [F.sum(c).over(chunk).alias(f"__tot_{c}") for c in running]
    local = cut_lineage(ranged.select(*sel))

    key_struct = F.struct(*[F.col(k) for k in keys])
    first_fields = [key_struct.alias("k")] + [F.col(c).alias(c) for c in lead_cols]
    last_fields = ([key_struct.alias("k"), F.col(_CNT).alias("cnt")]
                   + [F.col(c).alias(c) for c in lag_cols]
                   + [F.col(f"__tot_{c}").alias(f"tot_{c}") for c in running])
    bnd = (local.where((F.col(_RN) == 1) | (F.col(_RN) == F.col(_CNT)))
           .groupBy(_PID)
           .agg(F.min(F.when(F.col(_RN) == 1, F.struct(*first_fields))).alias("first"),
                F.max(F.when(F.col(_RN) == F.col(_CNT), F.struct(*last_fields))).alias("last")))
    # The boundary table has at most one row per partition.
    by_pid = Window.orderBy(_PID)
    by_key = Window.partitionBy(F.col("last.k")).orderBy(_PID).rowsBetween(Window.unboundedPreceding,
                                                                           Window.currentRow)
    carry = [F.sum(F.col("last.cnt")).over(by_key).alias("cum_cnt")]
    carry += [F.sum(F.col(f"last.tot_{c}")).over(by_key).alias(f"cum_{c}") for c in running]
    bnd = bnd.select("*", *carry)
    bnd = bnd.select(
        F.col(_PID),
        F.col("first.k").alias("__first_k"),
        F.lag("last").over(by_pid).alias("__prev_last"),
        F.lead("first").over(by_pid).alias("__next_first"),
        F.lag("cum_cnt").over(by_pid).alias("__prev_cum_cnt"),
        *[F.lag(f"cum_{c}").over(by_pid).alias(f"__prev_cum_{c}") for c in running],
    )

    j = local.join(F.broadcast(bnd), _PID, "left")
    row_k = key_struct
    continues = (F.col("__prev_last.k").eqNullSafe(row_k)) & F.col("__first_k").eqNullSafe(row_k)
    ends_early = F.col("__next_first.k").eqNullSafe(row_k)

    out = [F.col(c) for c in base_cols]
    for c in lag_cols:
        out.append(F.when((F.col(_RN) == 1) & continues, F.col(f"__prev_last.{c}"))
                   .otherwise(F.col(f"__lag_{c}")).alias(f"prev_{c}"))
    for c in lead_cols:
        out.append(F.when((F.col(_RN) == F.col(_CNT)) & ends_early, F.col(f"__next_first.{c}"))
                   .otherwise(F.col(f"__lead_{c}")).alias(f"next_{c}"))
    for c in running:
        # a sum over NULLs alone is NULL, as in a plain window, whichever side of the cut they lie on
        run, carry_in = F.col(f"__run_{c}"), F.when(continues, F.col(f"__prev_cum_{c}"))
        out.append(F.when(run.isNull(), carry_in).when(carry_in.isNull(), run).otherwise(run + carry_in).alias(f"cum_{c}"))
    if index_col:
        out.append((F.col(_RN) + F.when(continues, F.col("__prev_cum_cnt")).otherwise(F.lit(0)))
                   .cast("bigint").alias(index_col))
    return j.select(*out)
