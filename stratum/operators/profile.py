"""Profiling (A14-A17): one aggregate for all column statistics, exact top values
of all columns in one counting pass, key and watermark candidates, and rule suggestions.

Statistics come from one ``agg`` over the table (each aggregate is partial,
map-side); distinct counts are HyperLogLog estimates (``distinct_approx``)
and the median is ``percentile_approx``. Exact work is spent only where a
decision needs it: a key candidate is screened by the estimate and then
confirmed by an exact duplicate check.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_text(c: Column, dtype: T.DataType) -> Column:
    """Min / max rendered as text that any engine prints the same way."""
    if isinstance(dtype, _NUMERIC):
        return c.try_cast("decimal(38,6)").cast("string")
    return c.cast("string")


#: Hashed values that the frequent-item sketch of a column tracks, and how many of them are counted exactly at least.
TRACKED, KEPT = 8192, 64
#: A value in more than this share of the rows is among the sketch's items, and no estimate is further off: the sketch has
#: 16,384 places, an error of 3.5 rows a place, and leaves out what may lie within twice the error.
SKETCH_ERROR = 1 / 1024


def _sketch(value: Column, k: int) -> Column:
    """The most frequent hashes of a text with their estimates; a mergeable sketch whose size no long text changes."""
    return F.call_function("approx_top_k", F.when(value.isNotNull(), F.xxhash64(value)), F.lit(max(KEPT, 4 * k)), F.lit(TRACKED))


def _surely_top(items: Sequence, n: int, k: int) -> list[int] | None:
    """The hashes among which the k most frequent values surely are, or None where the estimates can't tell.

    They can if the k-th value, at its least, is ahead of every value left out, at its most; or if the items add up to all
    rows, which takes a sketch that never had to drop any.
    """
    off, most = n * SKETCH_ERROR, max(KEPT, 4 * k)
    counts = sorted((r["count"] for r in items if r["item"] is not None), reverse=True)
    left_out = max(off, min(r["count"] for r in items)) if len(items) >= most else off
    complete = len(items) < most and sum(r["count"] for r in items) == n
    if complete or (len(counts) >= k and counts[k - 1] - off > left_out):
        return [r["item"] for r in items if r["item"] is not None]
    return None


def _count_top(df: DataFrame, columns: Sequence[str], kept: Sequence[list[int] | None], k: int) -> DataFrame:
    """Exact top-k values of all columns in one pass: of a column with kept hashes only those (and NULL) are counted."""
    pairs = []
    for c, hashes in zip(columns, kept):
        value = F.col(c).cast("string")
        pair = F.struct(F.lit(c).alias("column_name"), value.alias("value"))
        pairs.append(pair if hashes is None else F.when(value.isNull() | F.xxhash64(value).isin(hashes), pair))
    each = df.select(F.explode(F.filter(F.array(*pairs), lambda p: p.isNotNull())).alias("p")).select("p.*")
    counts = each.groupBy("column_name", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    # the limit on the rank holds in every task before the shuffle, so a column's last task sees k rows a task
    w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= k)


def profile(df: DataFrame, columns: Sequence[str] | None = None, approx_rsd: float = 0.05, top: int = 0) -> DataFrame:
    """One row per column: column, type, row_count, null_count, distinct_approx,
    min, max, mean, stddev, p50 (numeric only for the last three).

    With ``top`` also ``top_values``: the exact ``top`` most frequent values with their counts, as in :func:`top_values`.
    The sketches ride on the aggregate of the statistics, which then runs at once, so the table is read twice in all.
    """
    fields = [f for f in df.schema.fields if not columns or f.name in columns]
    fields = [f for f in fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        aggs += [F.count(c).alias(f"nn{i}"), F.approx_count_distinct(c, approx_rsd).alias(f"d{i}"),
                 F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
        if isinstance(f.dataType, _NUMERIC):
            aggs += [F.avg(c.cast("double")).alias(f"av{i}"), F.stddev_samp(c.cast("double")).alias(f"sd{i}"),
                     F.percentile_approx(c.cast("double"), 0.5, 10000).alias(f"p{i}")]
        if top:
            aggs.append(_sketch(c.cast("string"), top).alias(f"t{i}"))
    one = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        num = isinstance(f.dataType, _NUMERIC)
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col("__n").cast("bigint").alias("row_count"),
            (F.col("__n") - F.col(f"nn{i}")).cast("bigint").alias("null_count"),
            F.col(f"d{i}").cast("bigint").alias("distinct_approx"),
            _as_text(F.col(f"mn{i}"), f.dataType).alias("min"), _as_text(F.col(f"mx{i}"), f.dataType).alias("max"),
            (F.round(F.col(f"av{i}"), 4) if num else F.lit(None)).cast("decimal(38,4)").alias("mean"),
            (F.round(F.col(f"sd{i}"), 4) if num else F.lit(None)).cast("decimal(38,4)").alias("stddev"),
            (F.col(f"p{i}") if num else F.lit(None)).cast("double").alias("p50"),
            *([F.col(f"t{i}").alias("__top")] if top else [])))
    prof = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if not top or not fields:
        return prof
    found = prof.collect()  # a row per column
    kept = [_surely_top(r["__top"], r["row_count"], top) for r in found]
    counts = _count_top(df, [r["column_name"] for r in found], kept, top)
    tops = counts.groupBy("column_name").agg(F.array_sort(F.collect_list(F.struct("__rank", "value", "count"))).alias("t"))
    tops = tops.select("column_name", F.transform("t", lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count"))).alias("top_values"))
    stats = df.sparkSession.createDataFrame([r[:-1] for r in found], prof.drop("__top").schema)
    return (stats.join(tops, "column_name", "left")
            .withColumn("top_values", F.coalesce("top_values", F.array().cast("array<struct<value:string,count:bigint>>"))))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """Top-k values per column by count, ties by value, NULL a value as well (O3): column_name, value, count, all exact.

    Two passes for all columns together. The first takes a frequent-item sketch of each column. Where its bounds prove
    which values come first, the second counts only those; a column without such values (keys, even spreads) is counted whole.
    """
    columns = list(columns)
    one = df.agg(F.count(F.lit(1)).alias("n"), *[_sketch(F.col(c).cast("string"), k).alias(f"t{i}") for i, c in enumerate(columns)]).first()
    kept = [_surely_top(one[f"t{i}"], one["n"], k) for i in range(len(columns))]
    return _count_top(df, columns, kept, k).drop("__rank")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_distinct): exact numbers of non-NULL values, all columns in one scan (a partial aggregate first)."""
    columns = list(dict.fromkeys(columns))
    one = df.agg(*[F.count_distinct(F.col(c)).cast("bigint").alias(f"d{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("n_distinct")) for i, c in enumerate(columns)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Global top-k rows (TakeOrderedAndProject: each task keeps k rows)."""
    return df.orderBy(*order).limit(k)


#: A column whose estimated distinct values are fewer than this share of the rows is no key: ten standard errors of the
#: estimate below, so the screen drops no true key. What it keeps is confirmed exactly.
KEY_SCREEN = 0.5


def candidate_keys(df: DataFrame, combos: Sequence[Sequence[str]] | None = None,
                   screen_ratio: float = KEY_SCREEN) -> DataFrame:
    """Column sets that are unique and NULL-free.

    A one-row aggregate screens every single column (HyperLogLog estimate,
    5 % relative error, >= screen_ratio x rows, and no NULL); each candidate is then confirmed exactly with a
    duplicate check (partial aggregate). Output: column_set, row_count,
    distinct_count (exact), is_key, for confirmed keys only.
    """
    combos = [list(c) for c in (combos or [[f.name] for f in df.schema.fields
                                            if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))])]
    singles = sorted({c for combo in combos for c in combo})
    one = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.approx_count_distinct(c).alias(f"d_{c}") for c in singles],
                 *[F.count(c).alias(f"nn_{c}") for c in singles]).collect()[0]  # one small metrics row
    n = one["n"]
    parts = []
    for combo in combos:
        est = min(one[f"d_{c}"] for c in combo) if len(combo) == 1 else n
        nulls = any(one[f"nn_{c}"] != n for c in combo)
        if nulls or (len(combo) == 1 and est < screen_ratio * n):
            continue
        dist = df.groupBy(*combo).agg(F.count(F.lit(1)).alias("__c"))
        part = dist.agg(F.count(F.lit(1)).cast("bigint").alias("distinct_count"),
                        F.max("__c").alias("__mx")).select(
            F.lit(",".join(combo)).alias("column_set"), F.lit(n).cast("bigint").alias("row_count"),
            "distinct_count", (F.coalesce(F.col("__mx"), F.lit(1)) == 1).alias("is_key"))
        parts.append(part.where("is_key"))
    if not parts:
        return df.sparkSession.createDataFrame([], "column_set string, row_count bigint, distinct_count bigint, "
                                                   "is_key boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, max_size: int = 2,
                 screen_ratio: float = KEY_SCREEN) -> DataFrame:
    """Smallest column sets of up to ``max_size`` columns that are unique and NULL-free (A15): column_set, row_count.

    Sets are searched by size. Supersets of a key are never counted, nor are sets whose distinct values multiplied, by
    their estimates, can't reach the number of rows. What is left of one size is estimated in one scan (a
    mergeable sketch a set); only sets that come near the rows are counted exactly.
    """
    columns = list(columns or [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))])
    schema = "column_set string, row_count bigint"
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)],
                 *[F.count(c).alias(f"v{i}") for i, c in enumerate(columns)]).first()  # one row of metrics
    n = one["n"]
    near = {(c,): one[f"d{i}"] for i, c in enumerate(columns) if one[f"v{i}"] == n}  # estimates of NULL-free sets
    usable = [c for c in columns if (c,) in near]
    keys: list[tuple[str, ...]] = []
    for size in range(1, max_size + 1):
        sets = [x for x in combinations(usable, size) if not any(set(k) <= set(x) for k in keys)]
        if size > 1:
            # twice the product of the estimates, whose error is 5 % each
            sets = [x for x in sets if 2 * math.prod(near[(c,)] for c in x) >= n]
            if sets:
                est = df.agg(*[F.approx_count_distinct(F.struct(*x)).alias(f"d{i}") for i, x in enumerate(sets)]).first()
                near |= {x: est[f"d{i}"] for i, x in enumerate(sets)}
        close = [x for x in sets if near[x] >= screen_ratio * n]
        if close:
            twice = [df.groupBy(*x).agg(F.count(F.lit(1)).alias("__rows")).agg(F.coalesce(F.max("__rows"), F.lit(1)).alias("most"))
                     .select(F.lit(i).alias("i"), "most") for i, x in enumerate(close)]
            found = reduce(DataFrame.unionAll, twice).where("most = 1").collect()  # a row per set
            keys += [close[r["i"]] for r in found]
    rows = [(",".join(k), n) for k in sorted(keys, key=lambda k: (len(k), [columns.index(c) for c in k]))]
    return df.sparkSession.createDataFrame(rows, schema)


#: Rows of a chunk of the load order, and chunks taken together at each further level.
FAN = 1024


def _descents(df: DataFrame, fields: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row with ``x0``, ``x1``, ...: how often each field falls below the last value before it in the order.

    A chunk of the order is summed up as (first, last, descents), which merge in order: chunks by 1,024, those again by
    1,024, until one is left, so no task sees more than a chunk, whatever the number of rows.
    """
    dtype, c = df.schema[order[0]].dataType, F.col(order[0])
    if isinstance(dtype, T.DateType):
        place, width = F.unix_date(c), 1
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        place, width = F.unix_micros(c.cast("timestamp")), 60_000_000
    elif isinstance(dtype, T.IntegralType):
        place, width = c.cast("bigint"), FAN
    else:
        raise ValueError(f"no load order by {dtype.simpleString()}")
    placed = df.where(c.isNotNull()).withColumn("__p", place)
    ends = placed.agg(F.min("__p").alias("low"), F.max("__p").alias("high")).first()  # one row
    low, high = ends["low"] or 0, ends["high"] or 0

    w = Window.partitionBy("__c").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(*order)
    rows = placed.withColumn("__c", F.floor((F.col("__p") - F.lit(low)) / F.lit(width)).cast("bigint"))
    rows = rows.select("__c", *order, *[F.col(f).alias(f"v{i}") for i, f in enumerate(fields)],
                       *[F.last(f, ignorenulls=True).over(w).alias(f"b{i}") for i, f in enumerate(fields)])
    n = range(len(fields))

    def falls(value: Column, before: Column) -> Column:
        return F.coalesce(F.sum(F.when(value < before, 1).otherwise(0)), F.lit(0))

    out = rows.groupBy("__c").agg(
        *[F.min_by(f"v{i}", F.when(F.col(f"v{i}").isNotNull(), at)).alias(f"f{i}") for i in n],
        *[F.max_by(f"v{i}", F.when(F.col(f"v{i}").isNotNull(), at)).alias(f"l{i}") for i in n],
        *[falls(F.col(f"v{i}"), F.col(f"b{i}")).alias(f"x{i}") for i in n])
    span = (high - low) // width + 1
    while span > 1:
        w = Window.partitionBy("__g").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
        up = out.withColumn("__g", F.floor(F.col("__c") / F.lit(FAN)).cast("bigint"))
        up = up.select("*", *[F.last(f"l{i}", ignorenulls=True).over(w).alias(f"b{i}") for i in n])
        out = up.groupBy(F.col("__g").alias("__c")).agg(
            *[F.min_by(f"f{i}", F.when(F.col(f"f{i}").isNotNull(), F.col("__c"))).alias(f"f{i}") for i in n],
            *[F.max_by(f"l{i}", F.when(F.col(f"l{i}").isNotNull(), F.col("__c"))).alias(f"l{i}") for i in n],
            *[(F.sum(f"x{i}") + falls(F.col(f"f{i}"), F.col(f"b{i}"))).alias(f"x{i}") for i in n])
        span = (span - 1) // FAN + 1
    return out.agg(*[F.coalesce(F.sum(f"x{i}"), F.lit(0)).alias(f"x{i}") for i in n])


def candidate_watermarks(df: DataFrame, load_order: Sequence[str] | None = None) -> DataFrame:
    """Date / timestamp columns usable as an incremental watermark (A16):
    column_name, type, min, max, null_count, is_candidate (no NULLs).

    With ``load_order`` (columns that give the order of loading, the first an integer, date or timestamp without
    NULLs) also ``descents``: how often the column falls below its last value; a candidate never falls, as rows
    under a mark that was passed would be lost to an incremental read.
    """
    fields = [f for f in df.schema.fields if isinstance(f.dataType, _TIME)]
    if not fields:
        return df.sparkSession.createDataFrame([], "column_name string, type string, min string, max string, "
                                                   "null_count bigint, is_candidate boolean" + (", descents bigint" if load_order else ""))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        aggs += [F.min(f.name).alias(f"mn{i}"), F.max(f.name).alias(f"mx{i}"), F.count(f.name).alias(f"nn{i}")]
    one = df.agg(*aggs)
    if load_order:
        falls = _descents(df, [f.name for f in fields], list(load_order))
        one = one.select("*", *[falls.select(f"x{i}").scalar().alias(f"x{i}") for i in range(len(fields))])
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.col(f"mn{i}").cast("string").alias("min"), F.col(f"mx{i}").cast("string").alias("max"),
                     (F.col("__n") - F.col(f"nn{i}")).cast("bigint").alias("null_count"),
                     ((F.col("__n") == F.col(f"nn{i}")) & ((F.col(f"x{i}") == 0) if load_order else F.lit(True))).alias("is_candidate"),
                     *([F.col(f"x{i}").cast("bigint").alias("descents")] if load_order else [])) for i, f in enumerate(fields)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def accepted_values(df: DataFrame, prof: DataFrame, max_enum: int = 10) -> DataFrame:
    """(column_name, values) of the text columns with at most ``max_enum`` values: one aggregate over those columns.

    The profile's estimate picks the columns, so a set holds little more than ``max_enum`` values.
    """
    few = [r["column_name"] for r in prof.where((F.col("type") == "string") & F.col("distinct_approx").between(1, 2 * max_enum))
           .select("column_name").collect()]  # a row per column
    if not few:
        return df.sparkSession.createDataFrame([], "column_name string, values array<string>")
    one = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in few])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("values")) for c in few])
    return one.select(F.explode(rows).alias("r")).select("r.*").where(F.size("values") <= max_enum)


def suggest_rules(prof: DataFrame, keys: DataFrame | None = None, values: DataFrame | None = None) -> DataFrame:
    """Rule suggestions from a profile (A17): NOT_NULL for NULL-free columns, RANGE [min, max] for numeric
    columns, UNIQUE for confirmed keys, ACCEPTED_VALUES for columns with few values (:func:`accepted_values`).
    Output: column_name, rule_type, rule_expression."""
    def of(df: DataFrame, name: str, kind: str, expression) -> DataFrame:
        return df.select(F.col(name).alias("column_name"), F.lit(kind).alias("rule_type"), expression.cast("string").alias("rule_expression"))

    out = of(prof.where(F.col("null_count") == 0), "column_name", "NOT_NULL", F.lit(None)).unionByName(
        of(prof.where(F.col("mean").isNotNull()), "column_name", "RANGE", F.concat_ws(",", "min", "max")))
    if keys is not None:
        out = out.unionByName(of(keys, "column_set", "UNIQUE", F.lit(None)))
    if values is not None:
        out = out.unionByName(of(values, "column_name", "ACCEPTED_VALUES", F.array_join("values", ",")))
    return out
