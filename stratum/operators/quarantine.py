"""Quarantine: split bad rows off a batch and stamp them.

Every splitter returns ``(clean, bad)`` as two filters of one input, so a
caller that consumes both should ``persist`` the input once (or read it from
a checkpoint). Quarantine rows carry the payload plus six metadata columns;
the id is a hash of (run_id, reason, payload), so a retried run produces the
same ids instead of duplicates.
"""

from __future__ import annotations

import enum
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import stable_id

META_COLUMNS = ["quarantine_id", "run_id", "reason_category", "reason_detail",
                "quarantine_timestamp", "quarantine_date"]


class QuarantineReason(str, enum.Enum):
    SCHEMA_DRIFT = "SCHEMA_DRIFT"
    CORRUPT_RECORD = "CORRUPT_RECORD"
    CAST_FAILURE = "CAST_FAILURE"
    MISSING_KEY = "MISSING_KEY"
    DUP_KEY = "DUP_KEY"
    WRITE_FAILURE = "WRITE_FAILURE"
    READ_FAILURE = "READ_FAILURE"
    DQ_FAILURE = "DQ_FAILURE"
    LATE_DATA = "LATE_DATA"


def quarantine_table_name(catalog: str, schema: str, table: str) -> str:
    return f"{catalog}.{schema}.{table}_quarantine"


def stamp(df: DataFrame, reason: QuarantineReason | str, run_id: str, detail: str = "",
          ts=None) -> DataFrame:
    """Add the six quarantine metadata columns.

    ``ts`` is the batch instant (one literal for the whole batch, never a
    per-row clock); the date column is stored, so it can partition the table.
    """
    reason = QuarantineReason(reason).value
    t = F.lit(str(ts)).cast("timestamp_ntz") if ts is not None else F.localtimestamp()
    payload = [F.col(c) for c in df.columns]
    return df.select(
        *payload,
        stable_id("q_", [F.lit(run_id), F.lit(reason), *payload]).alias("quarantine_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(reason).alias("reason_category"),
        F.lit(detail or "").alias("reason_detail"),
        t.alias("quarantine_timestamp"),
        F.to_date(t).alias("quarantine_date"))


def unstamp(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in META_COLUMNS if c in df.columns])


def split_missing_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(clean, bad): bad rows have a NULL in any key column."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return df.where(~any_null), df.where(any_null)


def split_corrupt(df: DataFrame, column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(clean, bad) of a PERMISSIVE read (P5); clean drops the corrupt column.

    Spark refuses a raw-file query that touches only the corrupt column, so both
    sides keep the other columns in play. A caller that consumes both sides may
    ``persist`` the read, and release it.
    """
    if column not in df.columns:
        return df, df.limit(0)
    others = [c for c in df.columns if c != column]
    # always true, but the optimizer can't tell, so the other columns stay in the scan
    parsed = F.xxhash64(*others) >= F.lit(-(1 << 63)) if others else F.lit(True)
    return df.where(F.col(column).isNull() & parsed).drop(column), df.where(F.col(column).isNotNull() & parsed)


def safe_cast(df: DataFrame, types: Mapping[str, str | T.DataType]) -> tuple[DataFrame, DataFrame]:
    """Cast columns without failing the job.

    ``clean`` has the cast columns; ``bad`` keeps the original values of rows
    where a non-NULL source value did not cast, plus ``_cast_failed_columns``.
    """
    casted = {c: F.expr(f"try_cast(`{c}` AS {t if isinstance(t, str) else t.simpleString()})") for c, t in types.items()}
    failed = [F.when(F.col(c).isNotNull() & casted[c].isNull(), F.lit(c)) for c in types]
    tagged = df.withColumn("_cast_failed_columns", F.filter(F.array(*failed), lambda x: x.isNotNull()))
    ok = F.size("_cast_failed_columns") == 0
    clean = tagged.where(ok).select(*[casted[c].alias(c) if c in casted else F.col(c) for c in df.columns])
    bad = tagged.where(~ok)
    return clean, bad


def capture_drift(df: DataFrame, expected_columns: Sequence[str], only_populated: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split schema drift (P8, E7) into ``(clean, quarantine)``.

    ``clean`` has every row with the expected columns alone. ``quarantine`` has the rows once more, with all
    unexpected columns as one JSON object in ``_rescued_data`` (NULLs included, so all rows have the same keys);
    with ``only_populated``, only the rows where one of them has a value. However many columns arrive, none is left out.
    """
    wanted = set(expected_columns)
    known, strange = [c for c in df.columns if c in wanted], [c for c in df.columns if c not in wanted]
    clean = df.select(*known)
    if not strange:
        return clean, clean.where(F.lit(False)).withColumn("_rescued_data", F.lit(None).cast("string"))
    drifted = df.where(_any_not_null(strange)) if only_populated else df
    as_json = F.to_json(F.struct(*strange), {"ignoreNullFields": "false"})
    return clean, drifted.select(*known, as_json.alias("_rescued_data"))


def _any_not_null(cols):
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNotNull()
    return cond


def replay(quarantine: DataFrame, reason: QuarantineReason | str | None = None, run_id: str | None = None,
           rescued_schema: T.StructType | str | None = None) -> DataFrame:
    """Rows to send back through the pipeline.

    Filters by reason / run, strips metadata, and expands ``_rescued_data``
    with ``rescued_schema`` when given.
    """
    q = quarantine
    if reason is not None:
        q = q.where(F.col("reason_category") == QuarantineReason(reason).value)
    if run_id is not None:
        q = q.where(F.col("run_id") == run_id)
    q = unstamp(q)
    if rescued_schema is not None and "_rescued_data" in q.columns:
        parsed = F.from_json(F.col("_rescued_data"), rescued_schema)
        fields = rescued_schema.fieldNames() if isinstance(rescued_schema, T.StructType) else \
            T._parse_datatype_string(rescued_schema).fieldNames()
        q = q.select("*", parsed.alias("__r")).select(
            *[c for c in q.columns if c != "_rescued_data"],
            *[F.col(f"__r.{f}").alias(f) for f in fields])
    return q


def late_rows(df: DataFrame, ts_col: str, high_water) -> tuple[DataFrame, DataFrame]:
    """(on_time, late) against a stored high-water mark (ST11)."""
    hw = F.lit(str(high_water)).cast("timestamp_ntz")
    late = F.col(ts_col).cast("timestamp_ntz") < hw
    return df.where(~late), df.where(late)
