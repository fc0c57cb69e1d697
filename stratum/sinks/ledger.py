"""Run ledger writer (G1-G5, G7): append-only event rows keyed by run_id.

Every call appends one small DataFrame; nothing is updated in place (the
folded one-row-per-run view is :func:`stratum.operators.ops.fold_runs`). DQ
results are appended straight from the results DataFrame, never collected. A
failed ledger write must not fail the data run: the row goes to a fallback
JSON folder (a shared path) and :meth:`RunLedger.reload_fallback` merges it back.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import TableStore, _fs

EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("trace_id", T.StringType()),
    T.StructField("component", T.StringType()), T.StructField("entity", T.StringType()),
    T.StructField("run_type", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])
END_STATUSES = ("SUCCESS", "FAILED", "TIMEOUT")
# Fixed whitelist of audit metric names.
AUDIT_METRICS = ("rows_read", "rows_written", "rows_rejected", "rows_quarantined", "rows_inserted",
                 "rows_updated", "bytes_read", "bytes_written", "duration_s", "duration_seconds", "identity", "spark_job_id")


@dataclass
class RunHandle:
    run_id: str
    trace_id: str
    component: str
    entity: str
    started: dt.datetime


class RunLedger:
    def __init__(self, spark: SparkSession, store: TableStore, table: str = "ledger_events",
                 fallback_dir: str | None = None, clock=None):
        self.spark, self.store, self.table = spark, store, table
        self.fallback_dir = fallback_dir
        self.clock = clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.degraded = False

    # -------------------------------------------------------------- core
    def _append(self, rows: list[dict]) -> None:
        try:
            df = self.spark.createDataFrame([tuple(r.get(f.name) for f in EVENT_SCHEMA.fields) for r in rows],
                                            EVENT_SCHEMA)
            self.store.append(self.table, df)
        except Exception:  # noqa: BLE001 - the ledger never fails the data run
            self.degraded = True
            self._fallback(rows)

    def _fallback(self, rows: list[dict]) -> None:
        """Rows as JSON lines in a file of their own, on whatever file system the folder names."""
        if not self.fallback_dir:
            return
        fs, p = _fs(self.spark, f"{self.fallback_dir}/ledger-{uuid.uuid4().hex}.json")
        fs.setWriteChecksum(False)
        out = fs.create(p, False)
        try:
            out.write(bytearray("".join(json.dumps(r, default=str) + "\n" for r in rows).encode()))
        finally:
            out.close()

    def reload_fallback(self) -> int:
        """Merge fallback rows back into the ledger (G7); returns rows merged."""
        if not self.fallback_dir:
            return 0
        fs, folder = _fs(self.spark, self.fallback_dir)
        if not fs.exists(folder):
            return 0
        files = [st.getPath() for st in fs.listStatus(folder) if st.getPath().getName().endswith(".json")]
        if not files:
            return 0
        text_ts = T.StructType([T.StructField(f.name, T.StringType() if f.name == "event_ts" else f.dataType)
                                for f in EVENT_SCHEMA.fields])
        df = self.spark.read.schema(text_ts).json([f.toString() for f in files])
        res = self.store.append(self.table, df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")))
        for f in files:
            fs.rename(f, f.suffix(".loaded"))
        return res.num_output_rows

    def _event(self, h: RunHandle, event_type: str, status: str | None, metrics=None, attributes=None) -> dict:
        return {"run_id": h.run_id, "trace_id": h.trace_id, "component": h.component, "entity": h.entity,
                "run_type": None, "event_type": event_type, "status": status, "event_ts": self.clock(),
                "metrics": {k: float(v) for k, v in (metrics or {}).items() if v is not None},
                "attributes": {k: str(v) for k, v in (attributes or {}).items()}}

    # -------------------------------------------------------------- API
    def start_run(self, component: str, entity: str, run_type: str = "BATCH",
                  trace_id: str | None = None) -> RunHandle:
        """G1: new run id, RUNNING event; a trace id is propagated or created."""
        h = RunHandle(uuid.uuid4().hex, trace_id or uuid.uuid4().hex, component, entity, self.clock())
        ev = self._event(h, "START", "RUNNING")
        ev["run_type"] = run_type
        self._append([ev])
        return h

    def end_run(self, h: RunHandle, status: str, metrics: dict | None = None, attributes: dict | None = None) -> None:
        """Terminal status with duration and metrics."""
        if status not in END_STATUSES:
            raise ValueError(f"status must be one of {END_STATUSES}")
        m = dict(metrics or {})
        m["duration_s"] = (self.clock() - h.started).total_seconds()
        self._append([self._event(h, "END", status, m, {"ledger_degraded": self.degraded, **(attributes or {})})])

    def log_audit(self, h: RunHandle, metrics: dict) -> None:
        """Whitelisted audit metrics (unknown names are refused)."""
        bad = set(metrics) - set(AUDIT_METRICS)
        if bad:
            raise ValueError(f"unknown audit metrics: {sorted(bad)}")
        self._append([self._event(h, "AUDIT", None, metrics)])

    def log_balance(self, h: RunHandle, checks: DataFrame) -> None:
        """Balance results (A4) appended from a recon DataFrame, not collected."""
        self._append_frame(h, checks, "BALANCE")

    def log_dq(self, h: RunHandle, results: DataFrame) -> None:
        """One event per DQ result row, appended as a DataFrame."""
        self._append_frame(h, results, "DQ")

    def _append_frame(self, h: RunHandle, df: DataFrame, event_type: str) -> None:
        num = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
        txt = [f.name for f in df.schema.fields if f.name not in num]
        metrics = F.map_from_arrays(F.array(*[F.lit(c) for c in num]),
                                    F.array(*[F.col(c).cast("double") for c in num]))
        attrs = F.map_from_arrays(F.array(*[F.lit(c) for c in txt]),
                                  F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in txt]))
        ev = df.select(F.lit(h.run_id).alias("run_id"), F.lit(h.trace_id).alias("trace_id"),
                       F.lit(h.component).alias("component"), F.lit(h.entity).alias("entity"),
                       F.lit(None).cast("string").alias("run_type"), F.lit(event_type).alias("event_type"),
                       F.lit(None).cast("string").alias("status"),
                       F.lit(self.clock().isoformat(sep=" ")).cast("timestamp_ntz").alias("event_ts"),
                       metrics.cast("map<string,double>").alias("metrics"), attrs.cast("map<string,string>").alias("attributes"))
        try:
            self.store.append(self.table, ev)
        except Exception:  # noqa: BLE001 - the ledger never fails the data run
            self.degraded = True
            # result frames have a row per rule or check, so they fit the driver
            self._fallback([r.asDict(recursive=True) for r in ev.collect()])

    def log_decision(self, h: RunHandle, record: dict) -> None:
        """A schema decision, pending before the load and with its outcome after it."""
        self._append([self._event(h, "SCHEMA_DECISION", None, None, record)])

    def log_exception(self, h: RunHandle, error: BaseException, stage: str = "") -> None:
        """Exception type, message and stage."""
        self._append([self._event(h, "EXCEPTION", None, None,
                                  {"type": type(error).__name__, "message": str(error), "stage": stage})])

    def log_progress(self, h: RunHandle, row: dict) -> None:
        """ST13: one micro-batch of a stream."""
        nums = {k: v for k, v in row.items() if isinstance(v, (int, float))}
        self._append([self._event(h, "PROGRESS", None, nums, {k: v for k, v in row.items() if k not in nums})])

    def log_cost(self, h: RunHandle, consumption: dict) -> None:
        """Cost record (dbu_seconds, dbu_count, cost_usd, cluster id ...)."""
        nums = {k: v for k, v in consumption.items() if isinstance(v, (int, float))}
        txt = {k: v for k, v in consumption.items() if k not in nums}
        self._append([self._event(h, "COST", None, nums, txt)])

    def compact(self) -> int:
        """All events in few files, in place of one file an event; returns the number of events."""
        return self.store.compact(self.table).num_output_rows

    def events(self) -> DataFrame | None:
        return self.store.read(self.table)
