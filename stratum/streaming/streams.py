"""Structured Streaming adapters (ST1-ST15).

The same DataFrame operators run on a stream: per-row splits and rules
directly on the streaming DataFrame, merges inside ``foreachBatch`` where each
micro-batch is a plain DataFrame. ``foreachBatch`` is at-least-once, so the
upsert sink records the ids of committed batches in the target store and skips
a replayed id.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators import history as H
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import quarantine as QR
from ..sources.readers import JSON_OPTIONS


# ---------------------------------------------------------------- sources (ST1, ST2, ST4, ST10)

def apply_schema_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    """Override inferred field types with DDL hints like ``amount DOUBLE, d DATE`` (ST4)."""
    if not hints:
        return schema
    h = {f.name: f.dataType for f in T._parse_datatype_string(hints).fields}
    fields = [T.StructField(f.name, h.get(f.name, f.dataType), True) for f in schema.fields]
    fields += [T.StructField(n, t, True) for n, t in h.items() if n not in schema.fieldNames()]
    return T.StructType(fields)


def file_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                max_files_per_trigger: int | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """Incremental file source (ST1): every file is read once (the source log in
    the checkpoint remembers seen paths, so late files are still picked up and a
    repeated path is skipped). The schema is fixed when the query starts."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.options(**(options or {})).load(path)


def kafka_stream(spark: SparkSession, bootstrap_servers: str, subscribe: str, starting_offsets: str = "earliest",
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """Kafka source (ST2); needs the Kafka connector on the classpath at run time."""
    if not subscribe:
        raise ValueError("subscribe is required")
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", subscribe).option("startingOffsets", starting_offsets)
            .options(**(options or {})).load())


KAFKA_SCHEMA = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
                             T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
                             T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType())])


def parse_kafka_json(records: DataFrame, schema: T.StructType, keep: Sequence[str] = ("topic", "offset")) -> DataFrame:
    """JSON payloads of Kafka records (ST3): ``value`` -> typed columns."""
    return records.select(F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS).alias("data"), *keep) \
                  .select("data.*", *keep)


def as_kafka_records(df: DataFrame, key_col: str, topic: str, offset_col: str, partition: int = 0) -> DataFrame:
    """Encode rows as Kafka records (key / value bytes), e.g. to feed a sink
    or to test a parser on batch data with the Kafka schema."""
    return df.select(F.col(key_col).cast("string").cast("binary").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).cast("binary").alias("value"),
                     F.lit(topic).alias("topic"), F.lit(partition).alias("partition"),
                     F.col(offset_col).cast("bigint").alias("offset"),
                     F.lit(None).cast("timestamp").alias("timestamp"))


# ---------------------------------------------------------------- event time (ST9, ST11, ST15)

def with_event_time(df: DataFrame, ts_col: str, delay: str) -> DataFrame:
    """Event-time watermark (ST9). ``withWatermark`` needs TIMESTAMP, so an
    NTZ column is cast first."""
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)


def arrivals(df: DataFrame, ts_col: str, window: str, dims: Sequence[str] = ()) -> DataFrame:
    """Rows per tumbling window and dims (ST15); works on a table and on a
    watermarked stream (then finished windows are emitted in append mode)."""
    w = F.window(F.col(ts_col), window)
    return df.groupBy(w.alias("w"), *dims).agg(F.count(F.lit(1)).cast("bigint").alias("n_events")) \
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *dims, "n_events")


def arrival_gaps(df: DataFrame, ts_col: str, window: str, dims: Sequence[str] = ()) -> DataFrame:
    """The tumbling windows in which nothing arrived, per dims, between their own first and last one (ST15).

    A calendar spine is made of each feed's first and last window and anti joined with what arrived; its length is bounded by
    the calendar, not by the rows. ``window`` is a fixed length such as ``1 hour``. NULL times are left out.
    """
    there = arrivals(df.where(F.col(ts_col).isNotNull()), ts_col, window, dims)
    spine = (there.groupBy(*dims).agg(F.min("window_start").alias("first"), F.max("window_start").alias("last"))
             .where(F.col("first").isNotNull())
             .select(*dims, F.explode(F.sequence("first", "last", F.expr(f"interval {window}"))).alias("window_start")))
    seen = there.select(F.col("window_start").alias("__at"), *[F.col(d).alias(f"__d{i}") for i, d in enumerate(dims)])
    same = [F.col("window_start") == F.col("__at"), *[F.col(d).eqNullSafe(F.col(f"__d{i}")) for i, d in enumerate(dims)]]
    return spine.join(seen, same, "left_anti").select(*dims, "window_start", (F.col("window_start") + F.expr(f"interval {window}")).alias("window_end"))


def flag_repeats(df: DataFrame, keys: Sequence[str], ts_col: str, delay: str, out: str = "is_repeat") -> DataFrame:
    """Uniqueness on a stream, across micro-batches and restarts (Q11, ST12): each row comes out, with ``out`` true
    if a row of its key came before it.

    A key is remembered, as keyed state, until the watermark passes its newest event time by ``delay``; a row that
    comes later than that is a first one again. Of a micro-batch's rows of one key the earliest is the first (by event time, then
    by content). Rows with a NULL key are never repeats. State and task hold one key's rows of one micro-batch at a time.
    """
    names = df.columns
    at = F.col(ts_col).cast("timestamp")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # rows without a key get one of their own
    own = F.when(known, F.to_json(F.struct(*keys))).otherwise(F.concat(F.lit("~"), F.expr("uuid()")))
    staged = df.select(own.alias("__key"), at.alias("__at"), F.to_json(F.struct(*names), JSON_OPTIONS).alias("__row")).withWatermark("__at", delay)

    def tell(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["__at", "__row"], kind="stable")
        last = rows["__at"].max()
        if state.exists:
            last = max(last, pd.Timestamp(state.get[0], unit="us"))
        flags = [True] * len(rows)
        flags[0] = state.exists
        state.update((int(last.value // 1000),))
        floor = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(int(last.value // 1_000_000), floor + 1))
        yield pd.DataFrame({"__row": rows["__row"].to_numpy(), "__flag": flags})

    told = staged.groupBy("__key").applyInPandasWithState(tell, "__row string, __flag boolean", "at long", "append",
                                                           GroupStateTimeout.EventTimeTimeout)
    return told.select(F.from_json("__row", df.schema, JSON_OPTIONS).alias("r"), F.col("__flag").alias(out)).select("r.*", out)


# ---------------------------------------------------------------- sinks (ST6-ST8, ST12, ST14)

def append_stream(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                  partition_by: Sequence[str] = (), fmt: str = "parquet", query_name: str | None = None) -> StreamingQuery:
    """Append a stream to files, exactly once through the checkpoint (ST6, ST7).
    ``trigger``: None = default, ``"availableNow"``, or an interval such as ``"1 minute"``."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start(path)


def upsert_batch_fn(store, table: str, keys: Sequence[str], seq: Sequence[str], op_col: str | None = None,
                    rules: Sequence[Q.Rule] = (), quarantine_table: str | None = None,
                    run_id: str = "stream", parents=None, as_of=None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for streaming upsert / CDC by sequence (ST8, ST12).

    Per micro-batch: split QUARANTINE-rule failures to the quarantine table
    (one partition per batch id, so a replay replaces what it wrote), let
    stored rows and changes compete by the full sequence, merge only the key buckets
    that the batch touches, then record the batch id. A batch id already
    recorded is skipped; a batch replayed in part changes nothing, because deleted
    keys stay as tombstones (:func:`stratum.operators.merge.live_rows` hides them).
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        if store.has_commit(table, batch_id):
            return
        good = batch
        if rules:
            good, bad, _ = Q.apply_rules(batch, rules, parents, as_of)
            if quarantine_table:
                bad = bad.withColumn("_dq_failed_rules", F.concat_ws(",", "_dq_failed_rules"))
                store.overwrite_partitions(quarantine_table, QR.stamp(bad, "DQ_FAILURE", run_id, f"batch {batch_id}")
                                           .withColumn("batch_id", F.lit(batch_id)), ("batch_id",))
            good = good.drop("_dq_warnings")
        op = op_col or "__op"
        changes = good if op_col else good.withColumn(op, F.lit("U"))
        store.merge(table, lambda cur: M.apply_changes(cur, changes, keys, seq, op, tombstones=op_col is not None), keys, changes)
        store.mark_commit(table, batch_id)
    return fn


def history_batch_fn(store, table: str, keys: Sequence[str], ts_col: str, tracked: Sequence[str] | None = None,
                     late_table: str | None = None, run_id: str = "stream", tie_break: Sequence[str] = (),
                     op_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for a streaming type 2 history (ST8): each row begins a version at its event time, and
    late and intermediate ones are spliced into the stored intervals, so the history doesn't depend on where the stream
    is cut (:func:`stratum.operators.history.splice`; :func:`stratum.operators.history.versions` shows it).

    With ``late_table`` rows older than the key's current version are put aside there instead (ST11). Rows without a
    key or a time go to ``<table>_quarantine``. Both hold one partition a batch, which a replay replaces.
    """
    def put(name: str, df: DataFrame, reason: str, batch_id: int) -> None:
        store.overwrite_partitions(name, QR.stamp(df, reason, run_id, f"batch {batch_id}").withColumn("batch_id", F.lit(batch_id)), ("batch_id",))

    def fn(batch: DataFrame, batch_id: int) -> None:
        if store.has_commit(table, batch_id):
            return
        good = batch
        before = store.read(table)
        if late_table and before is not None:
            newest = H.current(before).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__start_at").alias("__from"))
            met = batch.join(newest, [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)], "left")
            late = F.coalesce(F.col(ts_col).cast("timestamp_ntz") < F.col("__from"), F.lit(False))
            put(late_table, met.where(late).select(*batch.columns), "LATE_DATA", batch_id)
            good = met.where(~late).select(*batch.columns)
        unplaced = H.splice(None, good, keys, ts_col, tracked, tie_break, op_col).rejects.drop("reject_reason")
        if not unplaced.isEmpty():
            put(f"{table}_quarantine", unplaced, "MISSING_KEY", batch_id)
        store.merge(table, lambda cur: H.splice(cur, good, keys, ts_col, tracked, tie_break, op_col).history, keys, good)
        store.mark_commit(table, batch_id)
    return fn


# ---------------------------------------------------------------- schema evolution of a stream (ST5)

class SchemaChanged(Exception):
    """A micro-batch holds columns that the stream's stored schema does not."""


class StreamSchema:
    """The schema of a stream of JSON files, kept as numbered rows in a table of the store."""

    def __init__(self, store, name: str):
        self.store, self.name = store, name

    def read(self) -> T.StructType | None:
        rows = self.store.read(self.name)
        last = None if rows is None else rows.agg(F.max(F.struct("version", "schema"))).first()[0]
        return None if last is None else T.StructType.fromJson(json.loads(last["schema"]))

    def write(self, schema: T.StructType) -> None:
        spark, rows = self.store.spark, self.store.read(self.name)
        version = 0 if rows is None else rows.agg(F.max("version")).first()[0] + 1
        self.store.append(self.name, spark.createDataFrame([(version, json.dumps(schema.jsonValue()))], "version int, schema string").coalesce(1))


EVOLUTION_MODES = ("addNewColumns", "rescue", "failOnNewColumns")


def evolving_batch_fn(store, table: str, schema: StreamSchema, mode: str = "addNewColumns") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends JSON lines (column ``value``) under the stored schema.

    The columns of each batch's files are compared with it first. New ones end the run with :class:`SchemaChanged`:
    in mode addNewColumns after the stored schema has grown by them, in mode failOnNewColumns with the schema as it was. In mode rescue
    the schema never grows: what it doesn't know is kept as JSON in ``_rescued_data``. Lines that are no JSON
    object are kept there whole. A batch is one partition, which a replay replaces.
    """
    if mode not in EVOLUTION_MODES:
        raise ValueError(f"unknown mode {mode}")

    def fn(batch: DataFrame, batch_id: int) -> None:
        known = schema.read() or T.StructType()
        names = batch.select(F.explode(F.json_object_keys("value")).alias("name")).distinct()
        unknown = names.where(~F.col("name").isin(known.fieldNames())) if known.fieldNames() else names
        new = sorted(r["name"] for r in unknown.collect())  # names of columns
        if new and (mode == "addNewColumns" or not known.fieldNames()):
            lines = batch.sparkSession.read.json(batch.select("value").rdd.map(lambda r: r[0]))
            schema.write(T.StructType([*known.fields, *[lines.schema[n] for n in new if n in lines.columns]]))
            raise SchemaChanged(f"new columns: {', '.join(new)}")
        if new and mode == "failOnNewColumns":
            raise SchemaChanged(f"unexpected columns: {', '.join(new)}")
        typed = F.from_json("value", known, JSON_OPTIONS)
        texts = F.from_json("value", "map<string,string>")
        rest = F.map_filter(texts, lambda k, v: ~k.isin(known.fieldNames()))
        rescued = F.when(F.json_object_keys("value").isNull(), F.col("value")).when(F.size(rest) > 0, F.to_json(rest))
        store.overwrite_partitions(table, batch.select(typed.alias("r"), rescued.alias("_rescued_data"))
                                   .select("r.*", "_rescued_data", F.lit(batch_id).alias("batch_id")), ("batch_id",))
    return fn


def run_evolving_stream(spark: SparkSession, path: str, store, table: str, checkpoint: str, mode: str = "addNewColumns",
                        max_files_per_trigger: int | None = None) -> int:
    """Take all JSON files under ``path`` that are new into ``table`` (ST5); the number of restarts.

    The query stops at a file set with new columns; the stored schema has grown by then, and the query is
    started again from its checkpoint, where it repeats that batch. Every restart grows the schema, so their
    number is bounded by the columns.
    """
    schema = StreamSchema(store, f"{table}_schema")
    fn = evolving_batch_fn(store, table, schema, mode)
    restarts = 0
    while True:
        before = schema.read()
        lines = file_stream(spark, path, "text", "value string", max_files_per_trigger)
        q = lines.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
            return restarts
        except StreamingQueryException as e:
            if "SchemaChanged" not in str(e):
                raise
            if schema.read() == before:  # it didn't grow: the mode forbids it
                raise SchemaChanged(str(e)) from e
            restarts += 1


class ProgressRecorder(StreamingQueryListener):
    """Per-micro-batch progress rows (ST13): no extra count() per batch; the
    numbers come from the query's own progress events. With a ``sink`` (such as
    :meth:`ledger_sink`) each row goes there; the last ``keep`` stay at hand."""

    def __init__(self, sink: Callable[[dict], None] | None = None, keep: int = 100):
        self.sink = sink
        self.rows: deque[dict] = deque(maxlen=keep)

    @staticmethod
    def ledger_sink(ledger, handle) -> Callable[[dict], None]:
        def put(row: dict) -> None:
            ledger.log_progress(handle, row)
        return put

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        row = {"query_id": str(p.id), "batch_id": p.batchId, "num_input_rows": p.numInputRows,
               "input_rows_per_second": p.inputRowsPerSecond, "processed_rows_per_second": p.processedRowsPerSecond,
               "duration_ms": dict(p.durationMs or {}).get("triggerExecution"), "timestamp": p.timestamp}
        self.rows.append(row)
        if self.sink:
            self.sink(row)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
