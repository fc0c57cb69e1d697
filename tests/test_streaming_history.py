"""Streaming type 2 history and CDC against the batch result, over a restart and replays."""

import datetime as dt
import os

from pyspark.sql import functions as F

from stratum.operators import history as H
from stratum.operators import merge as M
from stratum.operators import quality as Q
from stratum.sinks.ledger import RunLedger
from stratum.sinks.store import TableStore
from stratum.streaming import streams as ST

from .conftest import SF001, rows


def _drain(spark, src, schema, fn, ck, files=1):
    q = (ST.file_stream(spark, src, "parquet", schema, max_files_per_trigger=files).writeStream.foreachBatch(fn)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None


def test_cdc_stream_equals_batch_over_a_restart(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn(
        "op", F.when(F.col("event_type") == "error", "D").otherwise("U"))
    parts = ev.randomSplit([1.0, 1.0], seed=3)
    src, st = os.path.join(tmp_dir, "src"), TableStore(spark, os.path.join(tmp_dir, "store"), buckets=4)
    fn = ST.upsert_batch_fn(st, "t", ["user_id"], ["ts", "event_id"], "op")
    parts[0].coalesce(2).write.mode("append").parquet(src)
    _drain(spark, src, ev.schema, fn, os.path.join(tmp_dir, "ck"))
    parts[1].coalesce(1).write.mode("append").parquet(src)
    _drain(spark, src, ev.schema, fn, os.path.join(tmp_dir, "ck"))  # a new query picks up where the first ended
    fn(parts[0], 999)  # an old batch under a new id changes nothing
    batch = M.apply_changes(None, ev, ["user_id"], ["ts", "event_id"], "op")
    assert rows(M.live_rows(st.read("t")), "user_id", "event_id") == rows(batch, "user_id", "event_id")


def test_history_stream_keeps_late_rows_aside(spark, tmp_dir):
    schema = "k int, v string, ts timestamp_ntz"
    def batch(*r):
        return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in r], schema)
    st = TableStore(spark, tmp_dir, buckets=4)
    fn = ST.history_batch_fn(st, "h", ["k"], "ts", ["v"], late_table="late")
    fn(batch((1, "a", 5), (2, "x", 5)), 0)
    fn(batch((1, "b", 6), (2, "old", 1)), 1)
    fn(batch((1, "b", 6), (2, "old", 1)), 1)  # replayed
    assert rows(H.current(st.read("h")), "k", "v") == [(1, "b"), (2, "x")] and st.read("h").count() == 3
    assert rows(st.read("late"), "k", "v", "batch_id") == [(2, "old", 1)]
    assert H.validate_history(st.read("h"), ["k"]).where("not ok").count() == 0


def test_quarantine_of_a_replayed_batch_is_replaced(spark, tmp_dir):
    st = TableStore(spark, tmp_dir, buckets=4)
    df = spark.createDataFrame([(1, 1, None), (2, 1, "b")], "k int, s int, v string")
    rule = Q.Rule("nn", "NOT_NULL", "v", action="QUARANTINE")
    fn = ST.upsert_batch_fn(st, "t", ["k"], ["s"], rules=[rule], quarantine_table="q")
    fn(df, 0)
    again = ST.upsert_batch_fn(TableStore(spark, tmp_dir, buckets=4), "t2", ["k"], ["s"], rules=[rule], quarantine_table="q")
    again(df, 0)  # as after a failure between quarantine and merge
    assert st.read("q").count() == 1 and st.read("t").count() == 1


def test_progress_goes_to_the_ledger(spark, tmp_dir):
    st = TableStore(spark, os.path.join(tmp_dir, "store"))
    ledger = RunLedger(spark, st)
    h = ledger.start_run("stream", "events", "STREAMING")
    rec = ST.ProgressRecorder(ST.ProgressRecorder.ledger_sink(ledger, h), keep=2)
    rec.sink({"query_id": "q", "batch_id": 3, "num_input_rows": 7, "timestamp": "t"})
    got = ledger.events().where("event_type = 'PROGRESS'").first()
    assert got.metrics["num_input_rows"] == 7.0 and got.attributes["query_id"] == "q"


def test_anomalies_and_running_sums_with_nulls(spark):
    from pyspark.sql import Window

    from stratum.operators.ops import anomalies
    from stratum.operators.sequence import ordered_scan

    df = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"),
                                 F.when(F.col("id") % 7 < 4, None).otherwise(F.col("id") % 11).cast("decimal(18,2)").alias("v"))
    df = df.withColumn("v", F.when(F.col("o") < 120, None).otherwise(F.col("v")))
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "o", F.sum("v").over(w).alias("cum_v"))
    assert rows(ordered_scan(df, ["k"], ["o"], running=["v"], num_partitions=7).select("k", "o", "cum_v")) == rows(want)
    r = spark.createDataFrame([("j", 1, 10.0), ("j", 2, 11.0), ("j", 3, None), ("j", 4, 10.5), ("j", 5, 0.004)], "j string, t int, m double")
    got = {x.t: x for x in anomalies(r, ["j"], ["t"], "m").collect()}
    assert float(got[4].mean_prev) == 10.5 and float(got[5].value) == 0.004


def _log(spark):
    """Changes of a few keys, with repeats, ties, deletes, missing keys and times."""
    return spark.range(160).selectExpr(
        "if(id % 53 = 52, null, cast(id % 4 as int)) k", "concat('v', (id * 7) % 3) v",
        "if(id % 61 = 60, null, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,(id * 11) % 29)) ts", "cast(id as int) n",
        "if(id % 17 = 3, 'D', 'U') op")


def test_history_does_not_depend_on_where_the_log_is_cut(spark, tmp_dir):
    log = _log(spark)
    placed = log.where("k is not null and ts is not null")
    whole = H.scd2_from_log(placed.drop("op"), ["k"], "ts", ["v"], ["n"])
    want = rows(H.versions(whole), "k", "v", "__start_at", "__end_at", "__is_current")
    for cut in ("0", "n % 2", "hash(n) % 3", "-day(ts) div 8"):
        parts = log.withColumn("p", F.expr(cut).cast("int")).drop("op")
        h = None
        for p in sorted({r.p for r in parts.select("p").distinct().collect()}, key=str):
            h = H.splice(h, parts.where(F.col("p").eqNullSafe(F.lit(p))).drop("p"), ["k"], "ts", ["v"], ["n"]).history
            h = spark.createDataFrame(h.collect(), h.schema)  # as a table that was written
        assert rows(H.versions(h), "k", "v", "__start_at", "__end_at", "__is_current") == want, cut
    assert H.validate_history(h, ["k"]).where("n_overlaps > 0 or n_bad_open > 0").count() == 0
    assert H.splice(None, log.drop("op"), ["k"], "ts", ["v"], ["n"]).rejects.count() == log.count() - placed.count()


def test_streamed_history_equals_the_batch_one(spark, tmp_dir):
    log = _log(spark).drop("op")
    src, st = os.path.join(tmp_dir, "src"), TableStore(spark, os.path.join(tmp_dir, "store"), buckets=3)
    log.repartition(3, "n").write.parquet(src)
    fn = ST.history_batch_fn(st, "h", ["k"], "ts", ["v"], tie_break=["n"])
    _drain(spark, src, log.schema, fn, os.path.join(tmp_dir, "ck"))
    fn(log, 99)  # all of it again, under a new id
    placed = log.where("k is not null and ts is not null")
    want = H.versions(H.scd2_from_log(placed, ["k"], "ts", ["v"], ["n"]))
    cols = ("k", "v", "__start_at", "__end_at", "__is_current")
    assert rows(H.versions(st.read("h")), *cols) == rows(want, *cols)
    assert st.read("h_quarantine").where("batch_id <> 99").count() == log.count() - placed.count()


def test_feed_of_both_scd_types_with_deletes(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    schema = "k int, v string, ts timestamp_ntz, s int, op string"
    first = spark.createDataFrame([(1, "a", day(1), 1, "U"), (1, None, day(5), 1, "D"), (2, "x", day(2), 1, "U")], schema)
    second = spark.createDataFrame([(1, "b", day(3), 1, "U"), (1, "c", day(9), 1, "U"), (2, "x", day(4), 1, "U"), (2, "x", day(4), 1, "U")], schema)
    for batches in ((first, second), (second, first), (first.union(second),)):
        one = two = None
        for b in batches:
            one = H.apply_feed(one, b, ["k"], ["ts", "s"], 1, "op")
            two = H.apply_feed(two, b, ["k"], ["ts", "s"], 2, "op", tracked=["v"])
        assert rows(M.live_rows(one), "k", "v") == [(1, "c"), (2, "x")]
        shown = H.versions(two).selectExpr("k", "v", "day(__start_at) a", "day(__end_at) z", "__is_current c")
        assert sorted(map(tuple, shown.collect()), key=lambda r: r[:3:2]) == [
            (1, "a", 1, 3, False), (1, "b", 3, 5, False), (1, "c", 9, None, True), (2, "x", 2, None, True)]


def test_stream_schema_evolution_in_all_modes(spark, tmp_dir):
    import pytest

    def put(name, *lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(os.path.join(tmp_dir, name, "src"))

    def run(name, mode):
        st = TableStore(spark, os.path.join(tmp_dir, name, "store"))
        return st, ST.run_evolving_stream(spark, os.path.join(tmp_dir, name, "src"), st, "t", os.path.join(tmp_dir, name, "ck"), mode)

    for name in ("add", "rescue", "fail"):
        put(name, '{"a": 1}', '{"a": 2, "b": "x"}')
    assert run("add", "addNewColumns")[1] == 1 and run("rescue", "rescue")[1] == 1 and run("fail", "failOnNewColumns")[1] == 1  # the first schema
    for name in ("add", "rescue", "fail"):
        put(name, '{"a": 3, "c": {"d": 1.5}}', "no json", '{"b": "y"}')
    st, n = run("add", "addNewColumns")
    assert n == 1
    got = {(r.a, r.b, r.c and r.c.d, r._rescued_data) for r in st.read("t").collect()}
    assert got == {(1, None, None, None), (2, "x", None, None), (3, None, 1.5, None), (None, "y", None, None), (None, None, None, "no json")}
    st, n = run("rescue", "rescue")
    assert n == 0 and {(r.a, r.b, r._rescued_data) for r in st.read("t").collect()} == {
        (1, None, None), (2, "x", None), (3, None, '{"c":"{\\"d\\":1.5}"}'), (None, "y", None), (None, None, "no json")}
    with pytest.raises(ST.SchemaChanged):
        run("fail", "failOnNewColumns")
    assert TableStore(spark, os.path.join(tmp_dir, "fail", "store")).read("t").count() == 2
