"""Load plans: worked examples of the reference specs plus properties."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators import history as H
from stratum.operators import merge as M

from .conftest import rows

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def test_scd1_product_type_example(spark):
    # day 1: TYPE001 Auto, TYPE002 Home; day 2: TYPE001 new description, TYPE002 same, TYPE003 new
    s = "product_type_code string, product_type_name string, description string"
    d1 = spark.createDataFrame([("TYPE001", "Auto", "Auto insurance"), ("TYPE002", "Home", "Home insurance")], s)
    d2 = spark.createDataFrame([("TYPE001", "Auto", "Personal auto"), ("TYPE002", "Home", "Home insurance"),
                                ("TYPE003", "Life", "Life insurance")], s)
    out, m = M.scd1_merge(d1, d2, ["product_type_code"])
    assert rows(out) == sorted(d2.collect())
    mm = m.first()
    assert (mm.rows_inserted, mm.rows_updated, mm.rows_written) == (1, 2, 3)
    _, m2 = M.scd1_merge(d1, d2, ["product_type_code"], skip_unchanged=True)
    assert (m2.first().rows_updated, m2.first().rows_unchanged) == (1, 1)


def test_scd1_keeps_target_only_columns_and_adds_new(spark):
    t = spark.createDataFrame([(1, "a", "keep")], "k int, v string, extra string")
    b = spark.createDataFrame([(1, "b", 10), (2, "c", 20)], "k int, v string, added int")
    out, _ = M.scd1_merge(t, b, ["k"])
    assert rows(out, "k", "v", "extra", "added") == [(1, "b", "keep", 10), (2, "c", None, 20)]


def _pol(spark, data):
    return spark.createDataFrame(data, "policy_id string, status string, note string")


def test_scd2_lifecycle(spark):
    h1, m1, _ = H.scd2_merge(None, _pol(spark, [("P1", "ACTIVE", "x"), ("P2", "ACTIVE", "y")]), ["policy_id"], T1,
                          tracked=["status"])
    assert m1.first().rows_inserted == 2
    b2 = _pol(spark, [("P1", "LAPSED", "x"), ("P2", "ACTIVE", "changed-untracked"), ("P3", "ACTIVE", "z")])
    h2, m2, _ = H.scd2_merge(h1, b2, ["policy_id"], T2, tracked=["status"])
    r = {(x.policy_id, x.status): x for x in h2.collect()}
    old, new = r[("P1", "ACTIVE")], r[("P1", "LAPSED")]
    assert not old["__is_current"] and str(old["__end_at"]) == "2024-01-02 00:00:00"
    assert new["__is_current"] and new["__end_at"] is None
    assert len([x for x in h2.collect() if x.policy_id == "P2"]) == 1     # untracked change: no version
    mm = m2.first()
    assert (mm.rows_inserted, mm.rows_updated, mm.num_output_rows) == (2, 1, 3)
    # idempotent: the same batch again adds nothing
    h3, m3, _ = H.scd2_merge(h2, b2, ["policy_id"], T3, tracked=["status"])
    assert rows(h3) == rows(h2) and m3.first().num_output_rows == 0
    # snapshot delete closes absent keys, never deletes
    h4, m4, _ = H.scd2_merge(h2, _pol(spark, [("P1", "LAPSED", "x")]), ["policy_id"], T3, tracked=["status"],
                          delete_detection="snapshot")
    cur = {x.policy_id for x in h4.where("__is_current").collect()}
    assert cur == {"P1"} and h4.count() == h2.count() and m4.first().rows_closed == 2


def test_scd2_requires_keys(spark):
    with pytest.raises(ValueError):
        H.scd2_merge(None, _pol(spark, [("P1", "A", "x")]), [], T1)


def test_scd2_null_safe_change_detection(spark):
    h1, _, _ = H.scd2_merge(None, _pol(spark, [("P1", None, "x")]), ["policy_id"], T1, tracked=["status", "note"])
    h2, m, _ = H.scd2_merge(h1, _pol(spark, [("P1", None, "x")]), ["policy_id"], T2, tracked=["status", "note"])
    assert m.first().rows_updated == 0
    h3, m, _ = H.scd2_merge(h1, _pol(spark, [("P1", "x", None)]), ["policy_id"], T2, tracked=["status", "note"])
    assert m.first().rows_updated == 1        # (NULL, x) -> (x, NULL) is a change


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["A", "B", None])), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["A", "B", None])), min_size=0, max_size=25))
def test_scd2_properties(spark, a, b):
    def batch(xs):
        d = {}
        for k, v in xs:
            d[k] = v
        return spark.createDataFrame([(k, v) for k, v in d.items()] or [(None, None)], "k int, v string") \
                    .where("k IS NOT NULL")
    h1, _, _ = H.scd2_merge(None, batch(a), ["k"], T1)
    h2, _, _ = H.scd2_merge(h1, batch(b), ["k"], T2, delete_detection="snapshot")
    v = H.validate_history(h2.where(F.col("k").isNotNull()), ["k"]).collect()
    keys_in_b = {k for k, _ in b}
    for r in v:
        assert r.n_overlaps == 0 and r.n_bad_open == 0
        assert r.n_current == (1 if r.k in keys_in_b else 0)


def test_scd2_from_log_out_of_order(spark):
    log = spark.createDataFrame([("P1", "A", "2024-01-03"), ("P1", "A", "2024-01-01"), ("P1", "B", "2024-01-02"),
                                 ("P2", "X", "2024-01-05")], "id string, s string, ts string") \
               .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    h = H.scd2_from_log(log, ["id"], "ts", tracked=["s"])
    got = [(r.id, r.s, str(r["__start_at"])[:10], str(r["__end_at"])[:10] if r["__end_at"] else None,
            r["__is_current"])
           for r in h.orderBy("id", "__start_at").collect()]
    assert got == [("P1", "A", "2024-01-01", "2024-01-02", False), ("P1", "B", "2024-01-02", "2024-01-03", False),
                   ("P1", "A", "2024-01-03", None, True), ("P2", "X", "2024-01-05", None, True)]


def test_dedupe_and_apply_changes(spark):
    ch = spark.createDataFrame([(1, 1, "I", "a"), (1, 3, "U", "c"), (1, 2, "U", "b"), (2, 1, "I", "x"),
                                (2, 2, "D", "x"), (3, 5, "U", "z")], "k int, seq int, op string, v string")
    assert rows(M.dedupe_latest(ch, ["k"], ["seq"]), "k", "v") == [(1, "c"), (2, "x"), (3, "z")]
    win, lose = M.dedupe_split(ch, ["k"], ["seq"])
    assert win.count() == 3 and lose.count() == 3
    tgt = spark.createDataFrame([(3, 9, "old-newer")], "k int, seq int, v string")
    out = M.apply_changes(tgt, ch, ["k"], ["seq"], "op")
    # key 2 deleted; key 3 keeps the stored row (its change is older than the stored sequence)
    assert rows(out, "k", "v") == [(1, "c"), (3, "old-newer")]


def test_partition_overwrite_transactions_example(spark):
    s = "txn_id string, txn_date string, amount double"
    t = spark.createDataFrame([("TXN001", "2024-01-15", 1.0), ("TXN002", "2024-02-20", 2.0)], s)
    b = spark.createDataFrame([("TXN003", "2024-01-25", 3.0)], s)
    # partitioned by the full date: all three rows remain
    assert M.partition_overwrite(t, b, ["txn_date"]).count() == 3
    # partitioned by month: January is replaced
    tm, bm = (x.withColumn("month", F.substring("txn_date", 1, 7)) for x in (t, b))
    assert rows(M.partition_overwrite(tm, bm, ["month"]), "txn_id") == [("TXN002",), ("TXN003",)]
    # empty batch replaces nothing
    assert M.partition_overwrite(tm, bm.limit(0), ["month"]).count() == 2


def test_table_diff_and_scd3(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    d = rows(M.table_diff(old, new, ["k"]), "k", "v", "_change_type")
    assert d == sorted([(2, "b", "update_preimage"), (2, "B", "update_postimage"), (3, "c", "delete"),
                        (4, "d", "insert")])
    s3 = M.scd3_merge(M.scd3_merge(None, old, ["k"], ["v"]), new, ["k"], ["v"])
    assert rows(s3, "k", "v", "prev_v") == [(1, "a", None), (2, "B", "b"), (3, "c", None), (4, "d", None)]


def test_scd2_rejects_hold_what_history_does_not(spark):
    schema = "k int, v string, ts timestamp_ntz"
    def batch(*r):
        return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in r], schema)
    b1 = batch((1, "a", 5), (1, "a", 5), (1, "old", 2), (2, "x", 1), (None, "lost", 1))
    h, m, rej = H.scd2_merge(None, b1, ["k"], T1, tracked=["v"], event_ts_col="ts")
    assert rows(h, "k", "v") == [(1, "a"), (2, "x")]
    assert sorted((r.k or 0, r.v, r.reject_reason) for r in rej.collect()) == [
        (0, "lost", "MISSING_KEY"), (1, "a", "DUP_KEY"), (1, "old", "DUP_KEY")]
    assert m.first().rows_rejected == 3
    b2 = batch((1, "late", 3), (2, "y", 4), (2, "z", 4), (3, "n", 1))
    h2, m2, rej2 = H.scd2_merge(h, b2, ["k"], T2, tracked=["v"], event_ts_col="ts")
    assert rows(H.current(h2), "k", "v") == [(1, "a"), (2, "z"), (3, "n")] and h2.count() == 4
    assert sorted((r.k, r.v, r.reject_reason) for r in rej2.collect()) == [(1, "late", "LATE_DATA"), (2, "y", "DUP_KEY")]
    assert m2.first().rows_rejected == 2


def test_dedupe_takes_maps_and_equal_rows(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 1}), (1, 2, {"b": 1}), (2, 1, None), (None, 1, None), (None, 1, None)],
                               "k int, s int, m map<string,int>")
    win, lose = M.dedupe_split(df, ["k"], ["s"])
    assert win.count() == 3 and lose.count() == 3
    assert {r.k: r.m for r in win.collect()}[1] == {"b": 1}


def test_cdc_out_of_order_twice_with_deletes(spark):
    ch = spark.createDataFrame([(1, 1, 1, "I", "a"), (1, 3, 1, "D", None), (2, 2, 1, "I", "b"), (2, 2, 2, "U", "c"), (1, 2, 9, "U", "x")],
                               "k int, ts int, id int, op string, v string")
    batches = [ch.where("ts = 3"), ch.where("ts = 2"), ch.where("ts = 1"), ch.where("ts = 2"), ch.where("ts = 3")]
    state = None
    for b in batches:
        state = M.apply_changes(state, b, ["k"], ["ts", "id"], "op", tombstones=True)
    assert rows(M.live_rows(state), "k", "v") == [(2, "c")]


def test_plans_keep_columns_only_the_batch_has(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "B", 7.0)], "k int, v string, extra double")
    assert rows(M.delete_insert(t, b, ["k"]), "k", "extra") == [(1, None), (2, 7.0)]
    assert rows(M.scd3_merge(M.scd3_merge(None, t, ["k"], ["v"]), b, ["k"], ["v"]), "k", "v", "prev_v", "extra") == [
        (1, "a", None, None), (2, "B", "b", 7.0)]
    assert rows(M.scd1_merge(t, b, ["k"])[0], "k", "v", "extra") == [(1, "a", None), (2, "B", 7.0)]
