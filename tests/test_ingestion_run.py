"""One test per branch of an ingestion run, and the table store's promise to lose nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators import evolve as E
from stratum.operators import history as H
from stratum.operators import merge as M
from stratum.operators import quality as Q
from stratum.plans.ingestion import IngestionConfig, run_ingestion
from stratum.sinks.ledger import RunLedger
from stratum.sinks.store import TableStore

from .conftest import rows


@pytest.fixture()
def env(spark, tmp_dir):
    st = TableStore(spark, tmp_dir, buckets=4)
    return st, RunLedger(spark, st, fallback_dir=f"{tmp_dir}/fb")


def _run(spark, env, df, **cfg):
    st, ledger = env
    more = {k: cfg.pop(k) for k in ("parents", "as_of") if k in cfg}
    cfg.setdefault("entity", "e")
    cfg.setdefault("target_table", "t")
    return run_ingestion(spark, st, ledger, IngestionConfig(**cfg), lambda: df, **more)


def _quarantine(st):
    q = st.read("t_quarantine")
    return {} if q is None else {r.reason_category: r["count"] for r in q.groupBy("reason_category").count().collect()}


def test_store_keeps_every_row(spark, env):
    st, _ = env
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    st.replace("x", a)
    st.append("x", spark.createDataFrame([(4, "d"), (5, "e")], "k int, v string"))
    assert st.read("x").count() == 5
    b = spark.createDataFrame([(5, "E"), (6, "f")], "k int, v string")
    r = st.merge("x", lambda cur: (M.scd1_actions(cur, b, ["k"]), M.scd1_metrics()), ["k"], b)
    assert (r["rows_inserted"], r["rows_updated"]) == (1, 1)
    st.append("x", spark.createDataFrame([(7, "g")], "k int, v string"), keys=["k"])
    c = spark.createDataFrame([(7, "G"), (8, "h")], "k int, v string")
    st.merge("x", lambda cur: (M.scd1_actions(cur, c, ["k"]), M.scd1_metrics()), ["k"], c)
    assert rows(st.read("x"), "k", "v") == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "E"), (6, "f"), (7, "G"), (8, "h")]
    with pytest.raises(ValueError):
        st.append("x", c)
    gone = st.read("x").select("k")
    st.merge("x", lambda cur: M.delete_insert(cur, c.limit(0), ["k"]).join(gone.where("k = 8"), "k", "left_anti"), ["k"], c)
    assert st.read("x").count() == 7


def test_merge_rewrites_only_touched_buckets(spark, env):
    import os

    st, _ = env
    st.merge("x", lambda cur: spark.range(100).withColumn("v", F.lit(0)), ["id"])
    def files():
        return {f for d, _, fs in os.walk(st.path("x")) for f in fs if f.endswith(".parquet")}
    before = files()
    b = spark.createDataFrame([(5, 9)], "id long, v int")
    st.merge("x", lambda cur: M.scd1_merge(cur, b, ["id"])[0], ["id"], b)
    assert len(before & files()) >= len(before) * 0.5 and st.read("x").count() == 100
    assert rows(st.read("x").where("id = 5"), "v") == [(9,)]


def test_duplicates_and_missing_keys_are_quarantined(spark, env):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "x"), (2, 1, "c")], "k int, s int, v string")
    r = _run(spark, env, df, load_pattern="SCD1", keys=["k"], sequence=["s"])
    assert (r.status, r.rows_read, r.rows_written, r.rows_rejected) == ("SUCCESS", 4, 2, 2)
    assert _quarantine(env[0]) == {"DUP_KEY": 1, "MISSING_KEY": 1}


def test_narrowing_is_rejected_and_widening_applied(spark, env):
    st, _ = env
    _run(spark, env, spark.createDataFrame([(1, 5)], "k int, n int"), load_pattern="SCD1", keys=["k"])
    r = _run(spark, env, spark.createDataFrame([(2, "x")], "k int, n string"), load_pattern="SCD1", keys=["k"])
    assert (r.status, r.rows_written, r.rows_rejected) == ("REJECTED", 0, 1) and r.messages
    r = _run(spark, env, spark.createDataFrame([(2, 1 << 40)], "k int, n long"), load_pattern="SCD1", keys=["k"])
    assert r.status == "SUCCESS" and rows(st.read("t"), "k", "n") == [(1, 5), (2, 1 << 40)]
    assert st.read("t").schema["n"].dataType.simpleString() == "bigint"


def test_added_column_rescue_defer_and_evolve(spark, env):
    st, ledger = env
    _run(spark, env, spark.createDataFrame([(1, "a")], "k int, v string"))
    wide = spark.createDataFrame([(2, "b", "new")], "k int, v string, extra string")
    r = _run(spark, env, wide, evolution=E.EvolutionContext(zero_downtime=True))
    assert r.status == "SUCCESS" and st.read("t").columns == ["k", "v"]
    assert rows(st.read("t_rescued"), "_rescued_data") == [('{"extra":"new"}',)]
    r = _run(spark, env, wide, evolution=E.EvolutionContext(source_system_type="regulated"))
    assert r.status == "DEFERRED" and st.read("t").count() == 2 and _quarantine(st) == {"SCHEMA_DRIFT": 1}
    r = _run(spark, env, wide, evolution=E.EvolutionContext(paranoid=True))
    assert r.status == "SUCCESS" and "extra" in st.read("t").columns and st.read("t_rescued").count() == 2
    decided = ledger.events().where("event_type = 'SCHEMA_DECISION'")
    assert decided.where("attributes['approval_status'] = 'PENDING'").count() == 3 and decided.count() == 6


def test_fail_rule_stops_before_the_write(spark, env):
    st, ledger = env
    rule = Q.Rule("r", "NOT_NULL", "v", action="FAIL")
    with pytest.raises(Q.DataQualityError):
        _run(spark, env, spark.createDataFrame([(1, None)], "k int, v string"), rules=[rule])
    assert st.read("t") is None
    assert ledger.events().where("event_type = 'END'").first().status == "FAILED"


def test_referential_and_freshness_rules_in_a_run(spark, env):
    parent = spark.createDataFrame([(1,)], "id int")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (9, dt.datetime(2024, 1, 1))], "k int, ts timestamp_ntz")
    rules = [Q.Rule("ref", "REFERENTIAL", "k", parent="p", parent_column="id", action="QUARANTINE"),
             Q.Rule("fresh", "FRESHNESS", "ts", max_age_seconds=10, action="WARN")]
    r = _run(spark, env, df, rules=rules, parents={"p": parent}, as_of="2024-01-02 00:00:00")
    assert (r.status, r.rows_written, r.rows_rejected) == ("SUCCESS", 1, 1)


def test_scd2_run_balances_by_rows(spark, env):
    st, ledger = env
    schema = "k int, v string, ts timestamp_ntz"
    day = lambda d: dt.datetime(2024, 1, d)
    cfg = {"load_pattern": "SCD2", "keys": ["k"], "tracked": ["v"], "event_ts_col": "ts", "batch_ts": "2024-02-01 00:00:00"}
    _run(spark, env, spark.createDataFrame([(1, "a", day(5)), (2, "b", day(5))], schema), **cfg)
    r = _run(spark, env, spark.createDataFrame([(1, "A", day(6)), (1, "z", day(4)), (2, "old", day(1)), (None, "n", day(1)),
                                               (3, "c", day(1))], schema), **cfg)
    assert (r.status, r.rows_read, r.rows_written, r.rows_rejected, r.balance_delta) == ("SUCCESS", 5, 2, 3, 0)
    assert _quarantine(st) == {"DUP_KEY": 1, "LATE_DATA": 1, "MISSING_KEY": 1}
    assert rows(H.current(st.read("t")), "k", "v") == [(1, "A"), (2, "b"), (3, "c")]
    assert ledger.events().where("event_type = 'BALANCE'").count() == 2


def test_cdc_run_and_incremental_mark(spark, env):
    st, _ = env
    cfg = {"load_pattern": "CDC", "keys": ["k"], "sequence": ["s"], "op_col": "op"}
    schema = "k int, s int, op string, v string"
    _run(spark, env, spark.createDataFrame([(1, 2, "D", None), (2, 1, "I", "b")], schema), **cfg)
    r = _run(spark, env, spark.createDataFrame([(1, 1, "I", "a"), (2, 2, "U", "B")], schema), **cfg)
    assert r.status == "SUCCESS" and rows(M.live_rows(st.read("t")), "k", "v") == [(2, "B")]
    df = spark.createDataFrame([(1, 1), (2, 2)], "id int, mark_col int")
    inc = {"target_table": "i", "watermark": "mark_col"}
    assert _run(spark, env, df, **inc).rows_written == 2
    assert _run(spark, env, df.union(spark.createDataFrame([(3, 3)], df.schema)), **inc).rows_written == 1
    assert st.read("i").count() == 3


def test_write_failure_goes_to_quarantine(spark, env):
    st, ledger = env

    class Broken(TableStore):
        def append(self, table, *a, **k):
            if table == "t":
                raise OSError("disk full")
            return super().append(table, *a, **k)

    broken = Broken(spark, st.root)
    with pytest.raises(OSError):
        _run(spark, (broken, ledger), spark.createDataFrame([(1, "a")], "k int, v string"))
    assert _quarantine(st) == {"WRITE_FAILURE": 1}


def test_feed_document_runs_to_silver(spark, env, tmp_dir):
    import json

    from stratum.plans import feeds

    st, ledger = env
    feed = {"source": {"source_id": "src_p", "source_type": "CDC", "active_flag": True},
            "target_bronze": {"target_id": "b", "schema_name": "bronze", "table_name": "policy", "layer": "BRONZE",
                              "primary_key": ["policy_id"], "active_flag": True},
            "target_silver": {"target_id": "s", "schema_name": "silver", "table_name": "policy", "layer": "SILVER",
                              "primary_key": ["policy_id"], "active_flag": True},
            "load": {"load_id": "l", "load_type": "BATCH", "load_pattern": "APPEND", "engine": "SPARK_SQL", "active_flag": True},
            "transform_silver": {"scd_type": "SCD2", "scd_key_columns": "policy_number", "engine": "SPARK_SQL", "active_flag": True},
            "dq_rules": [{"dq_rule_id": "pk", "target_id": "s", "rule_type": "NOT_NULL", "column_name": "policy_id",
                          "on_failure": "FAIL", "threshold_percent": 1.0, "active_flag": True},
                         {"dq_rule_id": "uq", "target_id": "s", "rule_type": "UNIQUE", "column_name": "policy_id",
                          "on_failure": "QUARANTINE", "threshold_percent": None, "active_flag": True}]}
    path = f"{tmp_dir}/feed.json"
    with open(path, "w") as f:
        json.dump(feed, f, indent=1)
    configs = feeds.configs_of_feed(spark, path, "2024-01-01 00:00:00")
    assert configs["silver"].load_pattern == "SCD2" and list(configs["silver"].keys) == ["policy_number"]
    assert [r.threshold for r in configs["silver"].rules] == [1.0, 1.0] and not configs["bronze"].rules
    df = spark.createDataFrame([("1", "P1"), ("2", "P2"), ("2", "P3")], "policy_id string, policy_number string")
    done = feeds.run_feed(spark, st, ledger, configs, lambda: df)
    assert {k: v.status for k, v in done.items()} == {"bronze": "SUCCESS", "silver": "SUCCESS"}
    assert H.current(st.read("silver/policy")).count() == 1 and st.read("silver/policy_quarantine").count() == 2


def test_config_rows_and_waves(spark):
    from stratum.plans import feeds

    loads = spark.createDataFrame([("l1", "t1", "INCREMENTAL", "MERGE", "ts", True)],
                                  "load_id string, target_id string, load_type string, load_pattern string, watermark_column string, "
                                  "active_flag boolean").withColumn("merge_keys", F.array(F.lit("k")))
    targets = spark.createDataFrame([("t1", "silver", "x", "SILVER")], "target_id string, schema_name string, table_name string, layer string")
    cfg = feeds.config_of_load(loads, targets, "l1")
    assert (cfg.load_pattern, list(cfg.keys), cfg.watermark, cfg.target_table) == ("SCD1", ["k"], "ts", "silver/x")
    dep = spark.createDataFrame([("b", "a", True), ("c", "b", True), ("c", "z", True), ("a", "c", False)],
                                "object_id string, depends_on_id string, active_flag boolean")
    assert feeds.in_order(dep, ["a", "b", "c", "d"]) == [["a", "d"], ["b"], ["c"]]
    with pytest.raises(ValueError):
        feeds.in_order(dep.withColumn("active_flag", F.lit(True)), ["a", "b", "c"])


def test_config_versions_and_exact_doubles(spark):
    from stratum.operators import config as C

    eav = C.to_param_rows(spark.createDataFrame([(1, 0.995, 0.001)], "job long, a double, b double"), "job", "z",
                          eff_ts="2024-01-01 00:00:00")
    back = C.from_param_rows(eav, {"a": "double", "b": "double"}).first()
    assert (back.a, back.b) == (0.995, 0.001)
    keys = ["JOB_SK", "PARAM_ZONE", "PARAM_NM"]
    row = eav.where("PARAM_NM = 'a'").drop("REC_VER_NO", "EFF_STRT_DTS", "EFF_END_DTS", "CURR_FLG")
    assert C.save_version(eav, row, keys, "2024-02-01 00:00:00").count() == 2
    v2 = C.save_version(eav, row.withColumn("PARAM_VAL", F.lit("2")), keys, "2024-02-01 00:00:00")
    closed = v2.withColumn("CURR_FLG", F.lit(False))
    v3 = C.save_version(closed, row, keys, "2024-03-01 00:00:00")
    assert v3.agg(F.max("REC_VER_NO")).first()[0] == 3
    bad = C.validate_config(spark.createDataFrame([("src_a", None), ("src_b", "FILE")], "source_id string, source_type string"),
                            spark.createDataFrame([("t", "GOLD", "DELTA_EXTERNAL")], "target_id string, layer string, table_type string"),
                            spark.createDataFrame([("l", "src_b", "t", "SPARK_SQL", "FULL")],
                                                  "load_id string, source_id string, target_id string, engine string, load_type string"))
    assert {(r.entity_id, r.rule) for r in bad.collect()} == {
        ("src_a", "source_type_domain"), ("t", "layer_table_type"), ("l", "engine_source"), ("l", "load_type_domain")}


def test_incremental_run_keeps_every_row_once(spark, env):
    st, _ = env
    schema = "id int, m int"
    cfg = {"target_table": "t", "watermark": "m"}
    def run(*r):
        return _run(spark, env, spark.createDataFrame(list(r), schema), **cfg)
    assert run((1, 5), (2, 9)).rows_written == 2
    # 100 is above 9 as a number, not as text; what is stored is read again, and left out
    assert run((1, 5), (2, 9), (3, 100)).rows_written == 1
    r = run((1, 5), (2, 9), (3, 100), (4, 101), (5, 100), (6, None), (7, 50))  # new, tied with the mark, without one, late
    assert (r.status, r.rows_read, r.rows_written, r.rows_rejected) == ("SUCCESS", 4, 2, 2)
    assert rows(st.read("t"), "id") == [(1,), (2,), (3,), (4,), (5,)]
    q = st.read("t_quarantine")
    assert rows(q, "id", "reason_category") == [(6, "MISSING_KEY"), (7, "LATE_DATA")]


def test_text_partitions_come_back_as_text(spark, env):
    st, _ = env
    df = spark.createDataFrame([(1, "007"), (2, "010"), (3, ""), (4, None), (5, "1e3"), (6, "__empty__x")], "id int, code string")
    for n in (1, 2):
        assert _run(spark, env, df, target_table="p", partition_by=["code"]).status == "SUCCESS"
        back = st.read("p")
        assert dict(back.dtypes) == {"id": "int", "code": "string"} and back.count() == 6 * n
        assert sorted({r.code for r in back.collect()}, key=str) == sorted({r.code for r in df.collect()}, key=str)
    st.overwrite_partitions("p", df.where("id = 3"), ["code"])  # the partition of empty text alone
    assert st.read("p").count() == 11 and st.read("p").where("code = ''").count() == 1
    st.replace("p", df.withColumn("n", F.lit(1)), ["code"])
    assert st.read("p").where("code = '007' and n = 1").count() == 1 and st.read("p").count() == 6


def test_partition_overwrite_of_many_column_pairs(spark):
    target = spark.range(20_000).selectExpr("id", "cast(id % 5000 as int) a", "if(id % 5000 = 7, null, concat('p', id % 5000)) b")
    batch = target.where("a < 4000").groupBy("a", "b").agg(F.min("id").alias("id")).select("id", "a", "b")
    out = M.partition_overwrite(target, batch, ["a", "b"])
    assert out.count() == 4000 + 4 * 1000
    assert out.where("a = 7").count() == 1


def test_reads_are_tried_again_only_for_passing_errors(spark, env):
    from stratum.sources.readers import is_transient, with_read_retry
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            spark.sql("select assert_true(false, 'java.io.IOException: Connection reset')").collect()  # fails when it is run
        return "read"

    assert with_read_retry(flaky, base_delay=0.01) == "read" and len(tries) == 3
    assert is_transient(OSError()) and not is_transient(FileNotFoundError()) and not is_transient(ValueError("x"))
    with pytest.raises(ValueError):
        with_read_retry(lambda: int("x"), base_delay=10)


def test_write_failure_holds_each_row_once(spark, env):
    st, ledger = env

    class Broken(TableStore):
        def merge(self, *a, **k):
            raise OSError("disk full")

    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    with pytest.raises(OSError):
        _run(spark, (Broken(spark, st.root), ledger), df, load_pattern="SCD1", keys=["k"])
    assert _quarantine(st) == {"WRITE_FAILURE": 3}
