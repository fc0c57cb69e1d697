import os

import pytest
from pyspark.sql import functions as F

from stratum.operators import config as C
from stratum.operators import evolve as E
from stratum.operators import lineage as L
from stratum.operators import ops as O
from stratum.plans.ingestion import IngestionConfig, run_ingestion
from stratum.sinks.ledger import RunLedger
from stratum.sinks.store import TableStore
from stratum.sources import readers as RD
from stratum.streaming import streams as ST

from .conftest import rows


def test_csv_corrupt_capture_with_and_without_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "in.csv")
    with open(p, "w") as f:
        f.write("id,amount\n1,10.5\n2,oops\n3,7\n")
    df = RD.read_files(spark, p, "csv", schema="id int, amount double")
    from stratum.operators.quarantine import split_corrupt
    clean, bad = split_corrupt(df)
    assert clean.count() == 2 and bad.count() == 1
    inferred = RD.read_files(spark, p, "csv")
    assert "_corrupt_record" in inferred.columns
    with pytest.raises(ValueError):
        RD.read_files(spark, p, "xlsx")


def test_union_sources_mismatch(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2,)], "id int")
    with pytest.raises(RD.SchemaMismatch):
        RD.union_sources([a, b])
    u = RD.union_sources([a, b], allow_mismatch=True)
    assert rows(u, "id", "v", "_union_null_fill") == [(1, "x", None), (2, None, "v")]


def test_jdbc_options_validation(spark):
    url, driver = RD.jdbc_url("postgresql", "db", "claims")
    assert url == "jdbc:postgresql://db:5432/claims" and driver == "org.postgresql.Driver"
    with pytest.raises(ValueError):
        RD.read_jdbc(spark, url, query="select 1", partition_column="id", lower_bound=1, upper_bound=2,
                     num_partitions=2)


def test_store_versions_and_merge(spark, tmp_dir):
    from stratum.operators import merge as M
    st = TableStore(spark, tmp_dir)
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert st.replace("t", a).num_output_rows == 2
    r = st.merge("t", lambda cur: M.scd1_merge(cur, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"),
                                               ["k"]))
    assert rows(st.read("t")) == [(1, "a"), (2, "B"), (3, "c")] and r["rows_inserted"] == 1
    assert st.append("q", a).num_output_rows == 2 and st.append("q", a.limit(0)).num_output_rows == 0
    assert st.read("q").count() == 2


def test_stream_upsert_with_replay_guard(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    schema = "k int, seq int, v string"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.mode("append").json(src)
    st = TableStore(spark, os.path.join(tmp_dir, "store"))
    fn = ST.upsert_batch_fn(st, "t", ["k"], ["seq"])
    ck = os.path.join(tmp_dir, "ck")

    def run():
        q = (ST.file_stream(spark, src, "json", schema).writeStream.foreachBatch(fn)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(120)

    run()
    spark.createDataFrame([(1, 2, "a2"), (2, 0, "old")], schema).write.mode("append").json(src)
    run()
    assert rows(st.read("t"), "k", "v") == [(1, "a2"), (2, "b")]
    fn(spark.createDataFrame([(1, 9, "replayed")], schema), 0)      # batch 0 already committed
    assert rows(st.read("t"), "k", "v") == [(1, "a2"), (2, "b")]


def test_streaming_equals_batch_for_arrivals(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = os.path.join(tmp_dir, "ev")
    ev.repartition(4).write.parquet(src)
    stream = ST.with_event_time(ST.file_stream(spark, src, "parquet", ev.schema, max_files_per_trigger=1), "ts",
                                "1 day")
    q = (ST.arrivals(stream, "ts", "1 day", ["event_type"]).writeStream.outputMode("complete").format("memory")
         .queryName("arr").trigger(availableNow=True).start())
    q.awaitTermination(120)
    batch = ST.arrivals(ev.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", ["event_type"])
    assert rows(spark.table("arr")) == rows(batch)


def test_kafka_roundtrip_and_cdc(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    rec = ST.as_kafka_records(df, "id", "t", "id")
    assert rows(ST.parse_kafka_json(rec, df.schema, keep=()), "id", "v") == [(1, "a"), (2, "b")]
    ev = RD.to_cdc_events(df, F.when(F.col("id") == 2, "d").otherwise("c"), F.col("id"))
    p = RD.parse_cdc(ev, "value", df.schema, ["id"])
    assert rows(p, "id", "v", "_op") == [(1, "a", "I"), (2, "b", "D")]


def test_lineage_cycles_and_levels(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "node string, parent string")
    cyc = {r.node for r in L.find_cycles(e).collect()}
    assert cyc == {"a", "b", "c"}
    blocked = {r.node: (r.level, r.blocked_by_cycle) for r in L.build_levels(e.union(spark.createDataFrame([("x", "y")], e.schema))).collect()}
    assert blocked == {"a": (None, True), "b": (None, True), "c": (None, True), "d": (None, True), "x": (1, False), "y": (0, False)}
    assert {r.node for r in L.transitive_closure(e, start=["d"]).collect()} == {"d"}
    dag = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("d", "c")], "node string, parent string")
    lv = {r.node: r.level for r in L.build_levels(dag).collect()}
    assert lv == {"c": 0, "b": 1, "d": 1, "a": 2}
    cl = {(r.node, r.ancestor): r.depth for r in L.transitive_closure(dag).collect()}
    assert cl[("a", "c")] == 1 and cl[("a", "b")] == 1 and len(cl) == 4


def test_eav_roundtrip_and_versions(spark):
    df = spark.createDataFrame([(1001, "x", True, ["a", "b"], None)],
                               "job long, name string, flag boolean, tags array<string>, missing string")
    eav = C.to_param_rows(df, "job", "cfg", eff_ts="2024-01-01 00:00:00")
    assert eav.count() == 3                                 # NULL skipped
    back = C.from_param_rows(eav, {"name": "string", "flag": "boolean", "tags": "array<string>"})
    r = back.first()
    assert (r.name, r.flag, r.tags) == ("x", True, ["a", "b"])
    changed = eav.where("PARAM_NM = 'name'").withColumn("PARAM_VAL", F.lit("y"))
    v2 = C.save_version(eav, changed.drop("REC_VER_NO", "EFF_STRT_DTS", "EFF_END_DTS", "CURR_FLG"),
                        ["JOB_SK", "PARAM_ZONE", "PARAM_NM"], "2024-02-01 00:00:00")
    cur = {r.PARAM_NM: (r.PARAM_VAL, r.REC_VER_NO) for r in v2.where("CURR_FLG").collect()}
    assert cur["name"] == ("y", 2) and v2.count() == 4


def test_config_validation(spark):
    loads = spark.createDataFrame([("l1", "s1", "t1", "INCREMENTAL", "MERGE", "BATCH", None, None, []),
                                   ("l2", "s9", "t1", "STREAMING", "APPEND", "DECLARATIVE", None, "ts", ["k"])],
                                  "load_id string, source_id string, target_id string, load_type string, "
                                  "load_pattern string, engine string, checkpoint_location string, "
                                  "watermark_column string, merge_keys array<string>")
    sources = spark.createDataFrame([("s1", "FILE", None, True, "PUBLIC")],
                                    "source_id string, source_type string, file_format string, pii_flag boolean, "
                                    "data_classification string")
    targets = spark.createDataFrame([("t1", "SILVER", ["d"], ["k"], 10, "RESTRICTED")],
                                    "target_id string, layer string, partition_columns array<string>, "
                                    "liquid_clustering_columns array<string>, retention_days int, "
                                    "data_classification string")
    v = {(r.entity_id, r.rule) for r in C.validate_config(sources, targets, loads).collect()}
    assert {("l1", "merge_needs_keys"), ("l1", "incremental_needs_watermark"), ("l2", "stream_needs_checkpoint"),
            ("l2", "fk_source"), ("s1", "file_needs_format"), ("s1", "pii_classification"),
            ("t1", "partition_xor_cluster"), ("t1", "retention_minimum")} <= v


def test_schema_compatibility():
    from pyspark.sql import types as T
    tgt = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    cfg = E.resolve_schema_evolution(E.EvolutionContext(layer="BRONZE"))
    r = E.validate_schema_compatibility(T.StructType([T.StructField("a", T.LongType()),
                                                      T.StructField("b", T.StringType()),
                                                      T.StructField("c", T.DoubleType())]), tgt, cfg)
    assert r.allowed and r.widened == ["a"] and r.added == ["c"]
    r = E.validate_schema_compatibility(T.StructType([T.StructField("a", T.ShortType()),
                                                      T.StructField("b", T.StringType())]), tgt, cfg)
    assert not r.allowed and r.requires_rebuild
    assert not E.is_widening(T.LongType(), T.DoubleType())
    r = E.validate_schema_compatibility(T.StructType([T.StructField("a", T.IntegerType()),
                                                      T.StructField("b2", T.StringType())]), tgt, cfg)
    assert r.suspected_renames == [("b", "b2")] and not r.allowed
    gold = E.resolve_schema_evolution(E.EvolutionContext(layer="GOLD", scd_type="0"))
    assert gold.mode == "none" and gold.require_approval and E.validate_config(gold) == []


def test_ops_helpers(spark):
    runs = spark.createDataFrame([("j", i, float(v)) for i, v in enumerate([10, 11, 9, 10, 10, 50, 10])],
                                 "job string, seq int, d double")
    a = {r.seq: r for r in O.anomalies(runs, ["job"], ["seq"], "d", k=5).collect()}
    assert a[2].zscore is None and a[5].is_anomaly and not a[6].is_anomaly
    drift = spark.createDataFrame([("j", 1, ["a", "b"]), ("j", 2, ["a", "c"])], "job string, seq int, cols array<string>")
    d = {r.seq: r for r in O.schema_drift(drift, ["job"], ["seq"], "cols").collect()}
    assert d[2].columns_added == ["c"] and d[2].columns_removed == ["b"] and d[1].first_run
    dec = spark.createDataFrame([("t1", "pending"), ("t1", "applied"), ("t2", "pending")],
                                "trace_id string, approval_status string")
    assert rows(O.unresolved_pending(dec), "trace_id") == [("t2",)]


def test_cost_projection_close_to_exact(spark):
    df = spark.range(1000).select(F.lit("c").alias("k"), (F.col("id") / 10).alias("u"))
    r = O.cost_projection(df, "k", "u", volume=10.0).first()
    assert abs(float(r.expected) - 10 * 49.95) < 10 and float(r.low) < float(r.expected) < float(r.high)


def test_ingestion_run_balances(spark, tmp_dir):
    from stratum.operators import quality as Q
    st = TableStore(spark, tmp_dir)
    ledger = RunLedger(spark, st, fallback_dir=os.path.join(tmp_dir, "fb"))
    src = spark.createDataFrame([(1, 5.0), (2, 500.0), (None, 1.0), (3, 7.0)], "id int, amount double")
    cfg = IngestionConfig("policy", "policy_silver", "SCD1", keys=["id"],
                          rules=[Q.Rule("rg", "RANGE", "amount", "0,100", action="QUARANTINE")])
    res = run_ingestion(spark, st, ledger, cfg, lambda: src)
    assert (res.rows_read, res.rows_written, res.rows_rejected, res.status) == (4, 2, 2, "SUCCESS")
    ev = ledger.events()
    folded = O.fold_runs(ev.where("status IS NOT NULL"), ts_col="event_ts").first()
    assert folded.status == "SUCCESS"
    assert st.read("policy_silver_quarantine").count() == 2
