import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators import config as C
from stratum.operators import evolve as E
from stratum.operators import lineage as L
from stratum.operators import quarantine as QR
from stratum.sinks import store as SK
from stratum.sinks.ledger import RunLedger
from stratum.streaming import streams as ST

from .conftest import rows


def test_config_lookups_and_feed_file(spark, tmp_dir):
    src = spark.createDataFrame([("src_policy_mainframe", "FILE", "CSV", "policy", True),
                                 ("src_old", "FILE", "CSV", "policy", False)],
                                "source_id string, source_type string, file_format string, business_domain string, "
                                "active_flag boolean")
    assert C.lookup(src, "source_id", "src_policy_mainframe")["file_format"] == "CSV"
    with pytest.raises(C.ConfigNotFound, match="src_policy_mainframe"):
        C.lookup(src, "source_id", "src_old")                 # inactive -> not found, hint lists ids
    assert C.list_where(src, business_domain="POLICY").count() == 1
    tgt = spark.createDataFrame([("t1", "main", "bronze", "policy")],
                                "target_id string, catalog_name string, schema_name string, table_name string")
    assert C.target_by_fqn(tgt, "main", "bronze", "policy").count() == 1
    feed = {"source": {"source_id": "s"}, "target_silver": {"target_id": "tgt_silver_policy"},
            "dq_rules": [{"dq_rule_id": "r1", "rule_type": "NOT_NULL", "column_name": "policy_number",
                          "threshold_percent": 1.0, "on_failure": "FAIL"},
                         {"dq_rule_id": "r2", "rule_type": "UNIQUE", "column_name": "policy_number",
                          "threshold_percent": 0.99, "on_failure": "QUARANTINE"}]}
    p = os.path.join(tmp_dir, "policy.json")
    with open(p, "w") as f:
        json.dump(feed, f, indent=2)
    rules = C.feed_rules(C.read_feed(spark, p))
    assert rows(rules, "dq_rule_id", "on_failure") == [("r1", "FAIL"), ("r2", "QUARANTINE")]
    from stratum.operators.quality import rule_from_row
    r = rule_from_row(rules.where("dq_rule_id = 'r2'").first().asDict())
    assert r.rule_type == "UNIQUE" and r.threshold == 0.99 and r.action == "QUARANTINE"


def test_sinks(spark, tmp_dir):
    st = SK.TableStore(spark, tmp_dir)
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "id int, month string")
    st.overwrite_partitions("p", df, ["month"])
    st.overwrite_partitions("p", spark.createDataFrame([(3, "2024-01")], "id int, month string"), ["month"])
    assert rows(st.read("p"), "id", "month") == [(2, "2024-02"), (3, "2024-01")]
    d = spark.createDataFrame([("2024-01-01",), ("2023-01-01",)], "d string").select(F.col("d").cast("date"))
    assert SK.retention_filter(d, "d", "2024-06-01", 365).count() == 1
    lay = SK.layout(df, cluster_columns=["id"], num_partitions=2)
    assert lay.rdd.getNumPartitions() == 2
    with pytest.raises(ValueError):
        SK.layout(df, ["month"], ["id"])
    ddl = SK.create_table_ddl("main.silver.policy", df, ["month"])
    assert "PARTITIONED BY (month)" in ddl and "`id` INT" in ddl
    r = SK.write_files(df, os.path.join(tmp_dir, "csv"), "csv", mode="overwrite", options={"header": "true"})
    assert r.num_output_rows == 2
    SK.create_view(df, "policy_view")
    assert spark.table("policy_view").count() == 2
    assert QR.quarantine_table_name("main", "silver", "policy") == "main.silver.policy_quarantine"


def test_stream_helpers(spark, tmp_dir):
    inferred = T.StructType([T.StructField("claim_id", T.StringType()), T.StructField("amount", T.StringType())])
    hinted = ST.apply_schema_hints(inferred, "amount DOUBLE, claim_date DATE")
    assert [f.dataType.simpleString() for f in hinted.fields] == ["string", "double", "date"]
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    on_time, late = QR.late_rows(ev, "ts", "2024-01-15 00:00:00")
    assert on_time.count() + late.count() == ev.count() and late.count() > 0
    src = os.path.join(tmp_dir, "in")
    ev.repartition(3).write.parquet(src)
    rec = ST.ProgressRecorder()
    spark.streams.addListener(rec)
    try:
        q = ST.append_stream(ST.file_stream(spark, src, "parquet", ev.schema, max_files_per_trigger=1),
                             os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"), trigger="availableNow")
        q.awaitTermination(120)
        q.processAllAvailable()
    finally:
        spark.streams.removeListener(rec)
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).count() == ev.count()


def test_rename_mapping_and_dropped_column(spark):
    target = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("status", T.StringType()),
                           T.StructField("legacy", T.StringType())])
    batch = spark.createDataFrame([(1, "A")], "id long, policy_status string")
    out = E.align_to(batch, target, renames={"policy_status": "status"})
    r = out.first()
    assert out.schema["id"].dataType == T.LongType() and r.status == "A" and r.legacy is None


def test_ledger_fallback_and_reload(spark, tmp_dir):
    fb = os.path.join(tmp_dir, "fallback")
    good = SK.TableStore(spark, os.path.join(tmp_dir, "store"))

    class Broken(SK.TableStore):
        def append(self, *a, **k):
            raise OSError("ledger unavailable")

    broken = RunLedger(spark, Broken(spark, tmp_dir), fallback_dir=fb)
    h = broken.start_run("ingestion", "policy")
    broken.end_run(h, "SUCCESS", {"rows_read": 10})
    assert broken.degraded and len(os.listdir(fb)) == 2
    ok = RunLedger(spark, good, fallback_dir=fb)
    assert ok.reload_fallback() == 2
    assert rows(ok.events(), "event_type") == [("END",), ("START",)]


def test_workflow_graph_and_column_lineage(spark):
    loads = spark.createDataFrame([("l1", "s1", "t1")], "load_id string, source_id string, target_id string")
    sources = spark.createDataFrame([("s1", "mainframe", "FILE")], "source_id string, source_name string, source_type string")
    targets = spark.createDataFrame([("t1", "BRONZE", "main", "bronze", "policy")],
                                    "target_id string, layer string, catalog_name string, schema_name string, table_name string")
    g = C.workflow_graph(loads, sources, targets, "l1").first()
    assert (g.source_name, g.layer, g.table_name) == ("mainframe", "BRONZE", "policy")
    maps = spark.createDataFrame([("gold.summary.premium", ["silver.policy.premium_amount"]),
                                  ("silver.policy.premium_amount", ["bronze.policy.prem", "bronze.policy.cur"])],
                                 "target_column string, source_columns array<string>")
    lin = {(r.node, r.ancestor): r.depth for r in L.column_lineage(maps).collect()}
    assert lin[("gold.summary.premium", "bronze.policy.prem")] == 2 and len(lin) == 5
