"""The workflow graph, load stamps of EAV rows, and harmonisation runs that load."""

import pytest
from pyspark.sql import functions as F

from stratum.operators import config as C
from stratum.operators import quality as Q
from stratum.plans.ingestion import IngestionConfig, run_harmonization_load
from stratum.sinks.ledger import RunLedger
from stratum.sinks.store import TableStore

from .conftest import rows


def test_workflow_edges_with_transforms_and_dependencies(spark):
    loads = spark.createDataFrame([("l1", "s1", "b1", True), ("l2", "s2", "b2", True), ("l3", "s3", "b3", False)],
                                  "load_id string, source_id string, target_id string, active_flag boolean")
    tr = spark.createDataFrame([("x1", "b1", "v1", ["l2"], True), ("x2", "v1", "g1", None, None), ("x9", "b1", "z", None, False)],
                               "transform_id string, source_target_id string, destination_target_id string, dependencies array<string>, active_flag boolean")
    dep = spark.createDataFrame([("LOAD", "l2", "l1", True), ("TRANSFORM", "x2", "nobody", True), ("LOAD", "l1", "x1", False)],
                                "object_type string, object_id string, depends_on_id string, active_flag boolean")
    flow = {("SOURCE:s1", "LOAD:l1", "READS"), ("LOAD:l1", "TARGET:b1", "WRITES"), ("TARGET:b1", "TRANSFORM:x1", "READS"),
            ("TRANSFORM:x1", "TARGET:v1", "WRITES"), ("TARGET:v1", "TRANSFORM:x2", "READS"), ("TRANSFORM:x2", "TARGET:g1", "WRITES"),
            ("LOAD:l1", "LOAD:l2", "DEPENDS"), ("LOAD:l2", "TRANSFORM:x1", "DEPENDS"), ("LOAD:l2", "TARGET:b2", "WRITES")}
    other = {("SOURCE:s2", "LOAD:l2", "READS")}
    assert {tuple(r) for r in C.workflow_edges(loads, tr, dep).collect()} == flow | other
    assert {tuple(r) for r in C.workflow_edges(loads, tr, dep, "l1").collect()} == flow
    assert C.workflow_edges(loads).count() == 4 and C.workflow_edges(loads.limit(0), tr.limit(0), dep.limit(0)).count() == 0


def test_load_stamps_are_no_values(spark):
    df = spark.createDataFrame([(1, "x")], "job int, name string")
    eav = C.to_param_rows(df, "job", "cfg", eff_ts="2024-01-01 00:00:00", load_user="ann")
    assert eav.first().LOAD_USER == "ann" and eav.first().LOAD_DTS is not None
    again = C.to_param_rows(df, "job", "cfg", load_ts="2025-01-01 00:00:00", load_user="ben")
    keys = ["JOB_SK", "PARAM_ZONE", "PARAM_NM"]
    assert C.save_version(eav, again, keys, "2024-02-01 00:00:00").count() == 1
    v2 = C.save_version(eav, again.withColumn("PARAM_VAL", F.lit("y")), keys, "2024-02-01 00:00:00")
    assert rows(v2, "REC_VER_NO", "LOAD_USER") == [(1, "ann"), (2, "ben")]
    bare = again.withColumn("PARAM_VAL", F.lit("y")).drop("LOAD_USER", "LOAD_DTS")
    assert C.save_version(eav, bare, keys, "2024-02-01 00:00:00").where("REC_VER_NO = 2").first().LOAD_USER is not None


def test_harmonisation_loads_what_its_rules_pass(spark, tmp_dir):
    st = TableStore(spark, tmp_dir, buckets=4)
    ledger = RunLedger(spark, st)
    st.append("bronze/p", spark.createDataFrame([(1, " a "), (2, "b"), (3, "c"), (None, "d")], "k int, v string"))
    known = spark.createDataFrame([(1,), (2,)], "k int")
    cfg = IngestionConfig("p", "silver/p", "SCD2", keys=["k"], batch_ts="2024-01-01 00:00:00", rules=[
        Q.Rule("fk", "REFERENTIAL", "k", parent="known", parent_column="k", action="QUARANTINE", threshold=0.0)])
    sql = "SELECT k, trim(v) AS v FROM {p}"
    run = lambda: run_harmonization_load(spark, st, ledger, cfg, sql, {"p": "bronze/p"},
                                         lambda df: df.withColumn("v", F.upper("v")), {"known": known})
    r = run()
    assert (r.status, r.rows_read, r.rows_written, r.rows_rejected) == ("SUCCESS", 4, 2, 2)
    assert rows(st.read("silver/p"), "k", "v", "__is_current") == [(1, "A", True), (2, "B", True)]
    assert run().status == "SUCCESS" and st.read("silver/p").count() == 2
    with pytest.raises(ValueError, match="no such input"):
        run_harmonization_load(spark, st, ledger, cfg, sql, {"p": "bronze/none"})
