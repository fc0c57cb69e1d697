"""Renames by content, explicit column contracts, and map access."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import maps as MP
from stratum.operators import evolve as E
from stratum.plans.ingestion import IngestionConfig, run_ingestion
from stratum.sinks.ledger import RunLedger
from stratum.sinks.store import TableStore

from .conftest import rows


def test_renames_are_found_by_their_values(spark):
    old = spark.range(2000).selectExpr("id", "concat('n', id) name", "cast(id % 40 as int) grade", "if(id % 2 = 0, null, concat('z', id)) half")
    # a small batch: moved, renamed, widened; an unrelated column of the same type; the same values but no NULLs
    new = spark.range(100, 160).selectExpr("concat('q', id) other", "cast(id % 40 as bigint) class", "concat('n', id) client", "id")
    assert E.renames_by_content(old, new) == [("grade", "class", 1.0), ("name", "client", 1.0)]
    assert E.renames_by_content(old, new.withColumn("again", F.col("client"))) == [("grade", "class", 1.0)]  # undecided
    assert E.renames_by_content(old, new.select("id", F.concat(F.lit("z"), F.col("id") * 2 + 1).alias("full"))) == []
    assert E.renames_by_content(old, new.where("id < 0")) == [] and E.renames_by_content(old.where("id < 0"), new) == []


def test_a_run_maps_a_moved_and_renamed_column(spark, tmp_dir):
    st = TableStore(spark, tmp_dir)
    led = RunLedger(spark, st)
    first = spark.range(50).selectExpr("cast(id as int) k", "concat('n', id) name", "concat('c', id % 5) city")
    second = spark.range(40, 60).selectExpr("concat('c', id % 5) town", "cast(id as int) k", "concat('n', id) name")
    ctx = E.EvolutionContext(renames_expected=True)
    assert E.resolve_schema_evolution(ctx).enable_column_mapping
    cfg = IngestionConfig("e", "t", "SCD1", keys=["k"], evolution=ctx, find_renames=True)
    assert run_ingestion(spark, st, led, cfg, lambda: first).status == "SUCCESS"
    assert run_ingestion(spark, st, led, cfg, lambda: second).status == "SUCCESS"
    got = st.read("t")
    assert set(got.columns) == {"k", "name", "city"} and got.count() == 60 and got.where("city is null").count() == 0


def test_contract_names_every_column(spark):
    contract = T._parse_datatype_string("a bigint, b string")
    df = spark.createDataFrame([("x", 1, 2.0)], "b string, a int, c double")
    with pytest.raises(E.ContractBreach, match="extra: c"):
        E.project_contract(df, contract)
    out = E.project_contract(df, contract, drop_extra=True)
    assert out.dtypes == [("a", "bigint"), ("b", "string")] and rows(out) == [(1, "x")]
    with pytest.raises(E.ContractBreach, match="missing: a; types: b double for string"):
        E.project_contract(df.select(F.col("c").alias("b")), contract)


def test_map_access(spark):
    df = spark.createDataFrame([({"a": "1", "b": None},), (None,), ({},)], "m map<string,string>")
    got = df.select(MP.map_get("m", "a").alias("a"), MP.map_get("m", "b", "-").alias("b"), MP.map_text(MP.map_with("m", {"a": "2", "c": "3"})).alias("t"))
    assert [tuple(r) for r in got.collect()] == [("1", "-", "a=2;b=;c=3"), (None, "-", "a=2;c=3"), (None, "-", "a=2;c=3")]
    assert spark.createDataFrame([("no json",), ('{"k": 1}',)], "t string").select(MP.map_get(MP.json_map("t"), "k").alias("k")).collect()[1].k == "1"
