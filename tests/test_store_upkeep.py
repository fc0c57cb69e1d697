"""Replacing, compacting and purging tables; one run of a type 2 merge."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stratum.operators import history as H
from stratum.session import cut_lineage
from stratum.sinks import store as SK
from stratum.sinks.ledger import RunLedger

from .conftest import rows


def _files(folder):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(folder) for f in names)


def test_a_replacement_is_whole_or_not_at_all(spark, tmp_dir):
    st = SK.TableStore(spark, tmp_dir)
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    st.replace("s/t", old)
    fails = old.withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("k")).cast("int"))
    with pytest.raises(Exception, match="no"):
        st.replace("s/t", fails)
    assert rows(st.read("s/t")) == [(1, "a"), (2, "b")]
    st.replace("s/t", st.read("s/t").where("k = 1").withColumn("n", F.lit(7)))  # reads what it replaces
    assert rows(st.read("s/t")) == [(1, "a", 7)]
    st.replace("s/t", st.read("s/t").limit(0))
    assert st.read("s/t").count() == 0 and sorted(os.listdir(f"{tmp_dir}/s")) == ["t"]


def test_a_replacement_cut_off_between_its_renames_is_finished_or_undone(spark, tmp_dir):
    st = SK.TableStore(spark, tmp_dir)
    one, two = (spark.createDataFrame([(k,)], "k int") for k in (1, 2))
    for ready in (True, False):
        st.replace("t", one)
        st.replace("other", two)
        os.rename(f"{tmp_dir}/t", f"{tmp_dir}/.t.prev")
        os.rename(f"{tmp_dir}/other", f"{tmp_dir}/.t.next")
        if not ready:  # data without the schema: the write hadn't ended
            os.remove(f"{tmp_dir}/.t.next/{SK.SCHEMA_FILE}")
        assert rows(st.read("t")) == [(2,) if ready else (1,)] and not os.path.exists(f"{tmp_dir}/.t.prev")
        st.replace("t", one)
        assert rows(st.read("t")) == [(1,)] and sorted(os.listdir(tmp_dir)) == ["t"]


def test_compacting_keeps_rows_partitions_and_schema(spark, tmp_dir):
    st = SK.TableStore(spark, tmp_dir)
    for k in range(6):
        st.append("t", spark.createDataFrame([(k, "007"), (k, ""), (k, None)], "k int, p string"), ["p"])
    before = rows(st.read("t").selectExpr("k", "coalesce(p, 'none') p"))
    assert st.compact("t").num_output_rows == 18 and st.read("t").schema["p"].dataType.simpleString() == "string"
    assert rows(st.read("t").selectExpr("k", "coalesce(p, 'none') p")) == before and _files(st.path("t")) == 3
    st.append("t", spark.createDataFrame([(9, "010")], "k int, p string"), ["p"])
    assert st.read("t").count() == 19 and st.compact("nothing").num_output_rows == 0
    ledger = RunLedger(spark, st)
    for _ in range(3):
        ledger.end_run(ledger.start_run("c", "e"), "SUCCESS", {"rows_read": 1})
    assert _files(st.path("ledger_events")) >= 6
    assert ledger.compact() == 6 and _files(st.path("ledger_events")) == 1 and ledger.events().count() == 6


@pytest.mark.parametrize("parts", [[], ["d"], ["text_day"], ["grp"], ["grp", "d"]])
def test_purge_deletes_expired_rows_only(spark, tmp_dir, parts):
    st = SK.TableStore(spark, tmp_dir)
    day = dt.date(2024, 6, 1)
    data = [(i, day - dt.timedelta(days=10 * i), f"g {i % 3}") for i in range(12)] + [(50, None, "g 0"), (51, None, None), (52, day.replace(year=2000), "old: %")]
    df = spark.createDataFrame(data, "id int, d date, grp string").withColumn("text_day", F.coalesce(F.col("d").cast("string"), F.lit("unknown")))
    st.replace("t", df, parts)
    column = "text_day" if parts == ["text_day"] else "d"
    r = st.purge("t", column, 60, "2024-06-01")
    assert r["rows_deleted"] == 6 and rows(st.read("t"), "id") == [(i,) for i in (0, 1, 2, 3, 4, 5, 6, 50, 51)]
    assert st.read("t").schema["grp"].dataType.simpleString() == "string"
    assert st.purge("t", column, 60, "2024-06-01")["rows_deleted"] == 0
    st.append("t", df.where("id = 52"), parts)
    assert st.purge("t", column, 2555, "2024-06-01", "CONFIDENTIAL")["rows_deleted"] == 1
    with pytest.raises(ValueError, match="2555"):
        st.purge("t", column, 60, "2024-06-01", "CONFIDENTIAL")


def test_purge_of_a_table_merged_by_keys_rewrites_the_buckets_it_touches(spark, tmp_dir):
    st = SK.TableStore(spark, tmp_dir)
    df = spark.range(200).selectExpr("id", "date'2024-01-01' + cast(id as int) d")
    st.replace("t", df, keys=["id"])
    files = spark.read.parquet(st.path("t")).selectExpr("_metadata.file_path f", "id", "key_bucket__ b").groupBy("b").agg(F.min("id").alias("m"), F.collect_set("f").alias("fs"))
    untouched = {f for r in files.where("m >= 10").collect() for f in r.fs}
    assert st.purge("t", "d", 30, "2024-02-10")["rows_deleted"] == 10 and st.read("t").count() == 190
    after = {r.f for r in spark.read.parquet(st.path("t")).selectExpr("_metadata.file_path f").distinct().collect()}
    assert untouched and untouched <= after
    st.merge("t", lambda cur: cur.where("id <> 20"), ["id"], df.where("id = 20"))
    assert st.read("t").count() == 189


def test_history_metrics_and_late_rows_come_from_one_join(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 9)], "k int, v string, h int")
    batch = spark.createDataFrame([(1, "A", 5), (2, "b", 5), (3, "C", 2), (4, "d", 5), (4, "d2", 4), (None, "x", 5)], "k int, v string, h int")
    at = [df.withColumn("ts", F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.col("h"), F.lit(0), F.lit(0.0))).drop("h") for df in (old, batch)]
    target = cut_lineage(H.scd2_merge(None, at[0], ["k"], "2024-01-01 00:00:00", ["v"], event_ts_col="ts").history)
    calls = []

    def once(df):
        calls.append(df)
        return cut_lineage(df)

    args = (target, at[1], ["k"], "2024-01-02 00:00:00", ["v"], None, "ts")
    plain, cut = H.scd2_merge(*args), H.scd2_merge(*args, once)
    assert len(calls) == 1
    for name in ("history", "metrics", "rejects"):
        a, b = getattr(plain, name), getattr(cut, name)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    assert "FullOuter" in plain.history._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in cut.history._jdf.queryExecution().executedPlan().toString()
    assert rows(cut.rejects, "reject_reason") == [("DUP_KEY",), ("LATE_DATA",), ("MISSING_KEY",)]
