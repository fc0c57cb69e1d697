"""Composite keys, watermark descents, arrival gaps, and uniqueness across micro-batches."""

import datetime as dt
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators import profile as PR
from stratum.streaming import streams as ST

from .conftest import rows


def test_the_only_key_is_two_columns(spark):
    df = spark.range(600).selectExpr("id div 20 a", "id % 20 b", "id % 7 c", "if(id = 5, null, id) d", "array(id) e")
    assert [r.column_set for r in PR.minimal_keys(df).collect()] == ["a,b"]
    three = spark.range(512).selectExpr("id % 8 a", "(id div 8) % 8 b", "id div 64 c")
    assert PR.minimal_keys(three).count() == 0
    assert [tuple(r) for r in PR.minimal_keys(three, max_size=3).collect()] == [("a,b,c", 512)]
    assert {r.column_set for r in PR.minimal_keys(spark.range(9).selectExpr("id", "id % 3 x")).collect()} == {"id"}


def test_top_values_are_exact_whatever_the_spread(spark):
    df = spark.range(60000).selectExpr(
        "cast(floor(pow(id + 1, 0.5)) as int) slope", "id % 3 few", "id key", "id % 20000 even", "if(id % 3 = 0, null, id % 2) gaps",
        "if(id % 9 = 0, concat('hot', id % 4), concat('cold', id)) heavy", "repeat(cast(id % 5 as string), 3000) long",
        "cast(null as string) none", "date'2024-01-01' + cast(id % 70 as int) day")
    got = {}
    for r in PR.top_values(df, df.columns, k=4).collect():
        got.setdefault(r.column_name, []).append((-r["count"], r.value is not None, r.value))
    for c in df.columns:
        top = df.groupBy(F.col(c).cast("string").alias("v")).count().orderBy(F.desc("count"), F.col("v").asc_nulls_first()).limit(4)
        assert sorted(got[c]) == sorted((-r["count"], r.v is not None, r.v) for r in top.collect()), c
    prof = {r.column_name: r for r in PR.profile(df, top=4).collect()}
    for c in df.columns:
        assert [(-x["count"], x.value is not None, x.value) for x in prof[c].top_values] == sorted(got[c]), c
    assert prof["gaps"].null_count == 20000 and prof["key"].p50 is not None
    nothing = PR.profile(df.where("id < 0"), top=2).collect()
    assert [r.top_values for r in nothing] == [[]] * len(df.columns) and PR.top_values(df.where("id < 0"), ["few"], 2).count() == 0
    assert {r.column_name: r.n_distinct for r in PR.distinct_counts(df, ["few", "even", "gaps", "none"]).collect()} == {
        "few": 3, "even": 20000, "gaps": 2, "none": 0}


def test_sketches_settle_heavy_columns_and_leave_even_ones(spark):
    df = spark.range(60000).selectExpr("if(id % 3 = 0, 7, id) heavy", "id % 20000 even", "id % 2 few")
    one = df.agg(*[PR._sketch(F.col(c).cast("string"), 1).alias(c) for c in df.columns]).first()
    assert PR._surely_top(one["even"], 60000, 1) is None
    assert len(PR._surely_top(one["few"], 60000, 3)) == 2 and PR._surely_top(one["heavy"], 60000, 1)
    assert PR._surely_top(one["heavy"], 60000, 2) is None


def test_descents_equal_a_plain_window_over_levels_of_chunks(spark):
    df = spark.range(5000).selectExpr(
        "id * 977 o", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id) up",
        "if(id % 3 = 0, null, date'2024-01-01' + cast(id div 700 - if(id in (2500, 2501, 4000), 2, 0) as int)) down", "cast(null as date) none")
    w = Window.orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    got = {r.column_name: (r.descents, r.is_candidate, r.null_count) for r in PR.candidate_watermarks(df, ["o"]).collect()}
    want = df.select("down", F.last("down", ignorenulls=True).over(w).alias("b")).where("down < b").count()
    assert got == {"up": (0, True, 0), "down": (want, False, 1667), "none": (0, False, 5000)} and want > 1
    by_time = PR.candidate_watermarks(df, ["up", "o"]).where("column_name = 'down'").first()
    assert by_time.descents == want
    assert PR.candidate_watermarks(df.where("o < 0"), ["o"]).where("descents > 0").count() == 0


def test_empty_windows_come_out_as_rows(spark):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    df = spark.createDataFrame([("a", at(1)), ("a", at(1, 30)), ("a", at(4, 59)), ("b", at(3)), (None, at(0)), (None, at(2)), ("c", None)], "f string, ts timestamp_ntz")
    got = {(r.f, r.window_start.hour, r.window_end.hour) for r in ST.arrival_gaps(df, "ts", "1 hour", ["f"]).collect()}
    assert got == {("a", 2, 3), ("a", 3, 4), (None, 1, 2)}
    assert {r.window_start.hour for r in ST.arrival_gaps(df, "ts", "1 hour").collect()} == set()


def test_repeats_are_found_across_batches_and_a_restart(spark, tmp_dir):
    schema = "k int, v string, ts timestamp_ntz"
    src, ck = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ck")
    got = {}

    def put(*r):
        spark.createDataFrame([(k, v, dt.datetime(2024, 1, 1, 0, m)) for k, v, m in r], schema).coalesce(1).write.mode("append").parquet(src)

    def drain():
        def keep(batch, _):
            got.update({r.v: r.is_repeat for r in batch.collect()})
        stream = ST.flag_repeats(ST.file_stream(spark, src, "parquet", schema), ["k"], "ts", "10 minutes")
        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination(120)

    put((1, "a1", 0), (1, "a2", 1), (2, "b1", 0), (None, "n1", 0), (None, "n2", 0))
    drain()
    put((1, "a3", 5), (3, "c1", 59))  # the watermark goes to 0:49
    drain()
    put((2, "b2", 58), (3, "c2", 58))  # key 2 was forgotten, key 3 was not
    drain()
    assert got == {"a1": False, "a2": True, "b1": False, "n1": False, "n2": False, "a3": True, "c1": False, "b2": False, "c2": True}
