import __spark_entry__ as E
from stratum.plans.catalog import load_all


def test_entry_runs_and_has_rows(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["tier", "c_mktsegment"]
    assert df.count() > 0


def test_registry_contract():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 100
    for name, entry in load_all().items():
        assert entry.ops, f"{name} names no survey operator"
        assert not name.startswith("op") and "pipeline" not in name


def test_small_query_matches_oracle(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = sorted(tuple(r) for r in E.queries()["scd1_customer"](spark, sf).collect())
    want = sorted(tuple(r) for r in con.execute(E.oracle_sql()["scd1_customer"]).fetchall())
    assert got == want
