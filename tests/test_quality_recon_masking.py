import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratum.operators import masking as MK
from stratum.operators import quality as Q
from stratum.operators import quarantine as QR
from stratum.operators import recon as R

from .conftest import rows


def _df(spark):
    return spark.createDataFrame(
        [(1, "a@x.com", 10.0, "A"), (2, None, 50.0, "B"), (2, "bad", None, "Z"), (None, "c@y.org", 500.0, "A")],
        "id int, email string, amount double, code string")


def test_rule_null_semantics_and_counts(spark):
    rules = [Q.Rule("nn", "NOT_NULL", "email", threshold=0.5, action="WARN"),
             Q.Rule("uq", "UNIQUE", "id", threshold=1.0, action="FAIL"),
             Q.Rule("rg", "RANGE", "amount", "0,100", threshold=0.5, action="QUARANTINE"),
             Q.Rule("pt", "REGEX", "email", r"^[^@]+@[^@]+$", action="WARN", threshold=0.0),
             Q.Rule("iv", "IN", "code", values=("A", "B"), action="WARN", threshold=0.0),
             Q.Rule("cs", "CUSTOM", rule_expression="amount > 5", action="WARN", threshold=0.0)]
    res = {r.rule_id: r for r in Q.evaluate(_df(spark), rules).collect()}
    assert res["nn"].failed_count == 1            # NOT_NULL owns NULL
    assert res["uq"].failed_count == 2            # both rows of id 2; NULL id ignored
    assert res["rg"].failed_count == 1            # NULL passes RANGE
    assert res["pt"].failed_count == 1            # NULL passes PATTERN
    assert res["iv"].failed_count == 1
    assert res["cs"].failed_count == 1            # NULL fails CUSTOM_SQL
    assert not res["uq"].passed and res["nn"].passed
    good, bad, results = Q.apply_rules(_df(spark), rules)
    assert good.count() + bad.count() == 4 and bad.count() == 1
    assert bad.first()._dq_failed_rules == ["rg"]
    with pytest.raises(Q.DataQualityError):
        Q.enforce(results)


def test_empty_input_passes(spark):
    e = _df(spark).limit(0)
    r = Q.evaluate(e, [Q.Rule("nn", "NOT_NULL", "email", threshold=1.0)]).first()
    assert r.total_count == 0 and r.passed


def test_referential_and_freshness(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert Q.referential_orphans(child, parent, "p", "p").count() == 1
    ts = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert not Q.freshness(ts, "t", "2024-01-03 00:00:00", 86400).first().fresh
    assert Q.freshness(ts, "t", "2024-01-01 12:00:00", 86400).first().fresh


def test_balance_examples(spark):
    df = spark.createDataFrame([(10000.0, 9990.0), (10000.0, 9980.0), (0.0, 500.0), (0.0, 0.0)], "s double, t double")
    df = df.select(F.col("s").cast("decimal(38,2)").alias("source_value"),
                   F.col("t").cast("decimal(38,2)").alias("target_value"))
    b1 = R.balance(df, tolerance_percent=1.0).collect()
    assert [str(r.variance_percent) for r in b1[:2]] == ["0.1000", "0.2000"]
    assert b1[0].balanced and b1[1].balanced and not b1[2].balanced and b1[3].balanced
    b2 = R.balance(df, tolerance_percent=0.01).collect()
    assert not b2[1].balanced                      # 0.2 % > 0.01 % (percent points)
    assert b1[2].variance_percent is None


def test_recon_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, m double")
    b = spark.createDataFrame([(1, 1.0), (2, 2.5), (4, 4.0)], "k int, m double")
    got = {r.k: r.status for r in R.recon_keys(a, b, ["k"], ["m"]).collect()}
    assert got == {1: "MATCH", 2: "DIFFERENT", 3: "MISSING_IN_TARGET", 4: "MISSING_IN_SOURCE"}


def test_quarantine_helpers(spark):
    df = _df(spark)
    clean, bad = QR.split_missing_keys(df, ["id"])
    assert clean.count() == 3 and bad.count() == 1
    st1 = QR.stamp(bad, "MISSING_KEY", "run1", "x" * 5000, ts="2024-01-01 00:00:00").first()
    st2 = QR.stamp(bad, "MISSING_KEY", "run1", "", ts="2024-01-01 00:00:00").first()
    assert st1.quarantine_id == st2.quarantine_id and len(st1.reason_detail) == 5000
    assert str(st1.quarantine_date) == "2024-01-01"
    ok, bad = QR.safe_cast(spark.createDataFrame([("1",), ("x",), (None,)], "v string"), {"v": "int"})
    assert ok.count() == 2 and bad.count() == 1
    wide = df.withColumn("extra1", F.lit(None).cast("string")).withColumn("extra2", F.lit("e"))
    clean, q = QR.capture_drift(wide, df.columns)
    assert clean.columns == df.columns and q.count() == 4
    assert q.first()._rescued_data == '{"extra1":null,"extra2":"e"}'
    many = df.select("*", *[F.lit(i).alias(f"x{i}") for i in range(205)])
    assert len(json.loads(QR.capture_drift(many, df.columns)[1].first()._rescued_data)) == 205
    _, q2 = QR.capture_drift(wide.drop("extra2"), df.columns, only_populated=True)
    assert q2.count() == 0
    back = QR.replay(QR.stamp(q, "SCHEMA_DRIFT", "r"), "SCHEMA_DRIFT", rescued_schema="extra1 string")
    assert "extra1" in back.columns and back.count() == 4


def test_masks(spark):
    df = spark.createDataFrame([("123-45-6789", "alice"), (None, "bo")], "ssn string, name string")
    out = MK.apply_masks(df, [{"column": "ssn", "technique": "HASH", "salt": "s"},
                              {"column": "name", "technique": "PARTIAL", "keep": 2}]).collect()
    assert out[0].ssn is not None and len(out[0].ssn) == 64 and out[1].ssn is None
    assert [r.name for r in out] == ["***ce", "**"]
    vault = MK.build_vault(df, "name", "s")
    tok = MK.tokenize(df, "name", "s")
    back = MK.detokenize(tok, vault, "name", out="clear")
    assert rows(back, "clear") == [("alice",), ("bo",)]
    v = MK.column_mask_view(df, [{"column": "name", "technique": "REDACT", "exempt_groups": ["hr"]}], ["hr"])
    assert rows(v, "name") == [("alice",), ("bo",)]
    text = spark.createDataFrame([("mail a.b@c.com or (555) 123-4567, card 4111 1111 1111 1111",)], "t string")
    assert text.select(MK.redact_text("t")).first()[0] == "mail [EMAIL] or [PHONE], card [CARD]"
    assert MK.classify_by_name(["c_name", "tax_id", "amount"]) == [("c_name", "name", "CONFIDENTIAL"),
                                                                  ("tax_id", "tax_id", "RESTRICTED")]


def test_card_checksum_and_name_hints(spark):
    df = spark.createDataFrame([("4111 1111 1111 1111 and 4111 1111 1111 1112", "12-3456789", "born: 1980-02-03")], "t string, tax_id string, note string")
    assert df.select(F.size(MK.valid_cards("t"))).first()[0] == 1
    got = {(r.column_name, r.detector): r.classification
           for r in MK.classify_pii(df, detectors=tuple(MK.DETECTORS), name_hints=True).collect()}
    assert got[("tax_id", "EIN")] == "RESTRICTED" and got[("note", "DOB")] == "CONFIDENTIAL"
    assert got[("tax_id", "NAME:tax_id")] == "RESTRICTED"
    cat = MK.classify_pii(df, detectors=tuple(MK.DETECTORS))
    assert MK.search_catalog(cat, "tax").count() == 1 and MK.search_catalog(cat, classification="confidential").count() == 1


def test_a_lost_row_never_balances(spark):
    big = spark.range(3_000_000)
    rule = R.ReconRule("r", "ROW_COUNT", big, spark.range(2_999_999), on_break="FAIL")
    out = R.reconcile(rule)
    assert not out.first().balanced
    with pytest.raises(R.ReconBreak):
        R.enforce_recon(out)
    at = lambda s, t, tol: R.balance(spark.createDataFrame([(Decimal(s), Decimal(t))], "source_value decimal(38,2), target_value decimal(38,2)"),
                                      tolerance_percent=tol).first().balanced
    assert at("100.00", "99.00", 1.0) and not at("100.00", "98.99", 1.0) and not at("0", "0.01", 5.0) and at("0", "0", 0.0)
    assert at("-100", "-101", 1.0) and not at("1000000000000000000000000000000", "999999999999999999999999999999.99", 0.0)
    assert at("3000000", "2999999", 7 * 0.01)  # a share that binary fractions don't hold
    # hash totals are equal or not, at any tolerance
    a, b = spark.createDataFrame([("x",)], "h string"), spark.createDataFrame([("y",)], "h string")
    assert not R.reconcile(R.ReconRule("h", "HASH_TOTAL", a, b, hash_columns=["h"], tolerance=1.0)).first().balanced


def test_money_is_summed_before_it_is_rounded(spark):
    from stratum.operators import ops as O
    c = spark.range(1000).select(F.lit("d").alias("day"), F.lit(0.004).alias("cost"))
    assert {str(r.total_cost) for r in O.cost_rollup(c, ["day"]).collect()} == {"4.00"}
    days = spark.createDataFrame([("j", "2024-01-0%d" % i, 0.004) for i in range(1, 6)], "j string, d string, c double").withColumn("d", F.col("d").cast("date"))
    assert [r.breached for r in O.budget_breaches(days, "j", "d", "c", 0.01).orderBy("d").collect()] == [False, False, True, True, True]
