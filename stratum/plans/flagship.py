"""Flagship slice (X6): ingest -> clean split -> history -> as-of join ->
reconcile -> mask -> Gold, as one lazy plan over the driver tables.

1. silver orders (enriched with creditworthy customers), data-quality rules
   applied; QUARANTINE failures are split off (Q10)
2. customer tier history rebuilt from yearly snapshots (W4)
3. each good order joined to the tier valid at its order date (J9)
4. losses per order from returned lines (partial aggregate)
5. Gold: premium, losses, loss ratio and claim frequency by tier and segment
   with subtotals (A18); customer names never leave the plan unmasked (M1)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history as H
from ..operators import masking as MK
from ..operators import quality as Q
from ..operators import transform as TR
from . import derived as D
from .catalog import Tables
from .queries_history import tier_history
from .queries_quality import AS_OF, RULES, line_total, _parents


def enriched_orders(t: Tables) -> DataFrame:
    good, _, _ = Q.apply_rules(D.silver_orders(t), RULES, _parents(t), as_of=AS_OF)
    good = good.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    hist = tier_history(t)
    j = H.join_asof_history(good, hist, {"o_custkey": "c_custkey"}, "o_orderdate")
    loss = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", line_total()).otherwise(F.lit(0))).alias("loss"),
        F.max(F.col("l_returnflag") == "R").alias("has_claim"))
    names = t.customer.select("c_custkey", MK.hash_mask("c_name", "s4lt").alias("c_name_hash"))
    return (j.join(loss, j.o_orderkey == loss.l_orderkey, "left")
            .join(names, j.o_custkey == names.c_custkey, "left")
            .select("o_orderkey", "c_name_hash", F.coalesce("tier", F.lit("NONE")).alias("tier"),
                    F.coalesce("c_mktsegment", F.lit("UNKNOWN")).alias("c_mktsegment"), "o_totalprice",
                    F.coalesce("loss", F.lit(0)).alias("loss"), F.coalesce("has_claim", F.lit(False)).alias("has_claim")))


def gold_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return TR.gold_summary(enriched_orders(t), ["tier", "c_mktsegment"], "o_totalprice", "loss", "has_claim")
