"""Inputs derived from the driver tables, in Spark and as SQL text.

The driver tables are clean and static, so change, history and dirt are
derived from them by value rules over whole tables (never id subsets):

* **Customer snapshots** – customers with at least one order before a cut
  date (day 1), and those with one from it on (day 2), with the spend of
  those orders (exact DECIMAL sum of ``o_totalprice``) and a tier from the
  spend. Every order counts on one of the days. The two give new keys, vanished
  keys and changed tiers; spend changes for nearly every key but is not tracked
  by the SCD2 examples, which exercises the tracked-column subset.
* **Silver orders** – orders enriched with the segment of creditworthy
  customers (``c_acctbal >= 0``); orders of the others get NULL enrichment,
  which the data-quality rules then find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash_sql

# Fixed values of the derived examples.
TIER_GOLD = 700000
TIER_SILVER = 300000
HALF_GOLD, HALF_SILVER = 1500000, 800000
CUT = "2000-01-01 00:00:00"
T1 = "2000-01-01 00:00:00"   # batch instant of the day-1 load
T2 = "2001-01-01 00:00:00"   # batch instant of the day-2 load
SNAP_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "tier", "spend"]
SNAP_KEYS = ["c_custkey"]
SNAP_TRACKED = ["c_name", "c_nationkey", "c_mktsegment", "tier"]


def day_orders(orders: DataFrame, day: int) -> DataFrame:
    cut = F.lit(CUT).cast("timestamp_ntz")
    return orders.where(F.col("o_orderdate") < cut if day == 1 else F.col("o_orderdate") >= cut)


def day_filter_sql(day: int) -> str:
    return f"o_orderdate {'<' if day == 1 else '>='} TIMESTAMP '{CUT}'"


def tier_expr(spend) -> F.Column:
    return (F.when(spend >= TIER_GOLD, "GOLD").when(spend >= TIER_SILVER, "SILVER").otherwise("BRONZE"))


def customer_day(customer: DataFrame, orders: DataFrame, day: int) -> DataFrame:
    spend = (day_orders(orders, day).groupBy("o_custkey")
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend")))
    tier = F.when(F.col("spend") >= HALF_GOLD, "GOLD").when(F.col("spend") >= HALF_SILVER, "SILVER").otherwise("BRONZE")
    return (customer.join(spend, customer.c_custkey == spend.o_custkey)
            .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", tier.alias("tier"),
                    F.col("spend").cast("decimal(18,2)").alias("spend")))


def customer_day_sql(day: int) -> str:
    return f"""SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
  CASE WHEN s.spend >= {HALF_GOLD} THEN 'GOLD' WHEN s.spend >= {HALF_SILVER} THEN 'SILVER' ELSE 'BRONZE' END AS tier,
  CAST(s.spend AS DECIMAL(18,2)) AS spend
FROM customer c JOIN (
  SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders
  WHERE {day_filter_sql(day)} GROUP BY o_custkey) s ON c.c_custkey = s.o_custkey"""


def day1(t) -> DataFrame:
    return customer_day(t.customer, t.orders, 1)


def day2(t) -> DataFrame:
    return customer_day(t.customer, t.orders, 2)


DAYS_SQL = f"d1 AS ({customer_day_sql(1)}),\nd2 AS ({customer_day_sql(2)})"
SNAP_HASH_SQL = row_hash_sql(SNAP_TRACKED)


def customer_years(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Tier of every customer in every year it ordered, stamped at year start."""
    spend = (orders.groupBy("o_custkey", F.year("o_orderdate").alias("yr"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend")))
    return (customer.join(spend, customer.c_custkey == spend.o_custkey)
            .select("c_custkey", "c_mktsegment", tier_expr(F.col("spend")).alias("tier"),
                    F.make_timestamp_ntz(F.col("yr"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
                     .alias("as_of")))


CUSTOMER_YEARS_SQL = f"""SELECT c.c_custkey, c.c_mktsegment,
  CASE WHEN s.spend >= {TIER_GOLD} THEN 'GOLD' WHEN s.spend >= {TIER_SILVER} THEN 'SILVER' ELSE 'BRONZE' END AS tier,
  make_timestamp(s.yr, 1, 1, 0, 0, 0) AS as_of
FROM customer c JOIN (
  SELECT o_custkey, year(o_orderdate) AS yr, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
  FROM orders GROUP BY o_custkey, year(o_orderdate)) s ON c.c_custkey = s.o_custkey"""


def silver_orders(t) -> DataFrame:
    good = t.customer.where(F.col("c_acctbal") >= 0).select("c_custkey", "c_mktsegment")
    return t.orders.join(good, t.orders.o_custkey == good.c_custkey, "left")


SILVER_ORDERS_SQL = """SELECT o.*, c.c_custkey, c.c_mktsegment FROM orders o
LEFT JOIN (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0) c ON o.o_custkey = c.c_custkey"""
