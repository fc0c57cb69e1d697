"""Standardisation functions (F5-F8) as Column expressions.

They are plain Spark SQL expressions, so they also register as SQL functions
(``register_sql_functions``) for SQL transforms without a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def phone_e164(c, default_country: str = "1") -> Column:
    """Digits only; 10 digits get the default country code: ``+1-743-555-3824``."""
    d = F.regexp_replace(_c(c), r"[^0-9]", "")
    full = F.when(F.length(d) == 10, F.concat(F.lit(default_country), d)).otherwise(d)
    n = F.length(full)
    return F.when(n < 11, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("+"), F.substring(full, 1, n - 10), F.lit("-"), F.substring(full, -10, 3), F.lit("-"),
                 F.substring(full, -7, 3), F.lit("-"), F.substring(full, -4, 4)))


def normalize_address(c) -> Column:
    """Struct in, struct out (F6): trimmed, upper-case, single spaces,
    postal code without spaces."""
    a = _c(c)

    def clean(x):
        return F.nullif(F.upper(F.regexp_replace(F.trim(x), r"\s+", " ")), F.lit(""))
    return F.struct(clean(a["line1"]).alias("line1"), clean(a["line2"]).alias("line2"),
                    clean(a["city"]).alias("city"), clean(a["state"]).alias("state"),
                    F.regexp_replace(clean(a["postal_code"]), " ", "").alias("postal_code"),
                    clean(a["country"]).alias("country"))


def parse_policy_number(c) -> Column:
    """``PREFIX#NNNN`` / ``PREFIX-NNNN`` -> struct(prefix, number, normalized)."""
    v = F.trim(_c(c))
    pattern = r"^([A-Za-z]+)[#-]?0*([0-9]+)$"
    prefix = F.nullif(F.upper(F.regexp_extract(v, pattern, 1)), F.lit(""))
    num = F.nullif(F.regexp_extract(v, pattern, 2), F.lit(""))
    return F.struct(prefix.alias("prefix"), num.cast("bigint").alias("number"),
                    F.when(prefix.isNotNull(), F.concat(prefix, F.lit("-"), F.lpad(num, 9, "0"))).alias("normalized"))


def parse_bool(c) -> Column:
    """Text booleans: true/1/yes/y/t (F8)."""
    v = F.lower(F.trim(_c(c).cast("string")))
    return F.when(v.isNull(), F.lit(None)).otherwise(v.isin("true", "1", "yes", "y", "t"))


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(_c(c)), F.lit(""))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the standardisers callable from SQL transforms (SQL functions,
    evaluated inside codegen like any built-in)."""
    # the same rule as the Column form: ten digits get the country code, fewer than eleven with it are no number
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION phone_e164(p STRING) RETURNS STRING RETURN
      SELECT CASE WHEN length(d) < 11 THEN NULL ELSE concat('+', substr(d, 1, length(d) - 10), '-', substr(d, -10, 3), '-',
               substr(d, -7, 3), '-', substr(d, -4, 4)) END
      FROM (SELECT CASE WHEN length(n) = 10 THEN concat('1', n) ELSE n END AS d
            FROM (SELECT regexp_replace(p, '[^0-9]', '') AS n))""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION blank_to_null(s STRING) RETURNS STRING RETURN
      nullif(trim(s), '')""")
