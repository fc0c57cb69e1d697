"""Masking, tokenisation and personal-data classification.

All masks are column expressions (codegen, no Python per row). Tokens are
hash-derived, so tokenising needs no lookup; the vault (distinct value ->
token) exists only for reversal and is joined, never collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TECHNIQUES = ("HASH", "TOKENIZE", "REDACT", "PARTIAL", "UC_COLUMN_MASK", "ROW_FILTER")

# Fixed detector patterns (written for both Java regex and RE2, without \b,
# whose meaning differs between the two on non-ASCII letters).
DETECTORS = {
    "EIN": r"\b[0-9]{2}-[0-9]{7}\b",
    "DOB": r"(?i)\b(?:dob|born|date of birth)\W{1,3}[0-9]{4}-[0-9]{2}-[0-9]{2}\b",
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "SECRET": r"(?i)(api[_-]?key|secret|token|password)\s*[:=]\s*\"?[A-Za-z0-9_\-]{8,}\"?",
    "CARD": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "SSN": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "PHONE": r"(\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}",
    "IPV4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
}
# A detector can only match text that contains its trigger; the cheap test
# skips the regex on most rows. Tags written by redaction contain no trigger of
# a later detector (the only digit, in [IPV4], comes last).
_KEYWORDS = ("api", "secret", "token", "password")


def _guard(detector: str, c: Column) -> Column:
    if detector == "EMAIL":
        return c.contains("@")
    if detector == "SECRET":
        low = F.lower(c)
        cond = F.lit(False)
        for k in _KEYWORDS:
            cond = cond | low.contains(k)
        return cond
    return c.rlike("[0-9]")


# Redaction order: longer, more specific spans first.
REDACT_ORDER = ["EMAIL", "SECRET", "CARD", "SSN", "PHONE", "IPV4"]
#: What text columns are searched for by default; EIN and DOB are for structured columns.
TEXT_DETECTORS = ("EMAIL", "SECRET", "CARD", "SSN", "PHONE", "IPV4")
DETECTOR_CLASS = {"EMAIL": "CONFIDENTIAL", "PHONE": "CONFIDENTIAL", "IPV4": "CONFIDENTIAL",
                  "CARD": "RESTRICTED", "SSN": "RESTRICTED", "SECRET": "RESTRICTED",
                  "EIN": "RESTRICTED", "DOB": "CONFIDENTIAL"}
# Fixed column-name hints for structured columns.
NAME_HINTS = {
    "ssn": "RESTRICTED", "tax_id": "RESTRICTED", "ein": "RESTRICTED", "card": "RESTRICTED",
    "email": "CONFIDENTIAL", "phone": "CONFIDENTIAL", "dob": "CONFIDENTIAL", "date_of_birth": "CONFIDENTIAL",
    "name": "CONFIDENTIAL", "address": "CONFIDENTIAL", "acctbal": "CONFIDENTIAL",
}
SUGGESTED_TECHNIQUE = {"RESTRICTED": "HASH", "CONFIDENTIAL": "PARTIAL"}
CLASS_RANK = {"PUBLIC": 0, "INTERNAL": 1, "CONFIDENTIAL": 2, "RESTRICTED": 3}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- column masks

def hash_mask(c, salt: str = "") -> Column:
    """Salted sha256 (M1); NULL stays NULL."""
    v = _c(c).cast("string")
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(F.sha2(F.concat(F.lit(salt), v), 256))


def token(c, salt: str = "", prefix: str = "tok_", length: int = 24) -> Column:
    """Deterministic token (M2): same value -> same token, in every job."""
    v = _c(c).cast("string")
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(prefix), F.substring(F.sha2(F.concat(F.lit(salt), v), 256), 1, length)))


def redact(c, dtype: T.DataType | None = None) -> Column:
    """Constant mask (M4): '***' for strings, NULL for other types."""
    if dtype is None or isinstance(dtype, T.StringType):
        return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(F.lit("***"))
    return F.lit(None).cast(dtype)


def partial(c, keep: int = 4, mask_char: str = "*") -> Column:
    """Keep the last ``keep`` characters (M5); a value that is no longer than that is masked whole."""
    v = _c(c).cast("string")
    hidden = F.when(F.length(v) > keep, F.length(v) - keep).otherwise(F.length(v))
    return F.concat(F.repeat(F.lit(mask_char), hidden), F.when(F.length(v) > keep, F.substring(v, -keep, keep)).otherwise(F.lit("")))


def mask_column(df: DataFrame, column: str, technique: str, **params) -> Column:
    t = technique.upper()
    if t == "HASH":
        return hash_mask(column, params.get("salt", ""))
    if t == "TOKENIZE":
        return token(column, params.get("salt", ""))
    if t == "REDACT":
        return redact(column, df.schema[column].dataType)
    if t == "PARTIAL":
        return partial(column, int(params.get("keep", 4)))
    raise ValueError(f"unknown masking technique {technique}")


def apply_masks(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """``Masker.mask(df, rules)``: rules are dicts with column + technique."""
    by_col = {r["column"]: r for r in rules}
    out = []
    for c in df.columns:
        r = by_col.get(c)
        if r is None:
            out.append(F.col(c))
        else:
            params = {k: v for k, v in r.items() if k not in ("column", "technique")}
            out.append(mask_column(df, c, r["technique"], **params).alias(c))
    return df.select(*out)


# ---------------------------------------------------------------- tokens (M2, M3)

def build_vault(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    """Distinct value -> token pairs (reversible masking)."""
    return (df.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull())
            .distinct().select(token("value", salt).alias("token"), "value"))


def tokenize(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    return df.withColumn(column, token(column, salt))


def detokenize(df: DataFrame, vault: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Join the vault back (M3, J10); unknown tokens give NULL."""
    v = vault.select(F.col("token").alias("__tok"), F.col("value").alias(out or column))
    j = df.join(v, df[column] == v["__tok"], "left").drop("__tok")
    return j.drop(column) if out is None else j


# ---------------------------------------------------------------- access

def column_mask_view(df: DataFrame, rules: Sequence[Mapping], principal_groups: Iterable[str]) -> DataFrame:
    """Dynamic column mask (M6): a rule with ``exempt_groups`` shows clear
    values to members of those groups and the masked value to everyone else.
    Group membership is passed in (the caller resolves the principal)."""
    groups = set(principal_groups)
    masked = []
    for r in rules:
        if groups & set(r.get("exempt_groups", ())):
            continue
        masked.append(r)
    return apply_masks(df, masked)


def row_filter(df: DataFrame, predicate: str, principal_groups: Iterable[str] = (),
               exempt_groups: Iterable[str] = ()) -> DataFrame:
    """Row filter (M7/P9): rows must satisfy ``predicate`` unless exempt."""
    if set(principal_groups) & set(exempt_groups):
        return df
    return df.where(F.coalesce(F.expr(predicate), F.lit(False)))


# ---------------------------------------------------------------- text

def redact_text(c, detectors: Sequence[str] = tuple(REDACT_ORDER)) -> Column:
    """Replace detected spans with ``[TYPE]`` tags.

    Each regex runs only on rows that contain its trigger; per row only one
    branch of each ``when`` is evaluated, so the cost stays linear in the
    number of detectors.
    """
    src = _c(c)
    out = src
    for d in detectors:
        out = F.when(_guard(d, src), F.regexp_replace(out, DETECTORS[d], f"[{d}]")).otherwise(out)
    return out


def detect_counts(df: DataFrame, column: str, detectors: Sequence[str] = TEXT_DETECTORS) -> DataFrame:
    """Per detector: rows with a hit and total matches over a text column (one scan)."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for d in detectors:
        n = F.when(_guard(d, F.col(column)), F.regexp_count(F.col(column), F.lit(DETECTORS[d]))).otherwise(F.lit(0))
        aggs += [F.sum(F.when(n > 0, 1).otherwise(0)).alias(f"h_{d}"), F.sum(n).alias(f"m_{d}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(column).alias("column_name"), F.lit(d).alias("detector"),
                     F.col("__rows").cast("bigint").alias("row_count"),
                     F.coalesce(F.col(f"h_{d}"), F.lit(0)).cast("bigint").alias("rows_with_hit"),
                     F.coalesce(F.col(f"m_{d}"), F.lit(0)).cast("bigint").alias("match_count"))
            for d in detectors]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def luhn(c) -> Column:
    """Whether the digits of a text pass the card checksum: from the right, every second digit doubled, nines cast out."""
    digits = F.reverse(F.filter(F.split(F.regexp_replace(_c(c).cast("string"), "[^0-9]", ""), ""), lambda x: x != ""))
    def weighed(x, i):
        d = x.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    total = F.aggregate(F.transform(digits, weighed), F.lit(0), lambda s, x: s + x)
    return (F.size(digits) >= 12) & (total % 10 == 0)


def valid_cards(c) -> Column:
    """Card-like numbers of a text that pass the checksum, as an array."""
    found = F.regexp_extract_all(_c(c), F.lit("(" + DETECTORS["CARD"] + ")"), F.lit(1))
    return F.filter(found, lambda x: luhn(x))


def classify_pii(df: DataFrame, columns: Sequence[str] | None = None, min_hit_rate: float = 0.0,
                 detectors: Sequence[str] = TEXT_DETECTORS, name_hints: bool = False) -> DataFrame:
    """Column classification from data, and from names (M8).

    One row per (column, detector) with any hit: column_name, detector, rows_with_hit, match_count, hit_rate,
    classification (CONFIDENTIAL / RESTRICTED). With ``name_hints`` also one row, with detector ``NAME:<hint>`` and
    no counts, for each column whose name carries a hint.
    """
    cols = list(columns) if columns else [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    parts = []
    for c in cols:
        d = detect_counts(df, c, detectors)
        rate = F.when(F.col("row_count") == 0, F.lit(0.0)).otherwise(F.col("rows_with_hit") / F.col("row_count"))
        cls = F.create_map(*[x for k, v in DETECTOR_CLASS.items() for x in (F.lit(k), F.lit(v))])[F.col("detector")]
        parts.append(d.where((F.col("rows_with_hit") > 0) & (rate >= F.lit(min_hit_rate)))
                     .select("column_name", "detector", "rows_with_hit", "match_count",
                             F.round(rate, 6).cast("decimal(10,6)").alias("hit_rate"), cls.alias("classification")))
    hints = classify_by_name(df.columns) if name_hints else []
    if hints:
        parts.append(df.sparkSession.createDataFrame(
            [(c, f"NAME:{h}", None, None, None, k) for c, h, k in hints],
            "column_name string, detector string, rows_with_hit long, match_count long, hit_rate decimal(10,6), classification string"))
    if not parts:
        raise ValueError("no column to classify")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mask_by_classification(df: DataFrame, classification: Mapping[str, str], techniques: Mapping[str, str] | None = None,
                           **params) -> DataFrame:
    """Mask every column by its class (P11): RESTRICTED hashed, CONFIDENTIAL partly shown, unless told otherwise."""
    how = {**SUGGESTED_TECHNIQUE, **(techniques or {})}
    rules = [{"column": c, "technique": how[k.upper()], **params} for c, k in classification.items()
             if c in df.columns and k.upper() in how]
    return apply_masks(df, rules)


def search_catalog(catalog: DataFrame, term: str | None = None, classification: str | None = None) -> DataFrame:
    """Entries of a personal-data catalog (rows of :func:`classify_pii`, with or without a table name) by a part of the
    column's, table's or detector's name, or by class (G20)."""
    out = catalog
    if term:
        hit = F.lit(False)
        for c in ("table_name", "column_name", "detector"):
            if c in catalog.columns:
                hit = hit | F.lower(F.col(c)).contains(term.lower())
        out = out.where(hit)
    return out.where(F.upper("classification") == classification.upper()) if classification else out


def classify_by_name(columns: Iterable[str]) -> list[tuple[str, str, str]]:
    """(column, hint, classification) for columns whose name carries a hint."""
    out = []
    for c in columns:
        low = c.lower()
        for hint, cls in NAME_HINTS.items():
            if hint in low:
                out.append((c, hint, cls))
                break
    return out


def suggest_masking(classified: DataFrame) -> DataFrame:
    """One suggested rule per classified column (M9): strongest class wins."""
    rank = F.create_map(*[x for k, v in CLASS_RANK.items() for x in (F.lit(k), F.lit(v))])
    best = classified.groupBy("column_name").agg(
        F.max(F.struct(rank[F.col("classification")].alias("r"), F.col("classification").alias("c"))).alias("b"))
    tech = F.create_map(*[x for k, v in SUGGESTED_TECHNIQUE.items() for x in (F.lit(k), F.lit(v))])
    return best.select("column_name", F.col("b.c").alias("classification"),
                       tech[F.col("b.c")].alias("technique"))


def masking_gaps(classified: DataFrame, rules: DataFrame) -> DataFrame:
    """Classified columns without a masking rule."""
    cols = classified.select("column_name", "classification").distinct()
    return cols.join(rules.select(F.col("column_name")).distinct(), "column_name", "left_anti")
