"""Batch readers (S1-S19): files, catalog tables, JDBC presets, incremental
and CDC feeds, multi-source union.

Readers return lazy DataFrames; filters and projections applied afterwards
reach the scan (Parquet / ORC pushdown, JDBC predicate pushdown).
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Fixed default reader options per format (S10); callers may add or override.
DEFAULT_OPTIONS: dict[str, dict[str, str]] = {
    "csv": {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    "json": {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    "parquet": {},
    "orc": {},
    "avro": {},
    "delta": {},
}


class ReaderRegistry:
    """Format -> default options."""

    def __init__(self):
        self._opts = {k: dict(v) for k, v in DEFAULT_OPTIONS.items()}

    def register(self, fmt: str, options: Mapping[str, str] | None = None) -> None:
        self._opts.setdefault(fmt.lower(), {}).update(options or {})

    def options_for(self, fmt: str) -> dict[str, str]:
        f = fmt.lower()
        if f not in self._opts:
            raise ValueError(f"unsupported file format {fmt!r}")
        return dict(self._opts[f])


REGISTRY = ReaderRegistry()


def load_schema(spec: str | Mapping | T.StructType | None) -> T.StructType | None:
    """Explicit schema from a StructType, its JSON, or a DDL string."""
    if spec is None or isinstance(spec, T.StructType):
        return spec
    if isinstance(spec, Mapping):
        return T.StructType.fromJson(dict(spec))
    text = spec.strip()
    if text.startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    return T._parse_datatype_string(text)


def read_files(spark: SparkSession, path: str | Sequence[str], fmt: str, schema=None,
               options: Mapping[str, str] | None = None, registry: ReaderRegistry = REGISTRY) -> DataFrame:
    """File read dispatch (S1-S7, S9): csv, json, parquet, orc, avro, delta.

    CSV with an explicit schema gets a ``_corrupt_record`` column added so
    malformed lines are kept (PERMISSIVE); CSV without a schema is inferred
    once and re-read with that schema plus the corrupt column, because an
    inferred CSV read does not capture corrupt rows. Unknown format -> ValueError.
    """
    f = fmt.lower()
    opts = registry.options_for(f)
    opts.update(options or {})
    sch = load_schema(schema)
    reader = spark.read.format(f).options(**opts)
    if f == "csv":
        if sch is None:
            inferred = spark.read.format("csv").options(**{**opts, "inferSchema": "true"}).load(path).schema
            sch = T.StructType([x for x in inferred.fields if x.name != CORRUPT])
        if CORRUPT not in sch.fieldNames():
            sch = sch.add(T.StructField(CORRUPT, T.StringType(), True))
        return reader.schema(sch).load(path)
    if f == "json" and sch is not None and CORRUPT not in sch.fieldNames():
        sch = sch.add(T.StructField(CORRUPT, T.StringType(), True))
    if sch is not None:
        reader = reader.schema(sch)
    return reader.load(path)


def read_table(spark: SparkSession, fqn: str) -> DataFrame:
    """Catalog table source."""
    return spark.table(fqn)


# ---------------------------------------------------------------- JDBC

# Fixed URL templates and driver classes per database.
JDBC_PRESETS = {
    "sqlserver": ("jdbc:sqlserver://{host}:{port};databaseName={database}", "com.microsoft.sqlserver.jdbc.SQLServerDriver", 1433),
    "postgresql": ("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver", 5432),
    "oracle_service": ("jdbc:oracle:thin:@//{host}:{port}/{database}", "oracle.jdbc.OracleDriver", 1521),
    "oracle_sid": ("jdbc:oracle:thin:@{host}:{port}:{database}", "oracle.jdbc.OracleDriver", 1521),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver", 3306),
    "saphana": ("jdbc:sap://{host}:{port}/?databaseName={database}", "com.sap.db.jdbc.Driver", 30015),
    "derby": ("jdbc:derby:{database};create=true", "org.apache.derby.jdbc.EmbeddedDriver", 0),
}
JDBC_FETCHSIZE = 1000


def jdbc_url(kind: str, host: str = "", database: str = "", port: int | None = None) -> tuple[str, str]:
    tmpl, driver, default_port = JDBC_PRESETS[kind]
    return tmpl.format(host=host, port=port or default_port, database=database), driver


def read_jdbc(spark: SparkSession, url: str, driver: str | None = None, table: str | None = None,
              query: str | None = None, user: str | None = None, password: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetchsize: int = JDBC_FETCHSIZE,
              options: Mapping[str, str] | None = None) -> DataFrame:
    """JDBC read.

    ``query`` is passed bare (Spark wraps it as a subquery itself). A
    partitioned read (``partition_column`` + bounds + ``num_partitions``) needs
    ``table``; to partition a custom query pass it as ``table="(q) t"``.
    Filters and projections on the result are pushed into the database.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    if query is not None and partition_column:
        raise ValueError("query cannot be combined with partition_column; use table='(query) alias'")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    if driver:
        r = r.option("driver", driver)
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    r = r.option("dbtable", table) if table is not None else r.option("query", query)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    return r.options(**(options or {})).load()


# ---------------------------------------------------------------- incremental, CDC, union

def read_incremental(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows past the stored high-water mark (S17): ``low < col <= high``."""
    out = df
    if low is not None:
        out = out.where(F.col(column) > F.lit(str(low)).cast(df.schema[column].dataType))
    if high is not None:
        out = out.where(F.col(column) <= F.lit(str(high)).cast(df.schema[column].dataType))
    return out


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """The new mark to store: one-row ``max(column)``."""
    return df.agg(F.max(column).alias("high_water_mark"))


def business_day_window(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows of a business-day window ``[start, end)``."""
    t = df.schema[column].dataType
    return df.where((F.col(column) >= F.lit(str(start)).cast(t)) & (F.col(column) < F.lit(str(end)).cast(t)))


# JSON keeps full microsecond precision of timestamps (the default writes milliseconds).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# Change-event envelope (Debezium style): op c/u/d/r with before/after images.
CDC_OPS = {"c": "I", "r": "I", "u": "U", "d": "D"}


def cdc_envelope_schema(row: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("before", row), T.StructField("after", row),
                         T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])


def parse_cdc(raw: DataFrame, value_col: str, row_schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Parse change events (S19) into (keys..., _op I/U/D, _seq, row columns).

    The row image is ``after`` for inserts / updates and ``before`` for
    deletes, so deletes still carry their key.
    """
    env = F.from_json(F.col(value_col).cast("string"), cdc_envelope_schema(row_schema), JSON_OPTIONS)
    p = raw.select(env.alias("e"))
    op = F.create_map(*[x for k, v in CDC_OPS.items() for x in (F.lit(k), F.lit(v))])[F.col("e.op")]
    img = F.when(F.col("e.op") == "d", F.col("e.before")).otherwise(F.col("e.after"))
    return p.select(*[img[f.name].alias(f.name) for f in row_schema.fields], op.alias("_op"),
                    F.col("e.ts_ms").alias("_seq"))


def to_cdc_events(df: DataFrame, op: str | F.Column, ts_ms: str | F.Column) -> DataFrame:
    """Encode rows as change events (the inverse of :func:`parse_cdc`)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    o = F.lit(op) if isinstance(op, str) and op in CDC_OPS else (F.col(op) if isinstance(op, str) else op)
    t = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    env = F.struct(F.when(o == "d", row).alias("before"), F.when(o != "d", row).alias("after"), o.alias("op"),
                   t.cast("bigint").alias("ts_ms"))
    return df.select(F.to_json(env, JSON_OPTIONS).cast("binary").alias("value"))


class SchemaMismatch(ValueError):
    pass


def union_sources(dfs: Sequence[DataFrame], allow_mismatch: bool = False,
                  source_names: Sequence[str] | None = None) -> DataFrame:
    """Union by name (S16, U2). Different column sets fail unless
    ``allow_mismatch``; then missing columns are NULL-filled and the fill is
    reported in ``_union_null_fill`` (the columns that were absent)."""
    if not dfs:
        raise ValueError("no sources")
    cols = [set(d.columns) for d in dfs]
    every = sorted(set().union(*cols), key=lambda c: min(
        (d.columns.index(c) for d in dfs if c in d.columns)))
    if any(c != cols[0] for c in cols) and not allow_mismatch:
        raise SchemaMismatch(f"source columns differ: {[sorted(c) for c in cols]}")
    parts = []
    for i, d in enumerate(dfs):
        missing = [c for c in every if c not in d.columns]
        x = d
        if source_names:
            x = x.withColumn("_source", F.lit(source_names[i]))
        x = x.withColumn("_union_null_fill", F.lit(",".join(missing)) if missing else F.lit(None).cast("string"))
        parts.append(x)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def retry_delays(attempts: int = 3, first: float = 1.0, longest: float = 60.0, backoff: str = "exponential") -> list[float]:
    """Seconds to wait after each attempt but the last."""
    grow = (lambda i: 2.0 ** i) if backoff == "exponential" else (lambda i: i + 1.0)
    return [min(longest, first * grow(i)) for i in range(attempts - 1)]


#: Java errors that another attempt may cure, and those among them that it can't.
_PASSING = ("java.io.IOException", "java.io.InterruptedIOException", "java.net.", "java.sql.SQLTransient", "java.sql.SQLRecoverable",
            "java.util.concurrent.TimeoutException")
_LASTING = ("java.io.FileNotFoundException", "java.net.MalformedURLException", "java.net.URISyntaxException")


def is_transient(error: BaseException) -> bool:
    """Whether a failed read may work when tried again: I/O and network errors, Python's or those that Spark passes on."""
    if isinstance(error, (FileNotFoundError, PermissionError)):
        return False
    if isinstance(error, OSError):
        return True
    text = f"{error} {getattr(error, 'java_exception', '')}"
    return any(x in text for x in _PASSING) and not any(x in text for x in _LASTING)


def with_read_retry(fn, attempts: int = 3, base_delay: float = 1.0, max_delay: float = 60.0,
                    backoff: str = "exponential", transient=None):
    """Call a read until it succeeds or its waits are used up (X3); errors that are not ``transient`` pass at once.

    ``fn`` must run the read, not only plan it: Spark reads when an action does. ``transient`` is a predicate of the
    error, or the types to try again (:func:`is_transient` unless given).

    Writes are never retried here (a retried write could duplicate data); task
    retries inside Spark cover executor loss.
    """
    for delay in retry_delays(attempts, base_delay, max_delay, backoff):
        try:
            return fn()
        except Exception as e:
            if not (isinstance(e, transient) if isinstance(transient, tuple) else (transient or is_transient)(e)):
                raise
        time.sleep(delay)
    return fn()
