"""Configuration as data.

Config tables are small, but they are still handled as DataFrames with Column
predicates (never string-built SQL), so the same checks run on a table of one
feed or of ten thousand. Only single config rows and violation summaries ever
reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lineage import transitive_closure

# Fixed enum domains and rules of the configuration model.
LAYERS = ("BRONZE", "SILVER", "GOLD")
SOURCE_TYPES = ("FILE", "TABLE", "STREAM", "API", "CDC")
LOAD_TYPES = ("BATCH", "STREAMING", "INCREMENTAL")
LOAD_PATTERNS = ("APPEND", "MERGE", "UPSERT", "OVERWRITE", "SCD2")
ENGINES = ("AUTOLOADER", "DECLARATIVE", "STRUCTURED_STREAMING", "SPARK_SQL")
ON_FAILURE = ("WARN", "FAIL", "QUARANTINE")
CLASSIFICATIONS = ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED")
RETENTION_MIN_DAYS = {"PUBLIC": 30, "INTERNAL": 90, "RESTRICTED": 365, "CONFIDENTIAL": 2555}
# Which sources an engine reads, and which table types a layer holds.
ENGINE_SOURCES = {
    "AUTOLOADER": ("FILE",),
    "DECLARATIVE": ("FILE", "TABLE", "STREAM", "CDC"),
    "STRUCTURED_STREAMING": ("FILE", "TABLE", "STREAM", "CDC"),
    "SPARK_SQL": ("TABLE",),
}
LAYER_TABLE_TYPES = {
    "BRONZE": ("DELTA_MANAGED", "DELTA_EXTERNAL", "STREAMING_TABLE"),
    "SILVER": ("DELTA_MANAGED", "STREAMING_TABLE", "MATERIALIZED_VIEW"),
    "GOLD": ("DELTA_MANAGED", "MATERIALIZED_VIEW"),
}
IDENTIFIER_RE = r"^[a-zA-Z][a-zA-Z0-9_]{2,99}$"
FQN_RE = r"^[a-zA-Z][a-zA-Z0-9_]*\.[a-zA-Z][a-zA-Z0-9_]*\.[a-zA-Z][a-zA-Z0-9_]*$"
TRUE_TEXT = ("true", "1", "yes", "y", "t")


# ---------------------------------------------------------------- lookups

class ConfigNotFound(KeyError):
    pass


def lookup(table: DataFrame, id_col: str, value: str, active_col: str | None = "active_flag",
           hint_limit: int = 50) -> dict:
    """One active config row by id, as a dict; the error lists known ids (O2)."""
    df = table.where(F.col(id_col) == F.lit(value))
    if active_col and active_col in table.columns:
        df = df.where(F.col(active_col))
    rows = df.limit(2).collect()
    if not rows:
        ids = [r[0] for r in table.select(id_col).orderBy(id_col).limit(hint_limit).collect()]
        raise ConfigNotFound(f"{id_col}={value!r} not found; available: {ids}")
    if len(rows) > 1:
        raise ValueError(f"{id_col}={value!r} is not unique")
    return rows[0].asDict(recursive=True)


def list_where(table: DataFrame, active_only: bool = True, **equals) -> DataFrame:
    """Filter chain for config listings (S22, S24); None values are ignored."""
    df = table
    for c, v in equals.items():
        if v is not None:
            df = df.where(F.upper(F.col(c)) == str(v).upper() if isinstance(v, str) else F.col(c) == F.lit(v))
    if active_only and "active_flag" in table.columns:
        df = df.where(F.col("active_flag"))
    return df


def target_by_fqn(targets: DataFrame, catalog: str, schema: str, table: str) -> DataFrame:
    """Target lookup by catalog.schema.table."""
    return targets.where((F.col("catalog_name") == catalog) & (F.col("schema_name") == schema) &
                         (F.col("table_name") == table))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Feed definition files (S20): one multi-line JSON document per feed."""
    return spark.read.option("multiLine", "true").json(path)


def feed_rules(feeds: DataFrame) -> DataFrame:
    """The dq_rules array of every feed, one row per rule."""
    return feeds.select(F.col("target_silver.target_id").alias("feed_target"), F.explode("dq_rules").alias("r")) \
                .select("feed_target", "r.*")


# ---------------------------------------------------------------- EAV

#: When and by whom an EAV row was written; no part of its value.
LOAD_COLS = ("LOAD_DTS", "LOAD_USER")


def to_param_rows(df: DataFrame, key: str, zone: str, columns: Sequence[str] | None = None,
                  eff_ts=None, load_ts=None, load_user: str | None = None) -> DataFrame:
    """Wide rows -> EAV rows (A24): one row per non-NULL value, stamped with the time and user of the load (now, and the
    session's user, unless given).

    Values become text; arrays and maps are JSON, and a double is its shortest
    exact text, so reading it back gives the same double.
    """
    cols = [c for c in (columns or df.columns) if c != key]

    def as_text(c):
        dt = df.schema[c].dataType
        if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(F.col(c))
        return F.col(c).cast("string")

    pairs = F.array(*[F.struct(F.lit(c).alias("PARAM_NM"), as_text(c).alias("PARAM_VAL")) for c in cols])
    ts = F.lit(str(eff_ts)).cast("timestamp_ntz") if eff_ts else F.lit(None).cast("timestamp_ntz")
    at = F.lit(str(load_ts)).cast("timestamp_ntz") if load_ts else F.localtimestamp()
    return (df.select(F.col(key).cast("bigint").alias("JOB_SK"), F.explode(pairs).alias("p"))
            .where(F.col("p.PARAM_VAL").isNotNull())
            .select("JOB_SK", F.lit(zone).alias("PARAM_ZONE"), "p.PARAM_NM", "p.PARAM_VAL",
                    ts.alias("EFF_STRT_DTS"), F.lit(None).cast("timestamp_ntz").alias("EFF_END_DTS"),
                    F.lit(True).alias("CURR_FLG"), F.lit(1).alias("REC_VER_NO"),
                    at.alias("LOAD_DTS"), (F.lit(load_user) if load_user else F.current_user()).alias("LOAD_USER")))


def from_param_rows(eav: DataFrame, types: Mapping[str, str], key: str = "JOB_SK",
                    current_only: bool = True) -> DataFrame:
    """EAV rows -> typed wide rows.

    The pivot values come from ``types`` (no extra distinct pass); text is
    cast with ``try_cast``; booleans accept true/1/yes; JSON types via
    ``from_json``.
    """
    src = eav.where(F.col("CURR_FLG")) if current_only else eav
    names = list(types)
    wide = src.groupBy(key).pivot("PARAM_NM", names).agg(F.max("PARAM_VAL"))
    out = [F.col(key)]
    for n, t in types.items():
        v = F.col(n)
        if t == "boolean":
            out.append(F.when(v.isNull(), F.lit(None)).otherwise(F.lower(F.trim(v)).isin(*TRUE_TEXT)).alias(n))
        elif t.startswith(("array", "map", "struct")):
            out.append(F.from_json(v, t).alias(n))
        else:
            out.append(v.try_cast(t).alias(n))
    return wide.select(*out)


# ---------------------------------------------------------------- versioned config

def save_version(current: DataFrame, changed: DataFrame, keys: Sequence[str], ts,
                 start_col: str = "EFF_STRT_DTS", end_col: str = "EFF_END_DTS",
                 flag_col: str = "CURR_FLG", ver_col: str = "REC_VER_NO") -> DataFrame:
    """Close the current version of each key whose values change and add the new one (type 2 on the EAV keys).

    A key's versions go on from its highest number, closed or not; a row equal to the current version adds none. The
    load's time and user don't count as values; a new version gets ``ts`` and the session's user where ``changed`` has none.
    """
    keys = list(keys)
    t = F.lit(str(ts)).cast("timestamp_ntz")
    meta = (start_col, end_col, flag_col, ver_col)
    values = [c for c in changed.columns if c not in keys and c not in meta and c not in LOAD_COLS]
    for c, v in zip(LOAD_COLS, (t, F.current_user())):
        if c in current.columns and c not in changed.columns:
            changed = changed.withColumn(c, v)
    state = current.groupBy(*keys).agg(
        F.max(ver_col).alias("__top"),
        F.max_by(F.struct(F.lit(True).alias("__on"), *values), F.struct(F.col(flag_col), F.col(ver_col))).alias("__was"),
        F.max(flag_col).alias("__live"))
    met = changed.join(state, keys, "left")
    same = F.coalesce(F.col("__live"), F.lit(False))
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"__was.{c}"))
    fresh = met.where(~same)
    added = (fresh.withColumn(ver_col, F.coalesce(F.col("__top"), F.lit(0)) + 1).withColumn(start_col, t)
             .withColumn(end_col, F.lit(None).cast("timestamp_ntz")).withColumn(flag_col, F.lit(True)))
    touched = fresh.select(*keys).distinct().withColumn("__hit", F.lit(True))
    old = current.join(touched, keys, "left")
    close = F.coalesce(F.col("__hit") & F.col(flag_col), F.lit(False))
    old = old.select(*[F.when(close, t).otherwise(F.col(c)).alias(c) if c == end_col else
                       (F.col(c) & ~close).alias(c) if c == flag_col else F.col(c) for c in current.columns])
    return old.unionByName(added.select(*current.columns))


# ---------------------------------------------------------------- validation

def _violations(df: DataFrame, entity: str, id_col: str, rule: str, bad, message) -> DataFrame:
    msg = message if not isinstance(message, str) else F.lit(message)
    return df.where(bad).select(F.lit(entity).alias("entity"), F.col(id_col).cast("string").alias("entity_id"),
                                F.lit(rule).alias("rule"), msg.alias("message"))


def _unknown(c: str, domain: Sequence[str]):
    """A value outside its domain; a missing one is outside too."""
    return ~F.coalesce(F.upper(F.col(c)).isin(*domain), F.lit(False))


def validate_config(sources: DataFrame | None = None, targets: DataFrame | None = None,
                    loads: DataFrame | None = None, transforms: DataFrame | None = None,
                    dq_rules: DataFrame | None = None) -> DataFrame:
    """All config violations at once (V1): entity, entity_id, rule, message.

    Each rule is a filter; foreign keys are bulk anti joins (J5).
    """
    parts: list[DataFrame] = []
    has = lambda df, c: df is not None and c in df.columns
    if sources is not None:
        s = sources
        if has(s, "source_type"):
            parts.append(_violations(s, "source", "source_id", "source_type_domain",
                                     _unknown("source_type", SOURCE_TYPES), "unknown source_type"))
            if has(s, "file_format"):
                parts.append(_violations(s, "source", "source_id", "file_needs_format",
                                         (F.upper("source_type") == "FILE") & F.col("file_format").isNull(),
                                         "FILE source needs file_format"))
            if has(s, "connection_string"):
                parts.append(_violations(s, "source", "source_id", "jdbc_needs_connection",
                                         (F.upper("source_type") == "JDBC") & F.col("connection_string").isNull(),
                                         "JDBC source needs connection_string"))
        if has(s, "pii_flag") and has(s, "data_classification"):
            parts.append(_violations(s, "source", "source_id", "pii_classification",
                                     F.col("pii_flag") & ~F.upper("data_classification").isin("CONFIDENTIAL",
                                                                                                "RESTRICTED"),
                                     "PII source must be CONFIDENTIAL or RESTRICTED"))
        if has(s, "source_id"):
            parts.append(_violations(s, "source", "source_id", "identifier", ~F.col("source_id").rlike(IDENTIFIER_RE),
                                     "source_id is not a valid identifier"))
    if targets is not None:
        t = targets
        if has(t, "layer"):
            parts.append(_violations(t, "target", "target_id", "layer_domain", _unknown("layer", LAYERS),
                                     "unknown layer"))
            if has(t, "table_type"):
                bad = F.lit(False)
                for layer, kinds in LAYER_TABLE_TYPES.items():
                    bad = bad | ((F.upper("layer") == layer) & _unknown("table_type", kinds))
                parts.append(_violations(t, "target", "target_id", "layer_table_type", bad, "table_type not allowed in this layer"))
        if has(t, "partition_columns") and has(t, "liquid_clustering_columns"):
            both = (F.size(F.coalesce("partition_columns", F.array())) > 0) & \
                   (F.size(F.coalesce("liquid_clustering_columns", F.array())) > 0)
            parts.append(_violations(t, "target", "target_id", "partition_xor_cluster", both,
                                     "partition and clustering columns are mutually exclusive"))
        if has(t, "retention_days") and has(t, "data_classification"):
            minimum = F.create_map(*[x for k, v in RETENTION_MIN_DAYS.items() for x in (F.lit(k), F.lit(v))])
            need = minimum[F.upper("data_classification")]
            parts.append(_violations(t, "target", "target_id", "retention_minimum",
                                     F.col("retention_days") < need,
                                     F.concat(F.lit("retention below minimum "), need.cast("string"))))
    if loads is not None:
        ld = loads
        if has(ld, "load_pattern") and has(ld, "merge_keys"):
            parts.append(_violations(ld, "load", "load_id", "merge_needs_keys",
                                     F.upper("load_pattern").isin("MERGE", "UPSERT", "SCD1", "SCD2") &
                                     (F.size(F.coalesce("merge_keys", F.array())) == 0),
                                     "MERGE/UPSERT/SCD load needs merge_keys"))
        if has(ld, "load_type") and has(ld, "checkpoint_location"):
            parts.append(_violations(ld, "load", "load_id", "stream_needs_checkpoint",
                                     (F.upper("load_type") == "STREAMING") & F.col("checkpoint_location").isNull(),
                                     "streaming load needs checkpoint_location"))
        if has(ld, "load_type") and has(ld, "watermark_column"):
            parts.append(_violations(ld, "load", "load_id", "incremental_needs_watermark",
                                     F.upper("load_type").isin("INCREMENTAL", "STREAMING") &
                                     F.col("watermark_column").isNull(), "load needs a watermark column"))
        if has(ld, "engine") and has(ld, "load_pattern"):
            parts.append(_violations(ld, "load", "load_id", "declarative_patterns",
                                     (F.upper("engine") == "DECLARATIVE") &
                                     ~F.upper("load_pattern").isin("APPEND", "SCD2"),
                                     "declarative engine supports APPEND and SCD2 only"))
        for c, domain in (("load_type", LOAD_TYPES), ("load_pattern", LOAD_PATTERNS), ("engine", ENGINES)):
            if has(ld, c):
                parts.append(_violations(ld, "load", "load_id", f"{c}_domain", _unknown(c, domain), f"unknown {c}"))
        if has(ld, "engine") and has(ld, "source_id") and has(sources, "source_type"):
            both = ld.select("load_id", "source_id", "engine").join(sources.select("source_id", "source_type"), "source_id")
            bad = F.lit(False)
            for engine, kinds in ENGINE_SOURCES.items():
                bad = bad | ((F.upper("engine") == engine) & _unknown("source_type", kinds))
            parts.append(_violations(both, "load", "load_id", "engine_source", bad, "engine can't read this source type"))
        if sources is not None and has(ld, "source_id"):
            parts.append(ld.join(sources.select("source_id"), "source_id", "left_anti")
                         .select(F.lit("load").alias("entity"), F.col("load_id").cast("string").alias("entity_id"),
                                 F.lit("fk_source").alias("rule"), F.lit("unknown source_id").alias("message")))
        if targets is not None and has(ld, "target_id"):
            parts.append(ld.join(targets.select("target_id"), "target_id", "left_anti")
                         .select(F.lit("load").alias("entity"), F.col("load_id").cast("string").alias("entity_id"),
                                 F.lit("fk_target").alias("rule"), F.lit("unknown target_id").alias("message")))
    if transforms is not None:
        tr = transforms
        if has(tr, "source_target_id") and has(tr, "destination_target_id"):
            parts.append(_violations(tr, "transform", "transform_id", "source_ne_destination",
                                     F.col("source_target_id") == F.col("destination_target_id"),
                                     "source and destination must differ"))
        if has(tr, "transform_sql") and has(tr, "transform_python"):
            parts.append(_violations(tr, "transform", "transform_id", "needs_logic",
                                     F.col("transform_sql").isNull() & F.col("transform_python").isNull(),
                                     "transform needs SQL or Python"))
        if has(tr, "scd_type") and has(tr, "scd_key_columns") and has(tr, "scd_timestamp_column"):
            parts.append(_violations(tr, "transform", "transform_id", "scd2_needs_keys_and_ts",
                                     (F.col("scd_type") == "2") &
                                     ((F.size(F.coalesce("scd_key_columns", F.array())) == 0) |
                                      F.col("scd_timestamp_column").isNull()),
                                     "SCD2 needs key columns and a timestamp column"))
        if targets is not None:
            for c in ("source_target_id", "destination_target_id"):
                if has(tr, c):
                    parts.append(tr.join(targets.select(F.col("target_id").alias(c)), c, "left_anti")
                                 .select(F.lit("transform").alias("entity"),
                                         F.col("transform_id").cast("string").alias("entity_id"),
                                         F.lit(f"fk_{c}").alias("rule"), F.lit(f"unknown {c}").alias("message")))
    if dq_rules is not None:
        d = dq_rules
        if has(d, "threshold_percent"):
            parts.append(_violations(d, "dq_rule", "dq_rule_id", "threshold_fraction",
                                     (F.col("threshold_percent") < 0) | (F.col("threshold_percent") > 1),
                                     "threshold_percent must be in [0, 1]"))
        if has(d, "on_failure"):
            parts.append(_violations(d, "dq_rule", "dq_rule_id", "on_failure_domain",
                                     ~F.upper("on_failure").isin(*ON_FAILURE), "unknown on_failure"))
        if targets is not None and has(d, "target_id"):
            parts.append(d.join(targets.select("target_id"), "target_id", "left_anti")
                         .select(F.lit("dq_rule").alias("entity"), F.col("dq_rule_id").cast("string").alias("entity_id"),
                                 F.lit("fk_target").alias("rule"), F.lit("unknown target_id").alias("message")))
    if not parts:
        raise ValueError("nothing to validate")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def workflow_graph(loads: DataFrame, sources: DataFrame, targets: DataFrame, load_id: str | None = None) -> DataFrame:
    """Loads with their source and target (G13): three joins."""
    ld = loads if load_id is None else loads.where(F.col("load_id") == load_id)
    return (ld.select("load_id", "source_id", "target_id")
            .join(sources.select("source_id", F.col("source_name"), F.col("source_type")), "source_id", "left")
            .join(targets.select("target_id", "layer", "catalog_name", "schema_name", "table_name"), "target_id",
                  "left"))


def workflow_edges(loads: DataFrame, transforms: DataFrame | None = None, dependencies: DataFrame | None = None,
                   load_id: str | None = None) -> DataFrame:
    """The workflow as edges between nodes ``KIND:id`` (G13): from_node, to_node, edge.

    A load READS its source and WRITES its target, a transform READS one target and WRITES another; DEPENDS leads from what must
    run first (``dependencies`` rows, and the list that a transform carries) to what waits. Inactive rows are left
    out. With ``load_id`` only what that load needs or feeds, at any distance.
    """
    def on(df: DataFrame) -> DataFrame:
        return df.where(F.coalesce("active_flag", F.lit(True))) if "active_flag" in df.columns else df

    def node(kind: str, c: str) -> Column:
        return F.concat(F.lit(f"{kind}:"), F.col(c))

    def edges(df: DataFrame, a: Column, b: Column, edge: str) -> DataFrame:
        return df.select(a.alias("from_node"), b.alias("to_node"), F.lit(edge).alias("edge")).where("from_node is not null and to_node is not null")

    ld = on(loads)
    parts = [edges(ld, node("SOURCE", "source_id"), node("LOAD", "load_id"), "READS"),
             edges(ld, node("LOAD", "load_id"), node("TARGET", "target_id"), "WRITES")]
    known = ld.select(F.col("load_id").alias("id"), F.lit("LOAD").alias("kind"))
    waits = []
    if transforms is not None:
        tr = on(transforms)
        parts += [edges(tr, node("TARGET", "source_target_id"), node("TRANSFORM", "transform_id"), "READS"),
                  edges(tr, node("TRANSFORM", "transform_id"), node("TARGET", "destination_target_id"), "WRITES")]
        known = known.unionByName(tr.select(F.col("transform_id").alias("id"), F.lit("TRANSFORM").alias("kind")))
        if "dependencies" in tr.columns:
            waits.append(tr.select(F.col("transform_id").alias("id"), F.explode("dependencies").alias("first")))
    if dependencies is not None:
        waits.append(on(dependencies).select(F.col("object_id").alias("id"), F.col("depends_on_id").alias("first")))
    for w in waits:
        later = w.join(known, "id").withColumnRenamed("kind", "__later")
        both = later.join(known.select(F.col("id").alias("first"), F.col("kind").alias("__first")), "first")
        parts.append(edges(both, F.concat_ws(":", "__first", "first"), F.concat_ws(":", "__later", "id"), "DEPENDS"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.distinct()
    if load_id is None:
        return out
    start = f"LOAD:{load_id}"
    feeds = transitive_closure(out, "from_node", "to_node", start=[start]).select(F.col("ancestor").alias("n"))
    needs = transitive_closure(out, "to_node", "from_node", start=[start]).select(F.col("ancestor").alias("n"))
    me = loads.sparkSession.createDataFrame([(start,)], "n string")
    # an edge belongs to it if both ends are on the same side
    down, up = (side.unionByName(me).distinct() for side in (feeds, needs))
    sides = [out.join(s.withColumnRenamed("n", "from_node"), "from_node", "left_semi").join(s.withColumnRenamed("n", "to_node"), "to_node", "left_semi")
             for s in (down, up)]
    return sides[0].unionByName(sides[1]).distinct().select("from_node", "to_node", "edge")


def parse_json_value(text: str):
    """EAV complex values: JSON text or plain text (F8)."""
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return text
