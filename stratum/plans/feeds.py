"""From configuration rows to a finished run (X1, S20-S24): a feed document, or rows of the ``cfg_*`` tables, become an
:class:`~stratum.plans.ingestion.IngestionConfig`."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import config as C
from ..operators.evolve import EvolutionContext
from ..operators.quality import Rule, rule_from_row
from ..sinks.ledger import RunLedger
from ..sinks.store import TableStore
from .ingestion import IngestionConfig, RunResult, run_ingestion


def _names(value) -> list[str]:
    """A list of names, from an array or comma-separated text."""
    if value is None:
        return []
    return [v.strip() for v in value.split(",") if v.strip()] if isinstance(value, str) else list(value)


def _on(row: Mapping) -> bool:
    return row.get("active_flag") is not False


def rules_of(rows: Sequence[Mapping], target_id: str) -> list[Rule]:
    """The active data-quality rules of a target."""
    return [rule_from_row(r) for r in rows if _on(r) and r.get("target_id") in (None, target_id)]


def ingestion_config(load: Mapping, target: Mapping, rules: Sequence[Mapping] = (), source: Mapping | None = None,
                     transform: Mapping | None = None, batch_ts: str | None = None) -> IngestionConfig:
    """The run that one load row asks for.

    MERGE and UPSERT become an SCD1 load, an INCREMENTAL load reads above its stored mark, merge keys default to the
    target's primary key, and the schema policy follows the load, the target's layer and its SCD type.
    """
    pattern = str(load.get("load_pattern") or "APPEND").upper()
    keys = _names(load.get("merge_keys")) or _names(target.get("primary_key"))
    partitions = _names(target.get("partition_columns"))
    declarative = str(load.get("engine") or "").upper() == "DECLARATIVE"
    scd = (transform or {}).get("scd_type")
    incremental = str(load.get("load_type") or "").upper() == "INCREMENTAL"
    return IngestionConfig(
        entity=str(target.get("acord_entity") or target["table_name"]).lower(),
        target_table=f"{target['schema_name']}/{target['table_name']}",
        load_pattern="SCD1" if pattern in ("MERGE", "UPSERT") else pattern,
        keys=keys if pattern not in ("APPEND", "OVERWRITE") else (), partition_by=partitions,
        rules=rules_of(rules, target["target_id"]), batch_ts=batch_ts,
        watermark=load.get("watermark_column") if incremental else None,
        evolution=EvolutionContext(
            layer=target.get("layer") or "BRONZE", engine="DECLARATIVE" if declarative else "BATCH", scd_type=scd,
            source_system_type=load.get("source_system_type") or "stable",
            governance_tier=load.get("governance_tier") or "standard", zero_downtime=bool(load.get("zero_downtime")),
            paranoid=bool(load.get("paranoid")), type_changes=load.get("type_changes") or "none",
            renames_expected=bool(load.get("renames_expected")), dimensional=bool(target.get("dimensional"))))


def configs_of_feed(spark: SparkSession, path: str, batch_ts: str | None = None) -> dict[str, IngestionConfig]:
    """The runs of a feed document by layer: the load into bronze, and the transform into silver as an SCD load."""
    feed = C.read_feed(spark, path).first().asDict(recursive=True)
    out, rules = {}, feed.get("dq_rules") or []
    if feed.get("load") and feed.get("target_bronze") and _on(feed["load"]):
        out["bronze"] = ingestion_config(feed["load"], feed["target_bronze"], rules, feed.get("source"), batch_ts=batch_ts)
    transform = feed.get("transform_silver")
    if transform and feed.get("target_silver") and _on(transform):
        scd = str(transform.get("scd_type") or "").upper()
        load = {"load_pattern": "SCD2" if scd.endswith("2") else "MERGE" if scd else "APPEND",
                "merge_keys": transform.get("scd_key_columns"), "engine": transform.get("engine")}
        out["silver"] = ingestion_config(load, feed["target_silver"], rules, feed.get("source"), transform, batch_ts)
    return out


def config_of_load(loads: DataFrame, targets: DataFrame, load_id: str, rules: DataFrame | None = None,
                   sources: DataFrame | None = None, batch_ts: str | None = None) -> IngestionConfig:
    """The run of one load row of the ``cfg_*`` tables; unknown or inactive ids raise with the known ones."""
    load = C.lookup(loads, "load_id", load_id)
    target = C.lookup(targets, "target_id", load["target_id"])
    source = C.lookup(sources, "source_id", load["source_id"]) if sources is not None else None
    rows = [] if rules is None else [r.asDict(recursive=True) for r in
                                     C.list_where(rules, target_id=load["target_id"]).collect()]  # a target's few rules
    return ingestion_config(load, target, rows, source, batch_ts=batch_ts)


def in_order(dependencies: DataFrame, object_ids: Sequence[str]) -> list[list[str]]:
    """Loads and transforms in waves that may run at once (``cfg_dependency`` edges, V1): a cycle raises.

    The edges of one workflow are few rows of configuration.
    """
    wanted = set(object_ids)
    edges = {(r["object_id"], r["depends_on_id"]) for r in dependencies.where(F.coalesce("active_flag", F.lit(True)))
             .where(F.col("object_id").isin(list(wanted))).select("object_id", "depends_on_id").collect()}
    waves: list[list[str]] = []
    while wanted:
        ready = sorted(o for o in wanted if not any(a == o and b in wanted for a, b in edges))
        if not ready:
            raise ValueError(f"dependency cycle among {sorted(wanted)}")
        waves.append(ready)
        wanted -= set(ready)
    return waves


def run_feed(spark: SparkSession, store: TableStore, ledger: RunLedger, configs: Mapping[str, IngestionConfig],
             read: Callable[[], DataFrame], harmonize: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, RunResult]:
    """Bronze from ``read``, then silver from what bronze holds, if bronze went through; layers run one after the other."""
    done: dict[str, RunResult] = {}
    if "bronze" in configs:
        done["bronze"] = run_ingestion(spark, store, ledger, configs["bronze"], read)
        if done["bronze"].status != "SUCCESS":
            return done
    if "silver" in configs:
        def from_bronze() -> DataFrame:
            df = store.read(configs["bronze"].target_table) if "bronze" in configs else read()
            return harmonize(df) if harmonize else df
        done["silver"] = run_ingestion(spark, store, ledger, configs["silver"], from_bronze)
    return done
