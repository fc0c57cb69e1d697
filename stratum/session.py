"""Session helpers: one place that decides Spark settings and the shared
checkpoint folder.

On a cluster the operator reads ``spark.checkpoint.dir`` from the session (the
cluster names a shared folder there). Only when it is unset, as in local tests,
do we point it at a fresh scratch folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets. AQE re-plans joins from runtime sizes (the
# only broadcast decisions we make without an explicit bound), splits skewed
# join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints go when nothing refers to them any more, and are compressed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "stratum",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder that the session names; a local session without one gets a scratch folder."""
    sc = spark.sparkContext
    if current := sc.getCheckpointDir():
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="stratum-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_out(df: DataFrame, *by: str) -> DataFrame:
    """As ``cut_lineage``, as a table in the shared checkpoint folder, split by the columns ``by``: its parts can be read
    alone, its columns are compressed, and its size is known to the planner."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always has a default
        return 200
