"""Writing results (L1-L4, L24, L25, L27-L32) to parquet directories.

One layout per table: a directory of parquet files that Spark's own job commit
publishes, so everything that was committed is read, whichever way it was
written. A table that is merged by keys is partitioned by a hash bucket of the keys;
a merge reads and replaces only the buckets its batch touches, by dynamic
partition overwrite. A partition overwrite of data it was computed from is first written
to the shared checkpoint folder; a whole table is written beside the old one and
takes its place by two renames. Paths may be local, HDFS or an object store;
file listing uses the Hadoop FileSystem of the session.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.config import RETENTION_MIN_DAYS
from ..session import cut_lineage


class WriteResult(dict):
    """num_output_rows, operation, plus metrics (the load contract)."""

    @property
    def num_output_rows(self) -> int:
        return int(self.get("num_output_rows", 0))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def observed_write(df: DataFrame, write) -> int:
    """Run ``write(df_observed)`` and return the rows it wrote (L2): the count
    is collected from the write job itself (``Observation``), no second pass."""
    obs = Observation("written")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get.get("rows", 0) or 0)


#: Partition column of tables merged by keys.
BUCKET = "key_bucket__"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row; keys count as text, so that a widened key type keeps its bucket."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


#: The table's schema, beside its data (hidden from Spark's listing). Empty text can't be the value of a directory: it is
#: written as this mark, and text that begins with the mark gets it once more.
SCHEMA_FILE = "_stratum_schema.json"
_MARK = "__empty__"


def _text_partitions(df: DataFrame, partition_by: Sequence[str]) -> list[str]:
    return [c for c in partition_by if isinstance(df.schema[c].dataType, T.StringType)]


def _marked(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    text = _text_partitions(df, partition_by)
    return df.select(*[(F.when((F.col(c) == "") | F.col(c).startswith(_MARK), F.concat(F.lit(_MARK), F.col(c))).otherwise(F.col(c)).alias(c)
                        if c in text else F.col(c)) for c in df.columns]) if text else df


def _unmarked(df: DataFrame, text: Sequence[str]) -> DataFrame:
    return df.select(*[(F.when(F.col(c).startswith(_MARK), F.substr(F.col(c), F.lit(len(_MARK) + 1))).otherwise(F.col(c)).alias(c)
                        if c in text else F.col(c)) for c in df.columns]) if text else df


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 32):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _beside(self, table: str, what: str) -> str:
        """A hidden folder next to the table's."""
        folder, _, name = self.path(table).rpartition("/")
        return f"{folder}/.{name}.{what}"

    def _recover(self, table: str) -> None:
        """Finish or undo a replacement that was cut off between its renames; nothing to do otherwise."""
        fs, p = _fs(self.spark, self.path(table))
        _, prev = _fs(self.spark, self._beside(table, "prev"))
        if not fs.exists(prev):
            return
        if fs.exists(p):  # the new content is in place
            fs.delete(prev, True)
            return
        _, ready = _fs(self.spark, f"{self._beside(table, 'next')}/{SCHEMA_FILE}")
        fs.rename(ready.getParent() if fs.exists(ready) else prev, p)
        fs.delete(prev, True)

    def exists(self, table: str) -> bool:
        self._recover(table)
        fs, p = _fs(self.spark, self.path(table))
        return fs.exists(p) and any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))

    # -------------------------------------------------------------- reads
    def _stored(self, table: str) -> DataFrame | None:
        if not self.exists(table):
            return None
        known, parts = self._schema(table)
        if known is None:  # written by other means
            return self.spark.read.option("mergeSchema", "true").parquet(self.path(table))
        # with the schema given, no footers are merged and no partition value is guessed to be a number
        return _unmarked(self.spark.read.schema(known).parquet(self.path(table)), parts)

    def _schema(self, table: str) -> tuple[T.StructType | None, list[str]]:
        """The schema kept beside the data, and the text columns that partition it."""
        fs, p = _fs(self.spark, f"{self.path(table)}/{SCHEMA_FILE}")
        if not fs.exists(p):
            return None, []
        with contextlib.closing(fs.open(p)) as f:
            kept = json.loads(bytes(f.readAllBytes()).decode())
        return T.StructType.fromJson(kept["schema"]), kept["text_partitions"]

    def _keep_schema(self, table: str, df: DataFrame, partition_by: Sequence[str], grow: bool = True, folder: str | None = None) -> None:
        """Columns and types of the table from now on: ``df``'s, after those that are there already if it grows."""
        old, parts = self._schema(table) if grow else (None, [])
        if grow and old is None and self.exists(table):
            return  # a table written by other means stays as it is
        fields = list(old.fields) if old else []
        fields += [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in {x.name for x in fields}]
        fields = [f for f in fields if f.name not in partition_by] + [f for f in fields if f.name in partition_by]
        if old is not None and fields == list(old.fields):
            return
        text = sorted({*parts, *_text_partitions(df, partition_by)})
        fs, p = _fs(self.spark, f"{folder or self.path(table)}/{SCHEMA_FILE}")
        with contextlib.closing(fs.create(p, True)) as f:
            f.write(bytearray(json.dumps({"schema": T.StructType(fields).jsonValue(), "text_partitions": text}).encode()))

    def read(self, table: str) -> DataFrame | None:
        df = self._stored(table)
        return None if df is None else df.drop(BUCKET)

    # -------------------------------------------------------------- writes
    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), keys: Sequence[str] = ()) -> WriteResult:
        """Append (L1, L24): created on first write; later batches may carry extra columns.

        A table laid out by keys needs them here too.
        """
        stored = self._stored(table)
        if stored is not None and BUCKET in stored.columns:
            if not keys:
                raise ValueError(f"{table} is laid out by its merge keys; name them to append")
            df, partition_by = df.withColumn(BUCKET, bucket_of(keys, self.buckets)), (BUCKET,)
        self._keep_schema(table, df, partition_by)  # a column too many is harmless if the write fails
        df = _marked(df, partition_by)

        def w(d):
            d.write.mode("append").partitionBy(*partition_by).parquet(self.path(table))
        return WriteResult(num_output_rows=observed_write(df, w), operation="APPEND")

    def replace(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), keys: Sequence[str] = ()) -> WriteResult:
        """Full refresh (L3): the table holds exactly ``df`` afterwards, or what it held before.

        ``df`` may read the table itself: the new content is written beside it, whole with its schema, before it takes the
        table's place. A run that ends in between leaves the old content or, at the next access, the new.
        """
        if keys:
            df, partition_by = df.withColumn(BUCKET, bucket_of(keys, self.buckets)), (BUCKET,)
        self._recover(table)
        folder, new = self.path(table), self._beside(table, "next")

        def w(d):
            d.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(new)
        fs, staged = _fs(self.spark, new)
        fs.delete(staged, True)  # what an interrupted run left
        n = observed_write(_marked(df, partition_by), w)
        self._keep_schema(table, df, partition_by, grow=False, folder=new)
        _, p = _fs(self.spark, folder)
        _, prev = _fs(self.spark, self._beside(table, "prev"))
        if fs.exists(p) and not fs.rename(p, prev):
            raise OSError(f"{folder} can't be set aside")
        if not fs.rename(staged, p):
            raise OSError(f"{new} can't take the place of {folder}")
        fs.delete(prev, True)
        self.spark.catalog.refreshByPath(folder)
        return WriteResult(num_output_rows=n, operation="OVERWRITE")

    def overwrite_partitions(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> WriteResult:
        """Dynamic partition overwrite (L4): exactly the partition values in the
        batch are replaced; an empty batch replaces nothing."""
        self._keep_schema(table, df, partition_by)
        df = _marked(df, partition_by)

        def w(d):
            (d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_by).parquet(self.path(table)))
        return WriteResult(num_output_rows=observed_write(df, w), operation="PARTITION_OVERWRITE")

    def merge(self, table: str, plan, keys: Sequence[str] = (), batch: DataFrame | None = None) -> WriteResult:
        """Replace the table by ``plan(current)``; the result may be a DataFrame, or a tuple that begins with it and one
        row of metrics (a DataFrame, or a list of aggregates over the result's ``__action``, observed on the way).

        With ``keys`` and ``batch`` only the buckets of the batch's keys are read and rewritten, so the plan
        must leave all other keys alone (a snapshot delete does not).
        """
        stored = self._stored(table)
        scoped = bool(keys) and batch is not None and stored is not None and BUCKET in stored.columns
        touched: list[int] = []
        cur = None if stored is None else stored.drop(BUCKET)
        if scoped:
            touched = [r[0] for r in batch.select(bucket_of(keys, self.buckets)).distinct().collect()]  # at most ``buckets``
            cur = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        res = plan(cur)
        new, metrics = (res[0], res[1]) if isinstance(res, tuple) else (res, None)
        got: dict = {}
        if isinstance(metrics, list):
            obs = Observation("merge")
            new = cut_lineage(new.observe(obs, *metrics))
            got = dict(obs.get)
            new = new.drop("__action")
        elif metrics is not None:
            got = metrics.first().asDict()
        if not scoped:
            r = self.replace(table, new, keys=keys)
        else:
            out = cut_lineage(new.withColumn(BUCKET, bucket_of(keys, self.buckets)))
            left = {x[0] for x in out.select(BUCKET).distinct().collect()}
            r = self.overwrite_partitions(table, out, (BUCKET,))
            for b in set(touched) - left:  # a bucket that lost its last row
                fs, p = _fs(self.spark, f"{self.path(table)}/{BUCKET}={b}")
                fs.delete(p, True)
        r.update({k: v for k, v in got.items() if k != "num_output_rows" or v is not None})
        return r

    # -------------------------------------------------------------- upkeep
    def _partitions(self, table: str) -> list[str]:
        """Partition columns of the table, in the order of its folders (read from one path of them)."""
        fs, p = _fs(self.spark, self.path(table))
        out: list[str] = []
        while True:
            sub = next((st.getPath() for st in fs.listStatus(p) if st.isDirectory() and "=" in st.getPath().getName()), None)
            if sub is None:
                return out
            out.append(sub.getName().partition("=")[0])
            p = sub

    def compact(self, table: str) -> WriteResult:
        """The same rows in few files (a ledger or a commit log gets one file an event); partitions stay.

        Rows are grouped by partition and split by size, as AQE's rebalance does.
        """
        stored = self._stored(table)
        if stored is None:
            return WriteResult(num_output_rows=0, operation="COMPACT")
        parts = self._partitions(table)
        r = self.replace(table, stored.hint("rebalance", *parts), parts)
        r["operation"] = "COMPACT"
        return r

    def purge(self, table: str, date_col: str, retention_days: int, as_of, classification: str | None = None) -> WriteResult:
        """Delete rows older than the retention (L27): ``rows_deleted``.

        Rows without a date stay. Fewer days than the classification's minimum raise. One pass over the date and the files'
        places tells what goes: folders whose rows are all expired are deleted unread (a table partitioned by the date has no
        others), of the other partitions only those with expired rows are rewritten, and a table without partitions is replaced.
        """
        least = RETENTION_MIN_DAYS.get((classification or "").upper(), 0)
        if int(retention_days) < least:
            raise ValueError(f"{classification} needs at least {least} retention days, not {retention_days}")
        result = WriteResult(operation="PURGE", rows_deleted=0)
        stored = self._stored(table)
        if stored is None:
            return result
        cutoff = F.date_sub(F.lit(str(as_of)).cast("date"), int(retention_days))
        expired = F.coalesce(F.col(date_col).try_cast("date") < cutoff, F.lit(False))
        folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
        touched = stored.groupBy(folder.alias("folder")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(expired).alias("gone")).where("gone > 0").collect()  # a row a folder
        result["rows_deleted"] = sum(r["gone"] for r in touched)
        parts = self._partitions(table)
        if not parts and touched:
            self.replace(table, stored.where(~expired))
        elif touched:
            if any(r["gone"] < r["rows"] for r in touched):
                by = [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in parts]
                places = stored.where(expired).select(*[F.col(c).alias(f"__p_{c}") for c in parts]).distinct()
                self.overwrite_partitions(table, cut_lineage(stored.where(~expired).join(places, by, "left_semi")), parts)
            jvm = self.spark.sparkContext._jvm
            fs, _ = _fs(self.spark, self.path(table))
            for r in touched:
                if r["gone"] == r["rows"]:
                    fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(r["folder"])), True)
        self.spark.catalog.refreshByPath(self.path(table))
        return result

    # -------------------------------------------------------------- replay guard
    def mark_commit(self, table: str, batch_id: int) -> None:
        """Remember a micro-batch as done, as a row of ``<table>_commits``."""
        self.append(f"{table}_commits", self.spark.range(batch_id, batch_id + 1).withColumnRenamed("id", "batch_id").coalesce(1))

    def has_commit(self, table: str, batch_id: int) -> bool:
        done = self.read(f"{table}_commits")
        return done is not None and not done.where(F.col("batch_id") == batch_id).isEmpty()


def retention_filter(df: DataFrame, date_col: str, as_of, retention_days: int) -> DataFrame:
    """Rows to keep under a retention policy."""
    cutoff = F.date_sub(F.lit(str(as_of)).cast("date"), int(retention_days))
    return df.where(F.col(date_col) >= cutoff)


def layout(df: DataFrame, partition_columns: Sequence[str] = (), cluster_columns: Sequence[str] = (),
           num_partitions: int | None = None) -> DataFrame:
    """Physical layout before a write (L29): partitioned writes are grouped by
    the partition columns (fewer files per partition); clustered layout is a
    range partitioning plus a sort, so row groups carry tight min/max stats
    for data skipping. The two are mutually exclusive."""
    if partition_columns and cluster_columns:
        raise ValueError("partition and clustering columns are mutually exclusive")
    if partition_columns:
        # a rebalance groups by value and lets AQE split the values that hold most rows
        return df.hint("rebalance", *partition_columns)
    if cluster_columns:
        r = df.repartitionByRange(num_partitions, *cluster_columns) if num_partitions else \
            df.repartitionByRange(*cluster_columns)
        return r.sortWithinPartitions(*cluster_columns)
    return df


def create_table_ddl(fqn: str, df: DataFrame, partition_columns: Sequence[str] = (), using: str = "parquet",
                     not_null: Sequence[str] = ()) -> str:
    """CREATE TABLE text from a DataFrame schema (L30); non-nullable fields, and those named, are NOT NULL."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}"
                        + (" NOT NULL" if not f.nullable or f.name in not_null else "") for f in df.schema.fields)
    part = f"\nPARTITIONED BY ({', '.join(partition_columns)})" if partition_columns else ""
    return f"CREATE TABLE IF NOT EXISTS {fqn} (\n  {cols}\n) USING {using}{part}"


def write_files(df: DataFrame, path: str, fmt: str, mode: str = "append", partition_by: Sequence[str] = (),
                options: dict | None = None) -> WriteResult:
    """CSV / JSON / Parquet / ORC file targets."""
    def w(d):
        wr = d.write.format(fmt).mode(mode).options(**(options or {}))
        if partition_by:
            wr = wr.partitionBy(*partition_by)
        wr.save(path)
    return WriteResult(num_output_rows=observed_write(df, w), operation=mode.upper())


def create_view(df: DataFrame, name: str) -> None:
    """View target (L32): a temporary view over the plan (recomputed on read)."""
    df.createOrReplaceTempView(name)
