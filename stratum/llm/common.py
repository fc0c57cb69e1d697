"""Shared plumbing of the training-data operators.

Rows travel through an operator as one struct (``ROW``), so the columns of the
caller, whatever their names, never clash with the operator's own.
"""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Characters of text handled at once inside a task; bounds a worker's memory, never the text read.
CHUNK_CHARS = 1 << 18


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as remainder -1 (never held out, never learned from)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def bounded_sample(df: DataFrame, id_col: str, bound: int, salt: int = 17) -> DataFrame:
    """About ``bound`` rows (all of them, if fewer), picked by a hash of the id, so the same at any layout.

    One count of the ids decides the share; no text is shuffled or sorted.
    """
    total = df.where(F.col(id_col).isNotNull()).count()
    if total <= bound:
        return df.where(F.col(id_col).isNotNull())
    share = F.pmod(F.xxhash64(F.col(id_col), F.lit(salt)), F.lit(1_000_000))
    return df.where(F.col(id_col).isNotNull() & (share < F.lit(int(1_000_000 * bound / total))))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application (as ``--py-files`` does)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="stratum-src-"), "stratum_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def release_memory() -> None:
    """Give what a task has freed back to the system: a worker outlives its tasks, and its operator."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str, tokenizes: bool = False) -> DataFrame:
    """``mapInArrow`` with record batches kept small enough for long texts.

    A worker keeps its tokenizers from task to task only while its tasks tokenize.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tokenizes and (tokens := sys.modules.get(f"{__package__}.tokens")):
            tokens.forget()
        try:
            yield from fn(batches)
        finally:
            release_memory()

    spark = df.sparkSession
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df.mapInArrow(run, schema)


def chunked(texts: Iterable[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` characters together (a longer text stands alone)."""
    start = size = i = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
        i += 1
    if i > start:
        yield start, i


def reliable(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``reliable``, as a table in the shared checkpoint folder: its size is known, where a loop's checkpoints keep
    the estimates of the plans before them, which multiply from round to round."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spilled(df: DataFrame) -> DataFrame:
    """Keep a result that is read several times within one operator; recomputed if an executor is lost."""
    return df.persist(StorageLevel.DISK_ONLY)


def broadcast_value(spark: SparkSession, value):
    """A model or index of documented, bounded size for the tasks."""
    return spark.sparkContext.broadcast(value)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
