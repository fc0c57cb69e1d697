"""Registry of named queries over the driver tables.

Each entry is a Spark builder ``fn(spark, sf_dir) -> DataFrame`` plus,
where the operator is expressible in SQL, the equivalent SQL text for an
independent engine (the oracle). Builders only read the given tables (or data
Spark derives from them), so their work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, ops: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(ops))
        return fn
    return deco


class Tables:
    """Lazy parquet readers: ``Tables(spark, d).orders`` is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:  # one DataFrame per table, so column refs resolve
            self._cache[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._cache[name]


def load_all() -> dict[str, Entry]:
    """Import every query module (registration happens at import)."""
    from . import (queries_history, queries_ops, queries_quality, queries_text,  # noqa: F401
                   queries_transform)
    return REGISTRY
