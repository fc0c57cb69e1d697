"""Hash expressions shared by merges, quarantine ids, masking and recon.

``row_hash`` encodes every value as ``<length>:<text>`` and NULL as ``~`` before
joining with ``|``. ``concat_ws`` alone skips NULLs, so (a, NULL, b) and
(a, b, NULL) would collide, and a delimiter inside a value collides too; the
length prefix removes both. Every piece is a plain SQL function, so the same
hash can be written in any SQL engine for an oracle check.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_value(c) -> Column:
    s = _as_col(c).cast("string")
    return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("~"))


def row_hash(cols: Iterable) -> Column:
    """sha256 hex of the NULL-safe, length-prefixed encoding of ``cols``."""
    parts = [encode_value(c) for c in cols]
    if not parts:
        return F.sha2(F.lit(""), 256)
    return F.sha2(F.concat_ws("|", *parts), 256)


def row_hash_sql(cols: Iterable[str]) -> str:
    """The same hash as SQL text (for oracle queries and SQL transforms)."""
    parts = [f"COALESCE(CAST(LENGTH(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '~')"
             for c in cols]
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


def hash_bigint(cols: Iterable) -> Column:
    """A signed 60-bit integer from the row hash (first 15 hex digits).

    Used for order-free hash totals: ``sum`` of these is independent of row
    order and partitioning, and fits in DECIMAL(38,0) for any table size.
    """
    return F.conv(F.substring(row_hash(cols), 1, 15), 16, 10).cast("bigint")


def stable_id(prefix: str, cols: Iterable) -> Column:
    """Deterministic id: the same inputs give the same id on every retry."""
    return F.concat(F.lit(prefix), F.substring(row_hash(cols), 1, 32))
