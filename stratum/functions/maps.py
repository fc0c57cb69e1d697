"""Access to map columns, and to JSON objects as maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_map(text: str | Column) -> Column:
    """A JSON object as a map of texts; NULL where the text is no object."""
    return F.from_json(text, "map<string,string>")


def map_get(m: str | Column, key: str, default: str | None = None) -> Column:
    """The value of ``key``, or the default where the map is NULL, lacks the key, or holds NULL there."""
    c = F.col(m) if isinstance(m, str) else m
    return F.coalesce(F.try_element_at(c, F.lit(key)), F.lit(default)) if default is not None else F.try_element_at(c, F.lit(key))


def map_with(m: str | Column, values: Mapping[str, str | Column]) -> Column:
    """The map with these entries set; a NULL map counts as empty."""
    c = F.col(m) if isinstance(m, str) else m
    put = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))])
    kept = F.map_filter(c, lambda k, _: ~k.isin(list(values)))
    return F.coalesce(F.map_concat(kept, put), put)


def map_text(m: str | Column) -> Column:
    """``key=value`` entries in key order, joined by ``;`` (NULL values as empty text)."""
    c = F.col(m) if isinstance(m, str) else m
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ";")
