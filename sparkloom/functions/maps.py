"""Map functions. Big lookups are joins (operators.joins.lookup_join); these serve small maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sparkloom.functions.text import as_col


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def map_get(map_col: str | Column, key: str | Column, default=None) -> Column:
    """Value of a key; missing gives the default."""
    value = F.try_element_at(as_col(map_col), as_col(key))
    return value if default is None else F.coalesce(value, F.lit(default))


def map_of(*named: str) -> Column:
    """Map of column name to column value."""
    return F.map_from_arrays(F.array(*[F.lit(n) for n in named]),
                             F.array(*[F.col(n) for n in named]))
