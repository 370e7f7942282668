"""JSON functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions.text import as_col


def row_json(df: DataFrame, *columns: str, keep_missing: bool = False) -> Column:
    """The row, or some of its columns, as one JSON text."""
    options = {"ignoreNullFields": "false"} if keep_missing else {}
    return F.to_json(F.struct(*(columns or df.columns)), options)


def parse_json(col: str | Column, schema) -> Column:
    return F.from_json(as_col(col), schema)


def parse_nested(df: DataFrame, col: str, outer_schema: str, field: str,
                 inner_schema: str) -> DataFrame:
    """JSON texts whose ``field`` is itself a JSON text, as columns: the outer fields with
    ``field`` parsed to a struct. In steps, so that each text is parsed once."""
    outer = df.select(F.from_json(col, outer_schema).alias("__outer")).select("__outer.*")
    return outer.withColumn(field, F.from_json(field, inner_schema))


def json_field(col: str | Column, name: str, kind: str = "string") -> Column:
    """One top-level field by name."""
    return F.get_json_object(as_col(col), f"$.{name}").cast(kind)
