"""Declared tables over JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string


def typed(lines: DataFrame, schema: str, col: str = "value") -> DataFrame:
    """JSON lines to the declared columns; values written as JSON texts are cast."""
    declared = _parse_datatype_string(schema)
    as_text = StructType([StructField(f.name, StringType()) for f in declared.fields])
    parsed = lines.select(F.from_json(F.col(col), as_text).alias("r"))
    return parsed.select(*[F.col(f"r.{f.name}").cast(f.dataType).alias(f.name)
                           for f in declared.fields])


def declare(spark: SparkSession, name: str, schema: str, lines: DataFrame) -> DataFrame:
    """Register JSON lines (batch or stream, files or Kafka) as the table ``name``."""
    typed(lines, schema).createOrReplaceTempView(name)
    return spark.table(name)
