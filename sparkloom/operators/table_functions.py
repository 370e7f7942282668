"""Table functions that SQL can call: one row or a whole partition in, any number of rows out.

Their result columns come from ``analyze``, which sees the argument types and constants when the
query is planned, so one function serves several shapes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import (AnalyzeArgument, AnalyzeResult, OrderingColumn,
                                   PartitioningColumn, udtf)
from pyspark.sql.types import (DoubleType, IntegerType, LongType, NumericType, StringType,
                               StructType, TimestampNTZType, TimestampType)


class SplitText:
    """``split_text(text, separator, blocked)``: the parts of a text but those that contain the
    blocked word, with their places.

    Separator and blocked word are constants; a null blocked word keeps all parts. With an empty
    separator there is no place column, as the parts are characters. A null text has no parts.
    """

    @staticmethod
    def analyze(text: AnalyzeArgument, separator: AnalyzeArgument,
                blocked: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(text.dataType, StringType):
            raise ValueError("split_text takes a text")
        if not separator.isConstantExpression or not blocked.isConstantExpression:
            raise ValueError("separator and blocked word must be constants")
        schema = StructType().add("part", StringType())
        return AnalyzeResult(schema.add("place", IntegerType()) if separator.value else schema)

    def eval(self, text, separator, blocked):
        if text is None:
            return
        for place, part in enumerate(text.split(separator) if separator else text):
            if blocked is None or blocked not in part:
                yield (part, place) if separator else (part,)


class Gaps:
    """``gaps(TABLE(t), 'key', 'time', 'number')``: per key the time and change since the last row.

    The plan partitions by the key and orders by the time, so a task sees one key's rows in order and
    keeps one of them. The first row of a key has nulls. Times are TIMESTAMP of either kind.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, key: AnalyzeArgument, time: AnalyzeArgument,
                number: AnalyzeArgument) -> AnalyzeResult:
        fields = {f.name: f.dataType for f in table.dataType.fields}
        for name in (key.value, time.value, number.value):
            if name not in fields:
                raise ValueError(f"no column {name}")
        if not isinstance(fields[time.value], (TimestampType, TimestampNTZType)):
            raise ValueError(f"{time.value} is no time")
        if not isinstance(fields[number.value], NumericType):
            raise ValueError(f"{number.value} is no number")
        schema = (StructType().add(key.value, fields[key.value]).add(time.value, fields[time.value])
                  .add("gap_micros", LongType()).add("change", DoubleType()))
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key.value)],
                             orderBy=[OrderingColumn(time.value)])

    def __init__(self):
        self.last = None

    def eval(self, row, key, time, number):
        now, value = row[time], row[number]
        gap = change = None
        if self.last is not None:
            then, before = self.last
            if now is not None and then is not None:
                apart = now - then
                gap = (apart.days * 86_400 + apart.seconds) * 1_000_000 + apart.microseconds
            if value is not None and before is not None:
                change = float(value - before)
        self.last = (now, value)
        yield row[key], now, gap, change


def register_table_functions(spark: SparkSession) -> None:
    """Make ``split_text`` and ``gaps`` known to SQL."""
    spark.udtf.register("split_text", udtf(SplitText))
    spark.udtf.register("gaps", udtf(Gaps))
