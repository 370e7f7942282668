"""Word count over any source of text rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sparkloom.operators.rows import drop_containing, words


def word_count(df: DataFrame, text: str = "value", *, blocked: Sequence[str] = (),
               sep: str = " ") -> DataFrame:
    split = words(df, text, sep=sep)
    if blocked:
        split = drop_containing(split, "word", blocked)
    return split.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
