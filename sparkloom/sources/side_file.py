"""Side files: small reference data that travels with a job."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession


def side_table(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A delimited side file as a table, to be joined with operators.joins.lookup_join."""
    return spark.read.schema(schema).option("sep", sep).csv(path)


def with_side_file(df: DataFrame, path: str, schema: str,
                   apply: Callable[[pd.DataFrame, str], pd.DataFrame]) -> DataFrame:
    """For formats Spark cannot read: ship the file to every worker and hand its local path to
    ``apply`` with each batch of rows."""
    df.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = SparkFiles.get(name)
        for frame in frames:
            yield apply(frame, local)

    return df.mapInPandas(run, schema)
