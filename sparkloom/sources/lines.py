"""Text lines from files, archives and sockets; the column is ``value``."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

LINES_PER_FRAME = 10_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A file, a folder or a glob; gz, bz2, zst and other Hadoop codecs go by their ending."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream of lines."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def read_zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all members of zip archives, which are no Hadoop codec; one task per archive."""
    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                yield from _archive_lines(content)

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInPandas(unpack, "value STRING")


def _archive_lines(content: bytes) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for member in archive.namelist():
            if member.endswith("/"):
                continue
            with archive.open(member) as raw:
                held = []
                for line in io.TextIOWrapper(raw, encoding="utf-8"):
                    held.append(line.rstrip("\r\n"))
                    if len(held) == LINES_PER_FRAME:
                        yield pd.DataFrame({"value": held})
                        held = []
                if held:
                    yield pd.DataFrame({"value": held})


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a TCP text socket; for trials only, since a socket cannot be read again."""
    return (spark.readStream.format("socket").option("host", host).option("port", port).load())
