"""Session settings shared by batch and streaming jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import sparkloom

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings every operator relies on; all of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_fallback: dict[str, str] = {}


def build_session(app: str = "sparkloom", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings above; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's functions to Python workers by value.

    The package then need not be installed on executors. A file given to ``--py-files`` would not
    do: the worker that sets up a stateful streaming operator does not load such files.
    """
    cloudpickle.register_pickle_by_value(sparkloom)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return ship_package(spark)


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for what starts inside; a streaming query keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the checkpoint folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session without the
    setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_fallback.setdefault("dir", tempfile.mkdtemp(prefix="sparkloom-"))
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table on shared storage, written now.

    For inputs that are costly to compute and read several times: later passes read only their
    columns, and a lost executor costs a read instead of the computation.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
