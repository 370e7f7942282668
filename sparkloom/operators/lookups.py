"""Lookups against a service that is no table: many calls in flight per task."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, TimeoutError as CallTimeout

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

UNKNOWN = "未知"


def service_lookup(df: DataFrame, key: str, name: str, connect: Callable[[], Callable], *,
                   in_flight: int = 10, timeout: float = 1000.0, default: str | None = UNKNOWN,
                   kind: str = "string") -> DataFrame:
    """Ask a service for each row's key; at most ``in_flight`` calls at once in a task.

    ``connect`` runs once per task and returns the call, ``key -> value``; keys arrive in their own
    type. A call that finds nothing leaves the value missing, a missing key is not asked and has a
    missing value; a call that runs longer than ``timeout`` seconds gives ``default``. Equal keys of
    an Arrow batch are asked once. The order of rows is not part of the result.
    """
    schema = StructType(list(df.schema.fields)).add(name, kind)
    answer_type = to_arrow_type(schema[name].dataType)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = connect()
        pool = ThreadPoolExecutor(max_workers=in_flight)
        try:
            for batch in batches:
                keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
                answers, waiting = {None: None}, deque()
                for value in dict.fromkeys(k for k in keys if k is not None):
                    if len(waiting) == in_flight:
                        _settle(waiting.popleft(), answers, timeout, default)
                    waiting.append((value, time.monotonic(), pool.submit(call, value)))
                while waiting:
                    _settle(waiting.popleft(), answers, timeout, default)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([answers[k] for k in keys], answer_type)],
                    schema.names)
        finally:
            pool.shutdown(wait=False, cancel_futures=True)
            if hasattr(call, "close"):
                call.close()

    return df.mapInArrow(ask, schema)


def _settle(entry, answers: dict, timeout: float, default) -> None:
    value, begun, future = entry
    try:
        answers[value] = future.result(timeout=max(0.0, begun + timeout - time.monotonic()))
    except CallTimeout:
        future.cancel()
        answers[value] = default
