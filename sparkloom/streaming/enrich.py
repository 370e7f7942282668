"""Enriching a stream from a dimension that changes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from sparkloom.operators.joins import lookup_join
from sparkloom.sinks.batches import write_once


def enrich_batches(reload: Callable[[], DataFrame | None], on: Mapping[str, str],
                   take: Sequence[str], deliver: Callable[[DataFrame, int], None], *,
                   missing="fail", broadcast_rows: int | None = None):
    """For ``foreachBatch``: join each micro-batch with the dimension as it is then.

    ``reload`` gives the newest snapshot, which replaces the one before; rows that come while
    there is none (``None``) are dropped. ``missing`` as in operators.joins.lookup_join.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        dim = reload()
        if dim is None:
            return
        deliver(lookup_join(batch, dim, on, take, missing=missing,
                            broadcast_rows=broadcast_rows), batch_id)
    return run


def enrich_to(root: str, reload, on, take, **how):
    """The same into one folder per batch."""
    return enrich_batches(reload, on, take, write_once(root), **how)
