"""State of many keys in one group: their rows packed into blocks, and one timer for all of them.

A call to a state or a timer costs far more than the work on a row, so a group per key is dear where
keys have few rows. Here a group is a slot of keys, and its rows lie in blocks of a list state. Such a
group is read as a whole: choose the slots so that a task can hold the rows of one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import Column, functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

ROWS = 10_000         # of a block


def slot_of(keys: Iterable[str], slots: int) -> Column:
    """The slot of a key; keep the number of slots for the life of a checkpoint."""
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(slots)).cast("int")


def plain_key(values: Iterable) -> tuple:
    """A key of a row as a key of a dict; as in a grouping, missing numbers equal each other."""
    return tuple("NaN" if v != v else bytes(v) if isinstance(v, bytearray) else v for v in values)


class Blocks:
    """Rows of Python values in order of arrival."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getListState(name, "block BINARY")

    def add(self, rows: Iterable) -> int:
        rows, n = iter(rows), 0
        while block := list(islice(rows, ROWS)):
            self.state.appendValue((pickle.dumps(block),))
            n += len(block)
        return n

    def read(self) -> Iterator:
        if self.state.exists():
            for block, in self.state.get():
                yield from pickle.loads(block)

    def replace(self, rows: Iterable) -> int:
        self.state.clear()
        return self.add(rows)


class Alarm:
    """One timer of a group, at the earliest time that it was set to."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.state = handle.getValueState("alarm", "at BIGINT")

    def set(self, at: int | None) -> None:
        held = self.state.get()[0] if self.state.exists() else None
        if at is None or held is not None and held <= at:
            return
        if held is not None:
            self.handle.deleteTimer(held)
        self.handle.registerTimer(at)
        self.state.update((at,))

    def rung(self) -> None:
        self.state.clear()
