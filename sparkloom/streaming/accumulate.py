"""User-defined aggregates on streams: one accumulator as state per key and window.

The accumulators are those of operators.reduce. Every task folds its rows first, so a busy key
reaches its state as one accumulator per task and micro-batch, never as its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from sparkloom.functions.time import duration_micros
from sparkloom.operators.reduce import Accumulator, folded
from sparkloom.streaming.blocks import ROWS, Blocks, slot_of

SLOTS = 128           # of the keys of a window


class _Folding(StatefulProcessor):
    def __init__(self, acc: Accumulator, names: list[str]):
        self.acc, self.names = acc, names

    def merged(self, total, rows):
        for row in rows:
            total = self.acc.merge(total, pickle.loads(row["__acc"]))
        return total

    def close(self) -> None:
        pass


class WindowAccumulator(_Folding):
    """Merges until the watermark passes the end of the window, then gives the results once.

    A group is a window of a slot of keys. New accumulators are put behind the totals and merged into
    them when there are more of them than totals, so a micro-batch does not read the group.
    """

    def __init__(self, acc: Accumulator, names: list[str], length_ms: int):
        super().__init__(acc, names)
        self.length_ms = length_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals, self.parts = Blocks(handle, "totals"), Blocks(handle, "parts")
        self.sizes = handle.getValueState("sizes", "totals BIGINT, parts BIGINT")

    def _held(self) -> dict:
        held = dict(self.totals.read())
        for key, part in self.parts.read():
            total = held[key] if key in held else self.acc.create()
            held[key] = self.acc.merge(total, pickle.loads(part))
        return held

    def handleInputRows(self, key, rows, timerValues):
        end = int(key[-1]) // 1000 + self.length_ms
        if end > timerValues.getCurrentWatermarkInMs():      # else the window has closed: too late
            known = self.sizes.exists()
            totals, parts = tuple(self.sizes.get()) if known else (0, 0)
            parts += self.parts.add((tuple(row)[1:-2], row["__acc"]) for row in rows)
            if parts > max(totals, ROWS):
                totals, parts = self.totals.replace(self._held().items()), self.parts.replace(())
            self.sizes.update((totals, parts))
            if not known:
                self.handle.registerTimer(end)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.sizes.exists():
            out = Row(*self.names)
            for one, total in self._held().items():
                yield out(*one, key[-1], *self.acc.result(total))
            for state in (self.totals.state, self.parts.state, self.sizes):
                state.clear()


def accumulate_windows(df: DataFrame, time: str, length: str, keys: Sequence[str],
                       values: Sequence[str], acc: Accumulator, schema: str, *,
                       slots: int = SLOTS) -> DataFrame:
    """One row per key and closed window of a watermarked stream, by an accumulator of the user.

    ``time`` is TIMESTAMP and windows are whole milliseconds long. Rows of a window that has closed
    are dropped, as by the built-in aggregates. The keys of a window are dealt over ``slots`` groups,
    each of which a task holds when it closes. Output: keys, ``window_start``, ``window_end``, then
    the columns of ``schema``.
    """
    length_us = duration_micros(length)
    start = F.unix_micros(F.window(time, length).getField("start"))
    by = {**{k: F.col(k) for k in keys}, "window_start": start}
    partial = folded(df, by, values, acc)
    names = partial.columns[:-1]
    out = _schema(df, names, schema)
    found = partial.select(slot_of(names[:-1], slots).alias("__slot"), "*").groupBy(
        "__slot", names[-1]).transformWithState(
        statefulProcessor=WindowAccumulator(acc, out.names, length_us // 1000), outputStructType=out,
        outputMode="append", timeMode="EventTime")
    at = F.col(names[-1]).cast("long")
    return found.select(
        *_typed(df, keys, names), F.timestamp_micros(at).alias("window_start"),
        F.timestamp_micros(at + length_us).alias("window_end"), *out.names[len(names):])


class ClockSession(_Folding):
    """A session per key that every row prolongs and that the clock ends."""

    def __init__(self, acc: Accumulator, names: list[str], gap_ms: int):
        super().__init__(acc, names)
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "acc BINARY, begun BIGINT, ends BIGINT")

    def _ended(self, key, held):
        acc, begun, ends = held
        return Row(*self.names)(*key, begun, ends, *self.acc.result(pickle.loads(acc)))

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        held = tuple(self.state.get()) if self.state.exists() else None
        if held and held[2] <= now:          # rows come before the timers of a micro-batch
            yield self._ended(key, held)
            self.handle.deleteTimer(held[2])
            held = None
        total = pickle.loads(held[0]) if held else self.acc.create()
        if held and held[2] != now + self.gap_ms:
            self.handle.deleteTimer(held[2])
        self.state.update((pickle.dumps(self.merged(total, rows)), held[1] if held else now,
                           now + self.gap_ms))
        self.handle.registerTimer(now + self.gap_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = tuple(self.state.get()) if self.state.exists() else None
        if held and held[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
            yield self._ended(key, held)


def clock_sessions(df: DataFrame, gap: str, keys: Sequence[str], values: Sequence[str],
                   acc: Accumulator, schema: str) -> DataFrame:
    """Sessions by arrival: a key's session ends when nothing has come for ``gap``.

    Output: keys, ``session_start`` (arrival of the first micro-batch), ``session_end`` (last arrival
    plus the gap), then the columns of ``schema``. Needs a processing-time trigger, whose interval is
    the precision of the end.
    """
    partial = folded(df, {k: F.col(k) for k in keys}, values, acc)
    names = partial.columns[:-1]
    out = _schema(df, names, "session_start BIGINT, session_end BIGINT, " + schema)
    found = partial.groupBy(*names).transformWithState(
        statefulProcessor=ClockSession(acc, out.names, duration_micros(gap) // 1000),
        outputStructType=out, outputMode="append", timeMode="ProcessingTime")
    times = [F.timestamp_millis(c).alias(c) for c in ("session_start", "session_end")]
    return found.select(*_typed(df, keys, names), *times, *out.names[len(names) + 2:])


def _schema(df: DataFrame, names: Sequence[str], schema: str) -> StructType:
    empty = df.sparkSession.createDataFrame([], ", ".join(f"{n} STRING" for n in names) + ", " + schema)
    return empty.schema


def _typed(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> list:
    return [F.col(n).cast(df.schema[k].dataType).alias(k) for k, n in zip(keys, names)]
