"""Keyed state and timers: stream twins of the running, newness, changelog and late operators.

A processor sees the rows of a key in one micro-batch in no promised order, so those that depend
on order sort them by an explicit sequence. The size of a micro-batch (maxFilesPerTrigger,
maxOffsetsPerTrigger) bounds what is sorted; for keys that may fill a whole micro-batch use
streaming.traced, which keeps no rows in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from sparkloom.functions.time import GRAIN_PATTERNS, duration_micros, in_zone
from sparkloom.operators.newness import FLAGS
from sparkloom.streaming.blocks import ROWS, Alarm, Blocks, plain_key, slot_of

SLOTS = 512

def _ddl(df: DataFrame, columns: Sequence[str]) -> list:
    return [df.schema[c] for c in columns]


class _Stored(StatefulProcessor):
    """One value per key."""

    kind = "STRING"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", f"value {self.kind}")

    def load(self):
        return self.value.get()[0] if self.value.exists() else None

    def handleInitialState(self, key, initialState, timerValues):
        """Start from a value that another query has saved."""
        if initialState["value"] is not None:
            self.value.update((initialState["value"],))

    def close(self) -> None:
        pass


class RunningMax(_Stored):
    def __init__(self, column: str, seq: str, names: list[str], kind: str):
        self.column, self.seq, self.names, self.kind = column, seq, names, kind

    def handleInputRows(self, key, rows, timerValues):
        best = self.load()
        out = Row(*self.names)
        for row in sorted(rows, key=lambda r: r[self.seq]):
            value = row[self.column]
            if value is not None:
                best = value if best is None else max(best, value)
            yield out(*row, best)
        if best is not None:
            self.value.update((best,))


def running_max(df: DataFrame, keys: Sequence[str], seq: str, column: str,
                name: str = "running_max", start: DataFrame | None = None) -> DataFrame:
    """Every row with the highest value of its key so far.

    ``start`` (keys and ``value``, one row per key) is what a new query begins with.
    """
    schema = StructType(list(df.schema.fields)).add(name, df.schema[column].dataType)
    processor = RunningMax(column, seq, schema.names, df.schema[column].dataType.simpleString())
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="None",
        initialState=start.groupBy(*keys) if start is not None else None)


_VISIT_SIZE = 1 + len(GRAIN_PATTERNS)      # time and one text per grain


class Newness(StatefulProcessor):
    """Remembers the last visits of many keys, each as its time and the texts of its periods."""

    def __init__(self, keys: list[str], seq: str, names: list[str], remember: str):
        self.keys, self.seq, self.names, self.remember = keys, seq, names, remember

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.visits = Blocks(handle, "visits")

    def handleInputRows(self, key, rows, timerValues):
        visits, found = dict(self.visits.read()), {}
        for row in rows:
            found.setdefault(plain_key(row[k] for k in self.keys), []).append(row)
        out = Row(*self.names)
        for one, own in found.items():
            seen = visits.get(one)
            for row in sorted(own, key=lambda r: (r["__micros"], r[self.seq])):
                given, now = tuple(row)[1:-_VISIT_SIZE], tuple(row)[-_VISIT_SIZE:]
                flags = [1] * _VISIT_SIZE if seen is None else [
                    0, *[int(new > old) for new, old in zip(now[1:], seen[1:])]]
                yield out(*given, *flags)
                seen = now if seen is None or self.remember == "last" else max(seen, now)
            visits[one] = seen
        self.visits.replace(visits.items())

    def close(self) -> None:
        pass


def newness(df: DataFrame, keys: Sequence[str], time: str, seq: str, remember: str = "last",
            zone: str = "UTC", *, slots: int = SLOTS) -> DataFrame:
    """Every visit with its newness flags; ``time`` is TIMESTAMP.

    Keys are dealt over ``slots`` groups; a task holds the last visits of one, and its rows of a micro-batch.
    """
    schema = StructType(list(df.schema.fields))
    for flag in FLAGS:
        schema = schema.add(flag, "integer")
    local = in_zone(time, zone)
    ready = df.select(
        slot_of(keys, slots).alias("__slot"), *df.columns, F.unix_micros(time).alias("__micros"),
        *[F.date_format(local, pattern).alias(f"__{g}") for g, pattern in GRAIN_PATTERNS.items()])
    processor = Newness(list(keys), seq, schema.names, remember)
    return ready.groupBy("__slot").transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="None")


class Changelog(_Stored):
    kind = "BIGINT"

    def __init__(self, seq: str, column: str, names: list[str]):
        self.seq, self.column, self.names = seq, column, names

    def handleInputRows(self, key, rows, timerValues):
        total = self.load()
        out = Row(*self.names)
        for row in sorted(rows, key=lambda r: r[self.seq]):
            if total is not None:
                yield out(*key, row[self.seq], 1, False, total)
            total = (total or 0) + (row[self.column] or 0)
            yield out(*key, row[self.seq], 2, True, total)
        if total is not None:
            self.value.update((total,))


def changelog(df: DataFrame, keys: Sequence[str], seq: str, column: str,
              total: str = "total") -> DataFrame:
    """Withdraw and add rows of a keyed sum of a BIGINT column."""
    schema = StructType(_ddl(df, [*keys, seq]))
    for name, kind in (("step", "integer"), ("is_add", "boolean"), (total, "long")):
        schema = schema.add(name, kind)
    processor = Changelog(seq, column, schema.names)
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="None")


class LateTagger(StatefulProcessor):
    """Marks rows whose window has closed. Keeps no state."""

    def __init__(self, end: str, lateness_ms: int, names: list[str]):
        self.end, self.lateness_ms, self.names = end, lateness_ms, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        out = Row(*self.names)
        for row in rows:
            values = row.asDict(recursive=False)
            closes = values.pop("__end_ms") + self.lateness_ms
            values.pop("__spread")
            yield out(*values.values(), closes <= watermark)

    def close(self) -> None:
        pass


def tag_late(df: DataFrame, time: str, length: str, lateness: str = "0 seconds", *,
             name: str = "is_late", spread: int | None = None) -> DataFrame:
    """All rows of a watermarked stream, with a mark on those that come too late.

    A watermark operator drops late rows; this one hands them on, so that they can be kept aside.
    The rows are dealt over ``spread`` groups (by default the shuffle partitions of the session) by a
    hash of their content and time; keep the number for the life of a checkpoint. Run it with a
    processing-time trigger: under ``availableNow`` this kind of query never reports its end.
    """
    spread = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = F.window(time, length).getField("end")
    ready = df.withColumn("__end_ms", F.unix_millis(end)).withColumn(
        "__spread", F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    schema = StructType(list(df.schema.fields)).add(name, "boolean")
    processor = LateTagger("__end_ms", duration_micros(lateness) // 1000, schema.names)
    return ready.groupBy("__spread").transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append",
        timeMode="ProcessingTime")


class ReviewTimer(StatefulProcessor):
    """What is known of many orders, the due time of the order and the time of its review, and a
    timer at the earliest due time, which asks whether the reviews came in time."""

    def __init__(self, wait_ms: int, names: list[str], event_time: bool):
        self.wait_ms, self.names, self.event_time = wait_ms, names, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known, self.alarm = Blocks(handle, "known"), Alarm(handle)

    def _now(self, timerValues) -> int:
        return (timerValues.getCurrentWatermarkInMs() if self.event_time
                else timerValues.getCurrentProcessingTimeInMs())

    def handleInputRows(self, key, rows, timerValues):
        now, new, first = self._now(timerValues), [], None
        for row in rows:
            if row["kind"] not in ("order", "review"):
                continue
            at = int(row["at_ms"])
            # A review has a due time too, to be forgotten if its order never shows up.
            due = max(at + self.wait_ms, now + 1)
            first = due if first is None else min(first, due)
            new.append((plain_key((row["user_id"], row["order_id"])), row["kind"], at, due))
            if len(new) == ROWS:
                self.known.add(new)
                new.clear()
        self.known.add(new)
        self.alarm.set(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.alarm.rung()
        reached = max(expiredTimerInfo.getExpiryTimeInMs(), self._now(timerValues) - 1)
        known: dict = {}
        for one, *rest in self.known.read():
            known.setdefault(one, {})[rest[0]] = rest
        out, later = Row(*self.names), []
        for one, kinds in known.items():
            _, review, forget = kinds.get("review", (None, None, None))
            due = kinds["order"][2] if "order" in kinds else forget
            if due > reached:
                later.append((one, kinds, due))
            elif "order" in kinds:
                yield out(*one, "reviewed" if review is not None and review <= due else "auto")
        self.known.replace((one, *rest) for one, kinds, _ in later for rest in kinds.values())
        self.alarm.set(min((due for _, _, due in later), default=None))

    def close(self) -> None:
        pass


def review_timers(df: DataFrame, wait: str, *, event_time: bool = True,
                  slots: int = SLOTS) -> DataFrame:
    """Orders and reviews in one stream to one row per order once its wait is over.

    Input columns: ``user_id``, ``order_id``, ``kind`` (``order`` or ``review``) and ``ts``,
    watermarked when ``event_time``; else the clock decides. Orders are dealt over ``slots`` groups by
    user and number, so a busy user is no bottleneck; a timer looks at what waits in one group.
    """
    ready = df.select("user_id", "order_id", "kind", "ts", F.unix_millis("ts").alias("at_ms"))
    schema = StructType(_ddl(df, ["user_id", "order_id"])).add("status", "string")
    processor = ReviewTimer(duration_micros(wait) // 1000, schema.names, event_time)
    slot = slot_of(["user_id", "order_id"], slots).alias("__slot")
    return ready.select(slot, "*").groupBy("__slot").transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append",
        timeMode="EventTime" if event_time else "ProcessingTime")
