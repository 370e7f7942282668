"""Enriching a stream by the version of a dimension that held at each record's own time."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from sparkloom.streaming.blocks import ROWS, Alarm, Blocks, plain_key, slot_of

SLOTS = 512


class AsOf(StatefulProcessor):
    """Versions by the time they begin, and the events that wait for the watermark, of many keys.

    When the watermark has passed an event, all versions up to it are known. A timer stands at the
    earliest event that waits; then the group is read as a whole, and of the versions behind the
    watermark only the newest of a key is kept.
    """

    def __init__(self, keys: list[str], event: StructType, version: StructType, names: list[str]):
        self.keys, self.event, self.version, self.names = keys, event, version, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions, self.held = Blocks(handle, "versions"), Blocks(handle, "held")
        self.alarm = Alarm(handle)

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        ruled, waiting, first = [], [], None
        for row in rows:
            one, at = plain_key(row[k] for k in self.keys), row["__at"]
            if row["__version"] is not None:
                ruled.append((one, at, _values(row["__version"], self.version)))
            elif at // 1000 >= watermark:                    # else it comes too late
                waiting.append((one, at, _values(row["__event"], self.event)))
                first = at if first is None else min(first, at)
            for rows_, state in ((ruled, self.versions), (waiting, self.held)):
                if len(rows_) == ROWS:
                    state.add(rows_)
                    rows_.clear()
        self.versions.add(ruled)
        self.held.add(waiting)
        self.alarm.set(None if first is None else first // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.alarm.rung()
        watermark = timerValues.getCurrentWatermarkInMs()
        known: dict = {}
        for one, at, version in self.versions.read():
            known.setdefault(one, {})[at] = version          # the later one to come counts
        begins = {one: sorted(versions) for one, versions in known.items()}
        out, later = Row(*self.names), []
        for one, at, event in self.held.read():
            if at // 1000 >= watermark:
                later.append((one, at, event))
            elif place := bisect_right(begins.get(one, ()), at):
                yield out(*event, *known[one][begins[one][place - 1]])
        self.held.replace(later)
        if later:
            self.alarm.set(min(at for _, at, _ in later) // 1000 + 1)
        kept = {one: at[max(0, bisect_right(at, watermark * 1000 - 1) - 1):] for one, at in begins.items()}
        if any(len(kept[one]) < len(known[one]) for one in kept):
            self.versions.replace((one, at, known[one][at]) for one in kept for at in kept[one])

    def close(self) -> None:
        pass


def _values(part, kind: StructType) -> tuple:
    return tuple(part[name] for name in kind.names)


def version_feed(events: DataFrame, versions: DataFrame, on: Mapping[str, str], time: str,
                 valid_from: str, take: Sequence[str], spread: int = 1) -> DataFrame:
    """Events and versions as one stream: key, slot, time and either the event or the version.

    ``on`` maps event columns to version columns. ``spread`` deals the events of a key over so many
    slots, each of which gets its own copy of the key's versions: for keys with many events.
    """
    keys = [F.col(e).alias(f"__k{i}") for i, e in enumerate(on)]
    slot = F.pmod(F.xxhash64(*events.columns), F.lit(spread)).cast("int")
    given = events.select(*keys, slot.alias("__slot"), F.col(time).alias("__time"),
                          F.struct(*events.columns).alias("__event"))
    version = F.struct(*take)
    same = [F.col(v).alias(f"__k{i}") for i, v in enumerate(on.values())]
    slots = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("__slot")
    ruled = versions.select(*same, slots, F.col(valid_from).alias("__time"), version.alias("__version"))
    return given.unionByName(ruled, allowMissingColumns=True)


def as_of_versions(feed: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Every event with the columns of the version that held at its time, from a marked feed.

    The feed of ``version_feed`` has its watermark on ``__time``. An event is given once the
    watermark has passed it. Events before the first version of their key, without a key or a time,
    or behind the watermark, are dropped; of two versions from one instant the later one to come
    counts. The keys are dealt over ``slots`` groups, which a task holds one at a time.
    """
    event, version = feed.schema["__event"].dataType, feed.schema["__version"].dataType
    keys = [c for c in feed.columns if c.startswith("__k")]
    # One condition with the time in it, which stays behind the watermark: every row moves the clock.
    whole = F.when(F.col("__time").isNotNull(), F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys)))
    ready = feed.where(F.coalesce(whole, F.lit(False))).select(
        *keys, "__slot", slot_of(keys, slots).alias("__keys"), F.unix_micros("__time").alias("__at"), "__event", "__version")
    schema = StructType([*event.fields, *version.fields])
    return ready.groupBy("__keys", "__slot").transformWithState(
        statefulProcessor=AsOf(keys, event, version, schema.names), outputStructType=schema,
        outputMode="append", timeMode="EventTime")
