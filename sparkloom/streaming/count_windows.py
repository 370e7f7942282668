"""Count windows of a stream: fired by the number of rows, not by time."""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

# What a window can tell of a column; nulls are skipped.
MEASURES = {"count": len, "sum": lambda v: sum(v) if v else None,
            "min": lambda v: min(v, default=None), "max": lambda v: max(v, default=None)}


class Ring(StatefulProcessor):
    """The last rows of a key and how many there have been; ``slide`` more rows fire a window."""

    def __init__(self, size: int, slide: int, order: str, columns: StructType,
                 measures: Mapping[str, tuple[str, str | None]], names: list[str]):
        self.size, self.slide, self.order = size, slide, order
        self.columns, self.measures, self.names = columns, dict(measures), names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n BIGINT")
        self.last = handle.getListState("last", self.columns)

    def handleInputRows(self, key, rows, timerValues):
        n = self.seen.get()[0] if self.seen.exists() else 0
        ring = deque((tuple(r) for r in self.last.get()) if self.last.exists() else (), maxlen=self.size)
        out, names = Row(*self.names), self.columns.names
        for row in sorted(rows, key=lambda r: r[self.order]):
            ring.append(tuple(row[c] for c in names))
            n += 1
            if n % self.slide == 0:
                yield out(*key, n // self.slide, *[self._measure(ring, *m) for m in self.measures.values()])
        self.seen.update((n,))
        self.last.put(list(ring))

    def _measure(self, ring, kind: str, column: str | None):
        if column is None:
            return len(ring)
        place = self.columns.names.index(column)
        return MEASURES[kind]([r[place] for r in ring if r[place] is not None])

    def close(self) -> None:
        pass


def stream_count_windows(df: DataFrame, keys: Sequence[str], order: str, size: int,
                         measures: Mapping[str, tuple[str, str | None]], slide: int | None = None) -> DataFrame:
    """A window of a key's last ``size`` rows after every ``slide`` rows (default: ``size``).

    ``measures`` names results as ``(kind, column)``, kinds being count, sum, min and max; ``("count", None)``
    counts rows. Output: keys, ``firing`` (1, 2, ...) and the measures. Windows go on across micro-batches; state
    is ``size`` rows of the columns used. Rows of a key are ordered by ``order`` within a micro-batch and in order
    of arrival beyond it.
    """
    used = sorted({c for _, c in measures.values() if c} | {order})
    schema = StructType([df.schema[k] for k in keys]).add("firing", "long")
    for name, (kind, column) in measures.items():
        schema = schema.add(name, "long" if kind == "count" else df.schema[column].dataType)
    columns = StructType([df.schema[c] for c in used])
    return df.select(*dict.fromkeys([*keys, *used])).groupBy(*keys).transformWithState(
        statefulProcessor=Ring(size, slide or size, order, columns, measures, schema.names),
        outputStructType=schema, outputMode="append", timeMode="None")
