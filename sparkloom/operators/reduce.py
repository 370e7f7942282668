"""User-defined aggregates with create / add / merge / result, as a two-step aggregation."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


class Accumulator:
    """What a user supplies. Prefer built-in aggregates where they can express the result."""

    def create(self):
        raise NotImplementedError

    def add(self, acc, columns: dict[str, np.ndarray]):
        """Fold a chunk of one key's rows, given as arrays by column name."""
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc) -> tuple:
        """Values of the output columns."""
        raise NotImplementedError


class Reduce(Accumulator):
    """``(a, b) -> a`` over one column, for an associative function."""

    def __init__(self, column: str, fn):
        self.column, self.fn = column, fn

    def create(self):
        return None

    def add(self, acc, columns):
        for value in columns[self.column].tolist():
            acc = value if acc is None else self.fn(acc, value)
        return acc

    def merge(self, a, b):
        return b if a is None else a if b is None else self.fn(a, b)

    def result(self, acc):
        return (acc,)


def aggregate_by_key(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                     acc: Accumulator, schema: str, *, flush_keys: int = 100_000) -> DataFrame:
    """Combine per task, shuffle one accumulator per key and task, merge per key.

    A busy key reaches its merge task as one small accumulator per map task, never as its rows;
    the sort below the merge runs and spills in the JVM, and the merge holds one key at a time.
    ``flush_keys`` bounds the accumulators a map task holds. Keys travel as text and are cast back.
    """
    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, total = None, None
        for frame in frames:
            done = []
            for *key, part in frame.itertuples(index=False, name=None):
                key = tuple(key)
                if key != current:
                    if current is not None:
                        done.append(current + tuple(acc.result(total)))
                    current, total = key, acc.create()
                total = acc.merge(total, pickle.loads(part))
            yield pd.DataFrame(done, columns=out_names, dtype=object)
        if current is not None:
            yield pd.DataFrame([current + tuple(acc.result(total))], columns=out_names,
                               dtype=object)

    partial = folded(df, {k: F.col(k) for k in keys}, values, acc, flush_keys)
    names = partial.columns[:-1]
    key_schema = ", ".join(f"{n} STRING" for n in names)
    empty = df.sparkSession.createDataFrame([], f"{key_schema}, {schema}")
    out_names = empty.columns
    merged = (partial.repartition(*names).sortWithinPartitions(*names)
              .mapInPandas(merge, empty.schema))
    return merged.select(*[F.col(n).cast(df.schema[k].dataType).alias(k)
                           for k, n in zip(keys, names)], *out_names[len(names):])


def folded(df: DataFrame, keys: Mapping[str, Column], values: Sequence[str], acc: Accumulator,
           flush_keys: int = 100_000) -> DataFrame:
    """``(__k0, __k1, ..., __acc)``: one pickled accumulator per task and key, keys as text.

    Rows are folded where they are; of a stream, within a micro-batch.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    as_text = [k.cast("string").alias(n) for k, n in zip(keys.values(), names)]

    def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for frame in frames:
            for key, columns in _chunks(frame, names, values):
                held[key] = acc.add(held[key] if key in held else acc.create(), columns)
            if len(held) > flush_keys:
                yield _partials(held, names)
                held = {}
        if held:
            yield _partials(held, names)

    schema = ", ".join(f"{n} STRING" for n in names)
    return df.select(*as_text, *values).mapInPandas(combine, f"{schema}, __acc BINARY")


def _chunks(frame: pd.DataFrame, names: list[str], values: Sequence[str]) -> Iterator[tuple]:
    """Each key of a batch with its rows as array slices."""
    if not len(frame):
        return
    codes = frame.groupby(names, sort=False, dropna=False).ngroup().to_numpy()
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    ends = np.append(starts[1:], len(order))
    columns = {v: frame[v].to_numpy()[order] for v in values}
    firsts = [frame[n].to_numpy()[order[starts]] for n in names]
    for i, (start, end) in enumerate(zip(starts, ends)):
        yield (tuple(_text(f[i]) for f in firsts),
               {v: column[start:end] for v, column in columns.items()})


def _text(key):
    return key if isinstance(key, str) else None


def _partials(held: dict, names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(list(held), columns=names, dtype=object)
    out["__acc"] = [pickle.dumps(a) for a in held.values()]
    return out
