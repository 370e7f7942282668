"""Event-time and processing-time windows.

On a stream the grouping key is the window struct, which carries the watermark. On a batch it is
the start alone: half the key bytes in the shuffle; the end is added after the aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.functions.text import pair_text
from sparkloom.functions.time import CLOCK, duration_micros
from sparkloom.operators.running import SLICE, SLICE_ROWS, WHOLE, row_ranks, with_slices

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_FIRST_PASS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def tumbling_key(df: DataFrame, time: str, length: str, slide: str | None = None,
                 offset: str | None = None) -> Column:
    window = F.window(time, length, slide or (length if offset else None), offset)
    return window if df.isStreaming else window.getField("start")


def flat_window(df: DataFrame, key: str, length: str, first: bool = True) -> DataFrame:
    """Replace the window key by ``window_start`` and ``window_end``."""
    others = [c for c in df.columns if c != key]
    if df.isStreaming:
        bounds = [F.col(f"{key}.start").alias("window_start"),
                  F.col(f"{key}.end").alias("window_end")]
    else:
        bounds = [F.col(key).alias("window_start"),
                  (F.col(key) + F.expr(f"INTERVAL {length}")).alias("window_end")]
    return df.select(*bounds, *others) if first else df.select(*others, *bounds)


def window_totals(df: DataFrame, time: str, length: str, keys: Sequence[str] = (),
                  aggs: Sequence[Column] = (), *, slide: str | None = None,
                  offset: str | None = None) -> DataFrame:
    """Aggregate per key and tumbling window, or sliding window when ``slide`` is given.

    ``offset`` moves the window grid, e.g. ``"-8 hours"`` for days that begin at UTC+8 midnight.
    """
    key = tumbling_key(df, time, length, slide, offset)
    grouped = df.groupBy(*keys, key.alias("__window")).agg(*aggs)
    return flat_window(grouped, "__window", length)


def arrival_totals(df: DataFrame, length: str, keys: Sequence[str] = (),
                   aggs: Sequence[Column] = (), *, slide: str | None = None) -> DataFrame:
    """The same on processing time: the clock of the micro-batch that reads the row."""
    timed = df.withColumn("__arrived", F.current_timestamp())
    return window_totals(timed, "__arrived", length, keys, aggs, slide=slide)


def first_in_window(col: str, *order: str) -> Column:
    """Value of the earliest row; what a windowed sum on one field leaves in the others."""
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return F.min_by(col, at).alias(col)


def session_totals(df: DataFrame, time: str, gap: str, keys: Sequence[str],
                   measures: Mapping[str, tuple[str, str | None]], *,
                   rows: int = SLICE_ROWS) -> DataFrame:
    """Sessions per key that close after a silence longer than ``gap``.

    Kinds of measures: sum, count, min, max. A stream uses the native session window. A batch
    does too, but first cuts keys with more than ``rows`` rows into slices of time; only the
    first and last session of a slice can touch a neighbour, and just those are merged.
    """
    first_pass = [_FIRST_PASS[kind](F.lit(1) if col is None else F.col(col)).alias(name)
                  for name, (kind, col) in measures.items()]
    names = list(measures)
    if df.isStreaming:
        out = df.groupBy(*keys, F.session_window(time, gap).alias("__s")).agg(*first_pass)
        return out.select(*keys, F.col("__s.start").alias("session_start"),
                          F.col("__s.end").alias("session_end"), *names)

    sliced = with_slices(df, list(keys), [time], rows)
    local = (sliced.groupBy(*keys, SLICE, F.session_window(time, gap).alias("__s"))
             .agg(*first_pass)
             .select(*keys, SLICE, F.col("__s.start").alias("session_start"),
                     F.col("__s.end").alias("session_end"), *names))
    in_slice = Window.partitionBy(*keys, SLICE).orderBy("session_start")
    edge = ((F.col(SLICE) != WHOLE)
            & (F.lag("session_end").over(in_slice).isNull()
               | F.lead("session_end").over(in_slice).isNull()))
    local = local.withColumn("__edge", edge)

    along = Window.partitionBy(*keys).orderBy("session_start")
    starts = (F.col("session_start") > F.lag("session_end").over(along)).cast("int")
    edges = (local.where("__edge")
             .withColumn("__starts", F.coalesce(starts, F.lit(1)))
             .withColumn("__session", F.sum("__starts").over(along)))
    merged = edges.groupBy(*keys, "__session").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *[_MERGE[kind](name).alias(name) for name, (kind, _) in measures.items()])
    columns = [*keys, "session_start", "session_end", *names]
    return local.where("NOT __edge").select(*columns).unionByName(merged.select(*columns))


def window_elements(df: DataFrame, time: str, length: str, key: str, order: Sequence[str], *,
                    part_rows: int, rows: int = SLICE_ROWS) -> DataFrame:
    """Full-window report: key, bounds and the clock time of every element, in order.

    A report is laid out in numbered parts of ``part_rows`` elements, so that no group is collected
    without a bound; ``n_elements`` is the size of the whole window, in each of its parts.
    """
    timed = df.select(key, *order, F.col(time).alias("__t"),
                      F.window(time, length).getField("start").alias("window_start"))
    ranked = row_ranks(timed, [key, "window_start"], order, "__rank", rows)
    part = F.floor((F.col("__rank") - 1) / part_rows).cast("int")
    whole = ranked.groupBy(key, "window_start").agg(F.count(F.lit(1)).alias("n_elements"))
    listed = F.sort_array(F.collect_list(F.struct("__rank", F.date_format("__t", CLOCK).alias("c"))))
    return flat_window(
        ranked.groupBy(key, "window_start", part.alias("part"))
        .agg(listed.alias("__list")).join(
            whole.withColumnRenamed(key, "__key").withColumnRenamed("window_start", "__start"),
            F.col(key).eqNullSafe(F.col("__key")) & (F.col("window_start") == F.col("__start")))
        .select(key, "part", "n_elements", F.col("window_start").alias("__w"),
                F.array_join(F.transform("__list", lambda x: x["c"]), ", ").alias("times"))
        .withColumn("report", F.format_string(
            "key:%s window:[%s~%s) times:[%s]", F.col(key).cast("string"),
            F.date_format("__w", CLOCK),
            F.date_format(F.col("__w") + F.expr(f"INTERVAL {length}"), CLOCK), "times"))
        .drop("times"),
        "__w", length)


def count_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                  aggs: Sequence[Column], *, slide: int | None = None, rows: int = SLICE_ROWS,
                  partial: bool = False) -> DataFrame:
    """Windows of ``size`` rows per key, fired every ``slide`` rows (default: ``size``).

    A firing looks back over the last ``size`` rows. The unfinished rest of a key fires only with
    ``partial``.
    """
    step = slide or size
    ranked = row_ranks(df, keys, order, "__rank", rows)
    first = F.ceil(F.col("__rank") / step)
    last = F.floor((F.col("__rank") + size - 1) / step)
    fired = ranked.withColumn("firing", F.explode(F.sequence(first, F.greatest(first, last)))
                              if step < size else first)
    if step > size:      # rows between two windows belong to none
        fired = fired.where(F.col("__rank") > F.col("firing") * step - size)
    out = fired.groupBy(*keys, "firing").agg(*aggs, F.max("__rank").alias("__top"))
    if not partial:
        out = out.where(F.col("__top") == F.col("firing") * step)
    return out.drop("__top")


def local_day_offset(hours_east: int) -> str:
    """Grid offset of one-day windows that begin at local midnight."""
    return f"{-hours_east} hours"


def window_label(key: str) -> Column:
    return pair_text(key, F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def window_count(length: str, slide: str) -> int:
    """How many sliding windows hold one row: the factor by which rows multiply."""
    return -(-duration_micros(length) // duration_micros(slide))
