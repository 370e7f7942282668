"""Window join, interval join and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions.time import duration_micros, micros_of
from sparkloom.operators.windows import flat_window, tumbling_key

BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when a bounded count proves the size; otherwise the plan shuffles.

    Meant for inputs whose size the optimizer cannot know, such as JDBC tables. For files leave
    the choice to the optimizer, which checks their bytes against its own threshold.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def _same_keys(on: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(l) == F.col(r) for l, r in on.items()])


def window_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], left_time: str,
                right_time: str, length: str) -> DataFrame:
    """Inner join of rows with equal keys in the same tumbling window.

    ``on`` maps left to right column names; all names must differ between the sides. The window
    is part of the join key, so the history of a busy key spreads over its windows; a busy window
    is split at run time by the skew join of adaptive execution.
    """
    a = left.withColumn("__window", tumbling_key(left, left_time, length))
    b = right.withColumn("__window_r", tumbling_key(right, right_time, length))
    joined = a.join(b, _same_keys({**on, "__window": "__window_r"}))
    return flat_window(joined.drop("__window_r"), "__window", length, first=False)


def interval_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], left_time: str,
                  right_time: str, lower: str, upper: str, *, bucket_spans: int = 2) -> DataFrame:
    """Inner join of equal keys with ``left + lower <= right <= left + upper``, bounds included.

    Durations may start with ``-``. Time buckets join the key: a left row lies in one bucket, a
    right row is offered to the one or two buckets it can match. Work per row then depends on its
    neighbourhood in time, not on the whole history of its key, and a busy key spreads over tasks.
    """
    low, high = _signed_micros(lower), _signed_micros(upper)
    if high < low:
        raise ValueError("upper must not lie before lower")
    width = F.lit(max(high - low, 1) * bucket_spans)
    right_micros = micros_of(right_time)
    a = left.withColumn("__bucket", F.floor(micros_of(left_time) / width))
    b = right.withColumn("__bucket_r", F.explode(F.sequence(
        F.floor((right_micros - high) / width), F.floor((right_micros - low) / width))))
    near = ((F.col(right_time) >= F.col(left_time) + _interval(low))
            & (F.col(right_time) <= F.col(left_time) + _interval(high)))
    joined = a.join(b, _same_keys({**on, "__bucket": "__bucket_r"}) & near)
    return joined.drop("__bucket", "__bucket_r")


def _signed_micros(text: str) -> int:
    text = text.strip()
    return -duration_micros(text[1:]) if text.startswith("-") else duration_micros(text)


def _interval(micros: int) -> Column:
    """Interval literal; a literal, so that a stream can derive its state bounds from it."""
    sign = "-" if micros < 0 else ""
    seconds, rest = divmod(abs(micros), 1_000_000)
    return F.expr(f"INTERVAL '{sign}{seconds}.{rest:06d}' SECOND")


def last_per_key(dim: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the latest by ``order``; combined map-side, no sort of a key's rows."""
    rest = [c for c in dim.columns if c not in keys]
    return (dim.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.col(order)).alias("__row"))
            .select(*keys, "__row.*").select(*dim.columns))


def lookup_join(facts: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Sequence[str], *,
                missing: Mapping[str, object] | str = "left",
                broadcast_rows: int | None = None) -> DataFrame:
    """Add the columns ``take`` of a dimension that is unique on its key.

    A key that the dimension has twice stops the query, as it would multiply facts; reduce such a
    dimension with ``last_per_key`` first.
    ``missing``: a mapping of default values, ``"left"`` (null), ``"inner"`` (drop the row) or
    ``"fail"``. With ``broadcast_rows`` the size of the dimension is counted up to that bound and
    it is broadcast below it; without, the optimizer decides from its bytes.
    """
    names = {r: f"__dim_{r}" for r in on.values()}
    once = F.when(F.count(F.lit(1)) == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("more than one dimension row for key "),
                               F.concat_ws(",", *names.values()))).cast("boolean"))
    small = (dim.select(*[F.col(r).alias(n) for r, n in names.items()],
                        *[F.col(c).alias(f"__take_{c}") for c in take])
             .groupBy(*names.values()).agg(*[F.first(f"__take_{c}").alias(f"__take_{c}") for c in take],
                                           once.alias("__found"))
             .where("__found"))
    if broadcast_rows is not None:
        small = broadcast_if_small(small, broadcast_rows)
    joined = facts.join(small, _same_keys({l: names[r] for l, r in on.items()}),
                        "inner" if missing == "inner" else "left")
    taken = []
    for c in take:
        value = F.col(f"__take_{c}")
        if isinstance(missing, Mapping) and c in missing:
            value = F.coalesce(value, F.lit(missing[c]))
        elif missing == "fail":
            value = F.when(F.col("__found"), value).otherwise(
                F.raise_error(F.concat(F.lit("no dimension row for key "),
                                       F.concat_ws(",", *on))))
        taken.append(value.alias(c))
    return joined.select(*facts.columns, *taken)
