"""Running (prefix) aggregates per key that stay parallel when one key holds much of the data.

A plain window over ``partitionBy(key).orderBy(time)`` sorts a whole key in one task. Here a key
with more rows than ``rows`` is cut into slices along its own order, at quantiles of the whole order,
so that neither an outlier nor a burst of equal times leaves a large slice. Each slice is one window
group, and starts with one extra *carry row* that holds the aggregate of all earlier slices, so
slices run side by side and the result equals the plain window. Keys below the limit keep one
slice and get no carry row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.session import stored

SLICE_ROWS = 2_000_000
SLICE = "__slice"
WHOLE = -1          # slice number of a key that is not cut

_OVER_ROWS = {
    "sum": F.sum, "count": F.sum, "max": F.max, "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
}

Measures = Mapping[str, tuple[str, "str | Column | None"]]


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                rows: int = SLICE_ROWS) -> DataFrame:
    """Add the slice number: ``WHOLE`` for ordinary keys, else growing along the order of a cut key.

    One pass counts the keys; the input must give the same rows each time it is read. The rows of cut keys
    are dealt by ranges of key and order, whose bounds are sampled, and stored with their range, so that
    all later passes see the same slices. Only rows that are equal in keys and order can't be parted.
    The list of cut keys holds at most (all rows / ``rows``) entries, which bounds the broadcast:
    10^13 input rows give at most 5 million short entries, usually a handful.
    """
    n = F.count(F.lit(1)).alias("__n")
    names = [f"__k_{k}" for k in keys]
    cut = (df.groupBy(*[F.col(k).alias(c) for k, c in zip(keys, names)]).agg(n)
           .where(F.col("__n") > rows))
    found = cut.agg(F.sum("__n")).head()[0]
    whole = F.lit(WHOLE).cast("long").alias(SLICE)
    if not found:
        return df.select(*df.columns, whole)
    busy = df
    if keys:
        same = F.lit(True)
        for k, c in zip(keys, names):
            same = same & F.col(k).eqNullSafe(F.col(c))
        cut = F.broadcast(cut.select(*names))
        busy = df.join(cut, same, "left_semi")
    # Twice as many slices as the count asks for, since sampled bounds are not exact.
    ranged = busy.repartitionByRange(-(-2 * found // rows), *keys, *order)
    sliced = stored(ranged.select(*df.columns, F.spark_partition_id().cast("long").alias(SLICE)), "slices")
    return sliced if not keys else df.join(cut, same, "left_anti").select(
        *df.columns, whole).unionByName(sliced)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Measures, *,
            inclusive: bool = True, rows: int = SLICE_ROWS) -> DataFrame:
    """Append running aggregates in the given order, per key (no key: over the whole input).

    ``measures`` maps an output name to (kind, column); kinds are sum, count, max, min and last
    (latest value that is not missing). ``inclusive=False`` leaves out the current row.
    ``order`` must be unique within a key for a repeatable result.
    """
    keys, order = list(keys), list(order)
    work = with_slices(df, keys, order, rows)
    inputs = {}
    for i, (kind, col) in enumerate(measures.values()):
        value = F.lit(1) if col is None else (F.col(col) if isinstance(col, str) else col)
        if kind == "count":
            value = (F.lit(1) if col is None else value.isNotNull()).cast("long")
        inputs[f"__in{i}"] = value
    work = work.withColumns({**inputs, "__own": F.lit(1)})

    kinds = [kind for kind, _ in measures.values()]
    carry = _carry_rows(work, keys, order, kinds)
    rows_and_carry = work.unionByName(carry, allowMissingColumns=True)

    frame = (Window.partitionBy(*keys, SLICE).orderBy("__own", *order)
             .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    outputs = {}
    for i, (name, kind) in enumerate(zip(measures, kinds)):
        value = _OVER_ROWS[kind](F.col(f"__in{i}")).over(frame)
        outputs[name] = F.coalesce(value, F.lit(0)) if kind == "count" else value
    return (rows_and_carry.withColumns(outputs).where("__own = 1")
            .select(*df.columns, *measures))


def _carry_rows(work: DataFrame, keys: list[str], order: list[str],
                kinds: list[str]) -> DataFrame:
    totals = work.where(F.col(SLICE) != WHOLE).groupBy(*keys, SLICE)
    per_slice = []
    for i, kind in enumerate(kinds):
        col = F.col(f"__in{i}")
        if kind == "last":
            at = F.when(col.isNotNull(), F.struct(*order))
            per_slice.append(F.max_by(col, at).alias(f"__in{i}"))
        else:
            per_slice.append(_OVER_ROWS[kind](col).alias(f"__in{i}"))
    # One row per slice of a cut key, so this window is small.
    earlier = (Window.partitionBy(*keys).orderBy(SLICE)
               .rowsBetween(Window.unboundedPreceding, -1))
    return totals.agg(*per_slice).select(
        *keys, SLICE, F.lit(0).alias("__own"),
        *[_OVER_ROWS[kind](F.col(f"__in{i}")).over(earlier).alias(f"__in{i}")
          for i, kind in enumerate(kinds)])


def row_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank",
              rows: int = SLICE_ROWS) -> DataFrame:
    """1, 2, 3, ... per key in the given order."""
    return running(df, keys, order, {name: ("count", None)}, rows=rows)


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                name: str = "running_max", rows: int = SLICE_ROWS) -> DataFrame:
    """Highest value of the key up to and with each row."""
    return running(df, keys, order, {name: ("max", value)}, rows=rows)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                name: str = "running_sum", rows: int = SLICE_ROWS) -> DataFrame:
    """The trace of a rolling sum: one updated total per input row."""
    return running(df, keys, order, {name: ("sum", value)}, rows=rows)
