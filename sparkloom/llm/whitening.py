"""Whitening of embeddings on their principal components.

Entries become whole numbers first, so counts, sums and second moments are exact and do not depend on how rows
lie in partitions. Spark adds up per task and dimension; what the driver sees has the size of the number of
dimensions squared, never of the rows. The components come from ``feast``.
"""

from __future__ import annotations

from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.feast import largest_eigenpairs
from sparkloom.llm.workspace import Workspace

SCALE = 64            # steps of a unit
OFFSET = 1_000_000    # added to every whole number
LARGEST = float(1 << 62)
_LOW = 40             # bits of the lower of the two words that an exact sum travels in


class Whitener(NamedTuple):
    """What a fit leaves: ``low = floor(64 c)``, so ``x = low + 1000000``."""
    n: int                  # distinct vectors
    sums: list[int]         # of ``low`` per dimension
    components: np.ndarray  # dimensions x components, unit columns
    values: np.ndarray      # eigenvalues, falling
    trace: float


def whiten(rows: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row and component ``(id, component, n, deviation, whitened, explained, identity_error)``.

    Rows whose vector is null, empty or holds a null or non-finite entry are left out, as are vectors of another
    length than most have (the shorter length on a tie) and entries beyond 2^62 / 64. The covariance is that of the
    distinct vectors, so repeated rows change nothing but get their own rows in the result; a null id stays null.
    Components whose eigenvalue is no more than rounding are not given: equal vectors, or a single one, have none and
    give no rows, like an empty table. ``deviation`` is null where the exact sum does not fit a long. Other columns
    are not read.
    """
    work = Workspace(rows.sparkSession, "whitening")
    codes = encode(rows, work, id_col, vector_col)
    fit = work.keep("fit", codes.select("code").distinct())
    model = fit_whitener(fit, most)
    error = _identity_error(fit, model)
    kind = codes.schema[id_col].dataType.simpleString()
    return codes.mapInArrow(partial(_project, model=model, error=error),
                            f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, "
                            "explained double, identity_error double")


def encode(rows: DataFrame, work: Workspace, id_col: str, vector_col: str) -> DataFrame:
    """``(id, code)``: the whole numbers of each vector as bytes, in the narrowest type that holds them all."""
    kind = rows.schema[id_col].dataType.simpleString()
    codes = work.keep("codes", rows.select(id_col, F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(
        partial(_encode, name=id_col), f"`{id_col}` {kind}, length int, code binary"))
    usual = codes.groupBy("length").count().orderBy(F.desc("count"), "length").head()
    return codes.where(F.col("length") == (usual["length"] if usual else 0)).select(id_col, "code")


def _encode(batches, name: str):
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        kept, lengths, codes = [], [], []
        for k in np.flatnonzero(pc.greater(pc.fill_null(pc.list_value_length(vectors), 0), 0).to_numpy(False)):
            entries = vectors[int(k)].values
            if entries.null_count:
                continue
            low = np.floor(entries.to_numpy(zero_copy_only=False) * SCALE)
            if not (np.abs(low) < LARGEST).all():       # false for NaN and infinity as well
                continue
            low, width = low.astype(np.int64), 1
            while width < 8 and not ((-1 << 8 * width - 1 <= low) & (low < 1 << 8 * width - 1)).all():
                width *= 2
            kept.append(int(k))
            lengths.append(len(low))
            codes.append(bytes([width]) + low.astype(f"<i{width}").tobytes())
        if kept:
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(kept)), pa.array(lengths, pa.int32()),
                                              pa.array(codes, pa.binary())], [name, "length", "code"])


def _decode(column: pa.Array) -> np.ndarray:
    """Rows x dimensions."""
    return np.array([np.frombuffer(c, f"<i{c[0]}", offset=1) for c in column.to_pylist()], np.int64)


def _exact(values: np.ndarray, growth: int) -> np.ndarray:
    """Whole numbers that may be multiplied up to ``growth`` without overflow."""
    most = max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0
    return values if most * growth < 1 << 62 else values.astype(object)


def _words(row) -> bytes:
    """Whole numbers as two words each, so that words of many tasks can be added up."""
    high = np.array([int(v) >> _LOW for v in row], np.int64)
    low = np.array([int(v) & (1 << _LOW) - 1 for v in row], np.int64)
    return np.concatenate((high, low)).tobytes()


def _whole(words: bytes) -> list[int]:
    both = np.frombuffer(words, np.int64)
    high, low = np.split(both, 2)
    return [(int(h) << _LOW) + int(x) for h, x in zip(high, low)]


def _table(numbers: list[int], rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(rows, pa.binary())], ["i", "words"])


def _sums(batches):
    """The count (row -1) and the sums (row 0) of one task."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            low = _decode(batch.column(0))
            part = _exact(low, len(low)).sum(axis=0).astype(object)
            total = part if total is None else total + part
            n += len(low)
    if n:
        yield _table([-1, 0], [_words([n]), _words(total)])


def _moments(batches, centre: list[int]):
    """One row per dimension: the products of the task's centred rows, exact."""
    total, centre = None, np.array(centre, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        low = _decode(batch.column(0)) - centre
        most = max(abs(int(low.max())), abs(int(low.min())), 1)
        if most * most * len(low) < 1 << 53:        # whole doubles: every partial sum is exact
            part = (low.T.astype(float) @ low.astype(float)).astype(np.int64)
        else:
            part = low.T.astype(object) @ low.astype(object)
        total = part.astype(object) if total is None else total + part
    if total is not None:
        yield _table(list(range(len(total))), [_words(row) for row in total])


def _add(batches):
    """Add up equal rows of one partition: one per dimension at most."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(words, np.int64)
            sums[i] = part + sums[i] if i in sums else part
    if sums:
        yield _table(list(sums), [v.tobytes() for v in sums.values()])


def _added(parts: DataFrame) -> dict[int, list[int]]:
    """Rows of all tasks, added up by row number in Spark; as many come back as there are dimensions."""
    total = parts.repartition("i").mapInArrow(_add, "i int, words binary")
    return {row["i"]: _whole(row["words"]) for row in total.collect()}


def fit_whitener(fit: DataFrame, most: int) -> Whitener:
    """Mean, covariance (divisor n) and its largest components, from distinct codes."""
    shape = "i int, words binary"
    counted = _added(fit.mapInArrow(_sums, shape))
    if not counted:
        return Whitener(0, [], np.empty((0, 0)), np.empty(0), 0.0)
    n, sums = counted[-1][0], counted[0]
    centre = [(2 * s + n) // (2 * n) for s in sums]            # the mean, rounded
    rest = [s - n * c for s, c in zip(sums, centre)]           # what rounding left, times n
    products = _added(fit.mapInArrow(partial(_moments, centre=centre), shape))
    size = len(sums)
    covariance = np.array([[(n * products[i][j] - rest[i] * rest[j]) / (n * n) for j in range(size)]
                           for i in range(size)])
    values, components = largest_eigenpairs(covariance, most)
    return Whitener(n, sums, components, values, float(np.trace(covariance)))


def _whitened(low: np.ndarray, model: Whitener) -> np.ndarray:
    """Rows x components. Distances from the mean are exact before they are rounded once."""
    centre = [(2 * s + model.n) // (2 * model.n) for s in model.sums]
    rest = np.array([(s - model.n * c) / model.n for s, c in zip(model.sums, centre)])
    centred = (low - np.array(centre, np.int64)) - rest
    return np.einsum("rd,dk->rk", centred, model.components) / np.sqrt(model.values)


def _covariances(batches, model: Whitener):
    """Sums of products, and of the values (second index -1), of one task's whitened rows."""
    k = len(model.values)
    products, sums = np.zeros((k, k)), np.zeros(k)
    for batch in batches:
        if batch.num_rows:
            w = _whitened(_decode(batch.column(0)), model)
            products += w.T @ w
            sums += w.sum(axis=0)
    i, j = np.indices((k, k)).reshape(2, -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((i, np.arange(k))).astype(np.int32)),
         pa.array(np.concatenate((j, np.full(k, -1))).astype(np.int32)),
         pa.array(np.concatenate((products.ravel(), sums)))], ["i", "j", "total"])


def _identity_error(fit: DataFrame, model: Whitener) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured on them."""
    k = len(model.values)
    if not k:
        return 0.0
    found = (fit.mapInArrow(partial(_covariances, model=model), "i int, j int, total double")
             .groupBy("i", "j").agg(F.sum("total").alias("total")).collect())
    products, means = np.zeros((k, k)), np.zeros(k)
    for i, j, total in found:
        if j < 0:
            means[i] = total / model.n
        else:
            products[i, j] = total / model.n
    return float(np.abs(products - np.outer(means, means) - np.eye(k)).max())


def _deviations(low: np.ndarray, model: Whitener) -> list[int | None]:
    """The sum over dimensions of (n x - sum)^2, exact."""
    sums = np.array(model.sums, object)
    reach = model.n * max(abs(int(low.max())), abs(int(low.min()))) + max(abs(s) for s in model.sums)
    if reach * reach * low.shape[1] < 1 << 63:
        away = model.n * low - sums.astype(np.int64)
    else:
        away = model.n * low.astype(object) - sums
    return [int(v) if v < 1 << 63 else None for v in (away * away).sum(axis=1)]


def _project(batches, model: Whitener, error: float):
    k = len(model.values)
    for batch in batches:
        if not k or not batch.num_rows:
            continue
        low = _decode(batch.column(1))
        r = len(low)
        each = np.repeat(np.arange(r), k)
        deviations = pa.array(_deviations(low, model), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), r).astype(np.int32)),
             pa.array(np.full(r * k, model.n)), deviations.take(pa.array(each)),
             pa.array(_whitened(low, model).ravel()), pa.array(np.tile(model.values / model.trace, r)),
             pa.array(np.full(r * k, error))],
            [batch.schema.names[0], "component", "n", "deviation", "whitened", "explained", "identity_error"])
