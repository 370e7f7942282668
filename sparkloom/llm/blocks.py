"""Exact links between two groups of sets, block against block inside tasks.

Pairs are never rows: a block of some hundred sets meets another one in memory and only links come
out. A set is copied once per block of the other side.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK = 256            # sets in a block, about
BLOCK_ITEMS = 1 << 18  # shingles in a block, about
COLUMNS = 1 << 12      # shingles counted at a time


def linked_between(sides: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)``, ``a < b``, between the two sides of each group.

    ``sides`` has ``(group, is_left, node, n)``, each node once per group and side (both sides may have it); ``sets``
    has ``(node, items)``, distinct and sorted. Two sets link when 100 * intersection >= ``percent`` * union.
    """
    def cut(of_left: bool):
        n = F.when(F.col("is_left") == of_left, F.col("n"))
        return F.ceil(F.greatest(F.count(n) / BLOCK, F.sum(n) / BLOCK_ITEMS)).cast("int")

    cuts = sides.groupBy("group").agg(cut(True).alias("left_cuts"), cut(False).alias("right_cuts"))
    mine, theirs = (F.when(F.col("is_left"), F.col(a)).otherwise(F.col(b))
                    for a, b in (("left_cuts", "right_cuts"), ("right_cuts", "left_cuts")))
    placed = sides.join(cuts.where("left_cuts > 0 AND right_cuts > 0"), "group").select(
        "group", "is_left", "node", F.pmod(F.xxhash64("node"), mine).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), theirs - 1)).alias("other"))
    squares = placed.select(
        "group", F.when(F.col("is_left"), F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("is_left"), F.col("other")).otherwise(F.col("own")).alias("j"), "is_left", "node")
    return (squares.join(sets, "node").repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
            .mapInArrow(partial(_squares, percent=percent), "a long, b long"))


def _squares(batches, percent: int):
    """The rows of a square come one after the other."""
    at, nodes, left, sets = None, [], [], []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("group", "i", "j", "node", "is_left")]
        items = batch.column("items")
        for k, (group, i, j, node, is_left) in enumerate(zip(*columns)):
            if (group, i, j) != at and nodes:
                yield from _links(nodes, left, sets, percent)
                nodes, left, sets = [], [], []
            at = (group, i, j)
            nodes.append(node)
            left.append(is_left)
            sets.append(items[k].values.to_numpy().copy())
    if nodes:
        yield from _links(nodes, left, sets, percent)


def _links(nodes: list, left: list, sets: list, percent: int):
    left = np.array(left)
    rows, columns = np.flatnonzero(left), np.flatnonzero(~left)
    if not len(rows) or not len(columns):
        return
    common = shared_items(sets, rows, columns)
    sizes, names = np.array([len(s) for s in sets], np.int64), np.array(nodes, np.int64)
    x, y = np.nonzero(100 * common >= percent * (sizes[rows][:, None] + sizes[columns] - common))
    x, y = names[rows[x]], names[columns[y]]
    x, y = x[x != y], y[x != y]
    if len(x):
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def shared_items(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, by products of 0/1 matrices over the items that several sets have."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, item, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count > 1
    keep = several[item]
    owner, item = owner[keep], (np.cumsum(several) - 1)[item[keep]]
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    common = np.zeros((len(rows), len(columns)), np.int64)
    for begin in range(0, int(several.sum()), COLUMNS):
        part = slice(*np.searchsorted(item, (begin, begin + COLUMNS)))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owner[part], item[part] - begin] = 1
        common += (has[rows] @ has[columns].T).astype(np.int64)
    return common
