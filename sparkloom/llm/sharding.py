"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

Rows lie in hashed partitions. How many rows each partition sends to each cell of each shard is drawn
beforehand: under a uniform permutation with fixed cell sizes these counts have a multivariate
hypergeometric law. Each partition is permuted locally and cut by its row of the matrix, the pieces
are exchanged, and every cell is permuted again. Sizes and positions are known before any row moves,
so no shard is ever counted or gathered. Rows are handled by DataFrame operations only; the driver
draws the matrix from the partitions' counts (partitions x cells numbers, both bounded below).
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window, functions as F

CELL_ROWS = 1 << 24       # rows of a cell at most
CELLS_PER_SHARD = 16      # at least, so that a shard is made by several tasks
MOST_PARTITIONS = 2048


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` from ``good + bad`` without replacement, by inversion at the mode."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low

    def choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    below = above = mode
    p_below = p_above = math.exp(choose(good, mode) + choose(bad, draws - mode)
                                 - choose(good + bad, draws))
    u = rng.random() - p_above
    while u >= 0 and (below > low or above < high):
        if above < high:
            p_above *= (good - above) * (draws - above) / ((above + 1) * (bad - draws + above + 1))
            above += 1
            u -= p_above
            if u < 0:
                return above
        if below > low:
            p_below *= below * (bad - draws + below) / ((good - below + 1) * (draws - below + 1))
            below -= 1
            u -= p_below
            if u < 0:
                return below
        if p_above < 1e-300 and p_below < 1e-300:
            break   # what is left of u is rounding
    return mode


def communication_matrix(rng: random.Random, parts: list[int], cells: list[int]) -> list[list[int]]:
    """Counts with these row and column sums, as a uniform permutation would give them."""
    room, rows = list(cells), []
    total = sum(room)
    for size in parts:
        row, left, rest = [], size, total
        for have in room:
            n = hypergeometric(rng, have, rest - have, left)
            row.append(n)
            left, rest = left - n, rest - have
        room = [a - b for a, b in zip(room, row)]
        total -= size
        rows.append(row)
    return rows


def uniform_shards(df: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: a uniform random permutation cut into equal shards.

    Row counts of shards differ by one at most and slots run from 0 in each shard. Equal rows are
    interchangeable; nulls are values like others. Columns named ``shard`` or ``slot`` are replaced.
    An empty table gives an empty table. The result depends on rows and seed alone, not on how the
    rows are stored, so a repeated task repeats its rows.
    """
    df = df.drop("shard", "slot")
    columns = df.columns
    n_parts = min(MOST_PARTITIONS,
                  max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def draw(turn: int):
        return F.xxhash64(F.lit(seed), F.lit(turn), *[F.col(f"`{c}`") for c in columns])

    part = F.pmod(draw(0), F.lit(n_parts)).cast("int").alias("__part")
    sizes = {r["__part"]: r["n"] for r in df.select(part).groupBy("__part")
             .agg(F.count("*").alias("n")).collect()}     # n_parts rows at most
    total = sum(sizes.values())
    per_shard = max(CELLS_PER_SHARD, -(-total // (shards * CELL_ROWS)))
    cells, starts = [], []
    for shard in range(shards):
        own = total // shards + (shard < total % shards)
        cuts = [own * k // per_shard for k in range(per_shard + 1)]
        starts += cuts[:-1]
        cells += [b - a for a, b in zip(cuts, cuts[1:])]
    matrix = communication_matrix(random.Random(seed), [sizes.get(p, 0) for p in range(n_parts)],
                                  cells)
    pieces = []
    for p, row in enumerate(matrix):
        stride, at = max(1, sizes.get(p, 0) // len(cells)), 0
        for cell, n in enumerate(row):
            for block in range(at // stride, (at + n - 1) // stride + 1) if n else ():
                pieces.append({"p": p, "b": block, "c": cell, "s": stride, "f": at, "t": at + n})
            at += n
    plan = df.sparkSession.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps(pieces)), "array<struct<p int, b long, c int, s long, f long, t long>>")))
    strides = F.array(*[F.lit(max(1, sizes.get(p, 0) // len(cells))) for p in range(n_parts)])
    begins = F.array(*[F.lit(s) for s in starts])

    local = Window.partitionBy("__part").orderBy("__first", "__second")
    placed = (df.select("*", part, draw(1).alias("__first"), draw(2).alias("__second"))
              .withColumn("__rank", F.row_number().over(local).cast("long") - 1)
              .withColumn("__block", F.floor(F.col("__rank")
                                             / F.get(strides, F.col("__part"))).cast("long")))
    sent = placed.join(F.broadcast(plan), (F.col("__part") == F.col("p"))
                       & (F.col("__block") == F.col("b")) & (F.col("__rank") >= F.col("f"))
                       & (F.col("__rank") < F.col("t")))
    again = Window.partitionBy("c").orderBy("__second", "__first")
    return sent.select(
        *[F.col(f"`{c}`") for c in columns],
        F.floor(F.col("c") / per_shard).cast("int").alias("shard"),
        (F.get(begins, F.col("c")) + F.row_number().over(again) - 1).cast("long").alias("slot"))
