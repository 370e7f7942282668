"""Mixing to target weights by budgets that flow down a tree of sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_DIGITS = 3     # leading hex digits of a row's draw: 4096 buckets for each leaf
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column | str = "text") -> Column:
    """Blank-separated words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, int], other: int) -> Column:
    found = F.lit(other)
    for value, weight in weights.items():
        found = F.when(F.col(level) == value, weight).otherwise(found)
    return found.cast("long")


def _divide(nodes: DataFrame, level: str, above: Sequence[str]) -> DataFrame:
    """Give each node its part of ``budget`` among its siblings: by weight, up to ``room``.

    Siblings are taken by room over weight. The first ones whose fair part of what is left exceeds
    their room are full, and what they can't take goes to the others; single tokens left by rounding
    go to the first that have room.
    """
    siblings = Window.partitionBy(*above).orderBy(
        F.col("room").cast("double") / F.col("weight"), level)
    before = siblings.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*above)
    taken = F.coalesce(F.sum("room").over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    nodes = (nodes.where("weight > 0")
             .withColumn("full", F.col("room") * weight_left
                         <= (F.col("budget") - taken) * F.col("weight"))
             .withColumn("left", F.col("budget")
                         - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(whole))
             .withColumn("open", F.sum(F.when(F.col("full"), 0)
                                       .otherwise(F.col("weight"))).over(whole))
             .withColumn("part", F.when(F.col("full"), F.col("room"))
                         .otherwise(F.expr("left * weight div open"))))
    spare = F.col("left") - F.sum(F.when(F.col("full"), 0).otherwise(F.col("part"))).over(whole)
    turn = F.sum(F.when(F.col("full"), 0).otherwise(1)).over(siblings)
    return (nodes.withColumn("spare", spare).withColumn("turn", turn)
            .withColumn("budget", F.when(F.col("full") | (F.col("turn") > F.col("spare")),
                                         F.col("part")).otherwise(F.col("part") + 1))
            .select(*above, level, "budget"))


def mix_sources(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]],
                tokens: Column, share: tuple[int, int], max_epochs: int = 1, seed: int = 29,
                id_col: str = "doc_id", other_weight: int = 1) -> DataFrame:
    """``docs`` that are taken, with ``__tokens`` and ``__copies`` (how often), a row for each.

    ``levels`` names the tree from the root down, with the column of each level; null is the level
    ``''``. ``weights[level][value]`` are whole numbers, ``other_weight`` for values not listed, 0 for
    none. The budget is ``share[0] / share[1]`` of all tokens. A node's room is its tokens times
    ``max_epochs``: what a child can't use goes to its siblings, and only what no sibling can use was
    left with the nodes above, whose room is the sum of their children's. Leaves with a weight of 0 on
    their path are room for nobody. Every leaf passes whole
    epochs and then the longest prefix, in the seeded order of the next epoch, that fits its budget.

    The order is a seeded hash of the id, and prefixes are found from sums of 4096 buckets for each
    leaf, so a leaf with most of the rows is spread over tasks. Rows without tokens are never taken.
    Rows that repeat an id are one after the other. Other columns pass unchanged.
    """
    names = [f"__level{k}" for k in range(len(levels))]
    docs = docs.drop("__tokens", "__copies").withColumns(
        {"__tokens": tokens} | {n: F.coalesce(c.cast("string"), F.lit(""))
                                for n, c in zip(names, levels.values())}).where("__tokens > 0")
    leaves = docs.groupBy(*names).agg(F.sum("__tokens").alias("tokens"))
    budgets = leaves.agg(F.sum("tokens").alias("all")).select(
        F.expr(f"all * {int(share[0])} div {int(share[1])}").alias("budget"))
    usable = leaves      # a leaf under a weight of 0 is no room for the nodes above either
    for name, level in zip(names, levels):
        usable = usable.where(_weight(name, weights.get(level, {}), other_weight) > 0)
    above: list[str] = []
    for name, level in zip(names, levels):
        room = usable.groupBy(*above, name).agg((F.sum("tokens") * max_epochs).alias("room"))
        room = room.withColumn("weight", _weight(name, weights.get(level, {}), other_weight))
        joined = room.join(budgets, above) if above else room.join(F.broadcast(budgets))
        budgets = _divide(joined, name, above)
        above.append(name)
    plan = (leaves.join(budgets, names)
            .select(*names, F.expr("budget div tokens").alias("__epochs"),
                    F.expr("budget % tokens").alias("__rest")))

    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__epochs").cast("string"),
                              F.col(id_col).cast("string")))
    rows = (docs.join(plan, names).withColumn("__key", drawn)
            .withColumn("__bucket", F.substring("__key", 1, BUCKET_DIGITS)))
    sums = rows.groupBy(*names, "__bucket").agg(F.sum("__tokens").alias("__sum"))
    ahead = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "__bucket",
                       F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__ahead"))
    inner = Window.partitionBy(*names, "__bucket").orderBy("__key", id_col, "__tokens").rowsBetween(
        Window.unboundedPreceding, 0)
    return (rows.join(sums, [*names, "__bucket"])
            .withColumn("__end", F.col("__ahead") + F.sum("__tokens").over(inner))
            .withColumn("__copies", (F.col("__epochs")
                                     + (F.col("__end") <= F.col("__rest")).cast("int")).cast("int"))
            .where("__copies > 0")
            .drop(*names, "__epochs", "__rest", "__key", "__bucket", "__ahead", "__end"))
