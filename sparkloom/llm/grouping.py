"""Groups of nodes that share something, and the components that links make of them.

Rows are ``(bucket, node, label)``: a node is in many buckets, and nodes known to be connected have equal labels.
Only pairs that share a bucket and differ in label are still of interest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.components import components
from sparkloom.llm.workspace import Workspace


def merged_labels(labels: DataFrame, links: DataFrame, work: Workspace, name: str) -> tuple[DataFrame, DataFrame]:
    """``(node, label)`` with linked labels made one, and ``(label, new)`` of those that changed.

    Links are between nodes; only their labels meet, so earlier links are not read again.
    """
    ends = [labels.select(F.col("node").alias(end), F.col("label").alias(of)) for end, of in (("a", "x"), ("b", "y"))]
    tied = (links.select("a", "b").join(ends[0], "a").join(ends[1], "b")
            .select(F.col("x").alias("a"), F.col("y").alias("b")))
    merged = components(tied, work, f"merged-{name}").toDF("label", "new")
    return work.keep(f"labels-{name}", relabelled(labels, merged)), merged


def relabelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """The rows, columns in their order, with the new labels."""
    return (rows.join(merged, "label", "left").withColumn("label", F.coalesce("new", "label"))
            .select(rows.columns))


def mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    several = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    return rows.join(several.select("bucket"), "bucket")


def largest(rows: DataFrame) -> DataFrame:
    """``(bucket, main, held)``: the component with most members in each bucket."""
    return (rows.groupBy("bucket", "label").agg(F.count("*").alias("size"))
            .groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("main"))
            .select("bucket", F.col("main.label").alias("main"), F.col("main.size").alias("held")))


def undecided(rows: DataFrame, labels: DataFrame, sizes: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """What is left to compare: pairs ``(a, b)``, and components as the sides of ``blocks.linked_between``.

    A component is compared with the others in its buckets, pair by pair. Where it shares so many buckets with a large
    one that this would be more, it is compared block by block with all of that and all others of this kind.
    ``sizes`` is ``(node, n)``.
    """
    placed = work.keep("placed", rows.select("bucket", "node", "label").join(largest(rows), "bucket"))
    whole = labels.groupBy("label").agg(F.count("*").alias("size"))
    small = placed.where("label != main")
    meets = work.keep("meets", small.groupBy("label", "main").agg(F.sum("held").alias("by_bucket"))
                      .join(whole, "label").join(whole.toDF("main", "whole"), "main")
                      .select("label", "main", (F.col("by_bucket") > F.col("size") * F.col("whole")).alias("dense")))
    thin = small.join(meets.where("NOT dense"), ["label", "main"]).select("bucket", F.col("node").alias("x"), "label")
    others = placed.select("bucket", F.col("node").alias("y"), F.col("label").alias("of"))
    few = (thin.join(others, "bucket").where("label != of")
           .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    dense = meets.where("dense").select("label", F.col("main").alias("group"))
    left = dense.join(labels, "label").select("group", F.lit(True).alias("is_left"), "node")
    main = (dense.select("group").distinct().join(labels.withColumnRenamed("label", "group"), "group")
            .select("group", F.lit(False).alias("is_left"), "node"))
    right = main.unionByName(left.withColumn("is_left", F.lit(False)))
    many = work.keep("many", left.unionByName(right).join(sizes, "node"))
    return few, many
