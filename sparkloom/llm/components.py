"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.workspace import Workspace

EDGES = 1 << 20       # that a task holds at once


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``(node, label)``: the smallest node that each node of an edge ``(a, b)`` can reach; nodes are longs.

    First every task replaces its edges by stars around the smallest node that they lead to there; the rounds, and
    the plans of each on the driver, are then few. Every round takes the smallest label among the neighbours and then the label of that label, so
    paths shrink by half and stars settle at once. Labels are a table of the shared folder; no
    node's neighbours are gathered. No edges give no rows. Null ends are ignored.
    """
    both = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()
    both = work.keep(f"{name}-edges", both.mapInArrow(_stars, "a long, b long"))
    labels = work.keep(f"{name}-0", both.groupBy(F.col("a").alias("node"))
                       .agg(F.least(F.min("b"), F.col("a")).alias("label")))
    step = 0
    while True:
        step += 1
        met = (both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("node"))
               .agg(F.min("label").alias("met")))
        near = (labels.join(met, "node", "left")
                .select("node", F.col("label").alias("was"),
                        F.least("label", "met").alias("label")))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        fresh = work.keep(f"{name}-{step}", near.join(far, "label", "left").select(
            "node", F.least("label", "beyond").alias("label"), "was"))
        moved = not fresh.where("label != was").isEmpty()
        labels = fresh.select("node", "label")
        work.drop(f"{name}-{step - 1}")
        if not moved:
            work.drop(f"{name}-edges")
            return labels


def _stars(batches):
    """Edges both ways that connect the same nodes as those given, each node with the smallest of its star."""
    held, n = [], 0
    for batch in batches:
        held.append([batch.column(k).to_numpy() for k in (0, 1)])
        n += len(batch)
        if n >= EDGES:
            yield _star(*map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield _star(*map(np.concatenate, zip(*held)))


def _star(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while len(apart := np.flatnonzero(root[a] != root[b])):
        x, y = root[a[apart]], root[b[apart]]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))     # the greater root joins the smallest it meets
        while (root != (above := root[root])).any():
            root = above
    leaf = np.flatnonzero(root != np.arange(len(nodes)))
    ends = nodes[leaf], nodes[root[leaf]]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(e)) for e in (ends, ends[::-1])], ["a", "b"])
