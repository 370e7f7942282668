"""Near-duplicate groups by MinHash with tensored banding.

Plain banding with ``L`` tables and ``2 k`` minhashes a key computes ``2 k L`` minhashes. Here two small
collections of ``m`` half keys of ``k`` minhashes each are computed, ``2 k m`` in all, and every pair of a half
key of the first and one of the second is the key of a table: ``L = m * m`` tables. Texts of similarity ``s``
meet in one of them with probability ``(1 - (1 - s^k)^m)^2``: 0.99999 at 0.8 with the 24 half keys of 4 used here,
0.001 at 0.2.

1. *Sets.* Texts become sets of shingle hashes; equal sets are one node from here on.
2. *Half keys.* Nodes without company in any half key of the first collection can't meet in a table. Only the
   others are paired with the second collection, so the ``m * m`` keys of most texts are never written.
3. *Tables.* Nodes with an equal key are a bucket; equal buckets count once.
4. *Verification.* In each bucket one node is compared with the others, then a few members of its largest
   component with those outside, so a family of thousands of copies costs a few comparisons a member. A pair
   already connected needs no comparison. What then still shares a bucket with another component is
   compared in full: pair by pair where there is little of it, else block by block. The minhashes rule out pairs far
   below the threshold; the others are compared by whole sets.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.blocks import linked_between
from sparkloom.llm.grouping import merged_labels, mixed, relabelled, undecided
from sparkloom.llm.words import chunks, mix, shingle_sets
from sparkloom.llm.workspace import Workspace

HALF_KEYS = 18        # half keys in each collection: as many tables as its square
MINHASHES = 4         # minhashes in a half key
DEVIATIONS = 5        # a pair is ruled out that many standard deviations of its minhashes below the threshold
BROADCAST_ROWS = 1 << 20   # nodes (a few longs each) sent to all executors; more are joined by shuffle
PIVOTS = (1, 2)   # members of a bucket's largest component that the others are compared with, by round

_rng = np.random.default_rng(20250611)
_FACTORS = _rng.integers(1, 1 << 63, 2 * HALF_KEYS * MINHASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _rng.integers(1, 1 << 63, 2 * HALF_KEYS * MINHASHES, dtype=np.uint64)
_ROW = "id long, n int, sum long, xor long"


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row ``(id, n_shingles, component_id, kept)``.

    A text's set is its distinct ``words``-word shingles (blank-separated, A-Z in lower case), or its whole sequence
    if it is shorter. Texts link when 100 * intersection >= ``percent`` * union. ``component_id`` is the smallest id
    reachable by links, its own included; ``kept`` says that it is the row's own. Null, empty and blank texts have an
    empty set and link with nothing. Rows without an id link like others but lend no id: a component without any has a
    null ``component_id`` and keeps all its rows. Rows that repeat an id count each for their own text. Other columns
    are not read.
    """
    work = Workspace(docs.sparkSession, "tensored")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = work.keep("rows", docs.mapInArrow(
        partial(_sketches, words=words), f"{_ROW}, first array<bigint>, second array<bigint>, marks binary"))
    classes = work.keep("classes", rows.where("n > 0").groupBy("n", "sum", "xor").agg(
        F.min("id").alias("id"), F.first("first").alias("first"), F.first("second").alias("second"),
        F.first("marks").alias("marks")).withColumn("node", F.monotonically_increasing_id()))
    members = _buckets(classes, work)
    labels = _verified(docs, classes, members, words, percent, work)
    named = classes.select("n", "sum", "xor", "id", "node").join(labels, "node", "left").select(
        "n", "sum", "xor", "id", F.coalesce("label", "node").alias("label"))
    groups = work.keep("groups", named.groupBy("label").agg(F.min("id").alias("component_id")))
    groups = work.keep("named", named.join(groups, "label").select("n", "sum", "xor", "component_id"))
    linked = rows.where("n > 0").select("id", "n", "sum", "xor").join(groups, ["n", "sum", "xor"], "left")
    alone = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.select("id", "n", "component_id").unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


# --- sketches -------------------------------------------------------------------------------------

def fingerprint(one: np.ndarray) -> tuple[int, int]:
    """Two words that tell different sets apart."""
    return (int(one.sum(dtype=np.uint64).view(np.int64)),
            int(np.bitwise_xor.reduce(mix(one ^ np.uint64(77))).view(np.int64)) if len(one) else 0)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """Minhashes x sets; sets must not be empty."""
    items = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    found = np.empty((len(_FACTORS), len(sets)), np.uint64)
    for k, (factor, salt) in enumerate(zip(_FACTORS, _SALTS)):
        found[k] = np.minimum.reduceat((items ^ salt) * factor, starts)     # items are hashes already
    return found


def half_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sets x half keys of the first and of the second collection."""
    groups = hashes.reshape(2 * HALF_KEYS, MINHASHES, -1)
    keys = np.arange(1, 2 * HALF_KEYS + 1, dtype=np.uint64)[:, None] * _FACTORS[0]
    for k in range(MINHASHES):
        keys = mix((keys ^ groups[:, k]) * _FACTORS[k + 1])
    return keys[:HALF_KEYS].T, keys[HALF_KEYS:].T


def _lists(keys: np.ndarray) -> pa.ListArray:
    flat = np.ascontiguousarray(keys).view(np.int64).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, HALF_KEYS), pa.int32()), pa.array(flat))


def _sketches(batches, words: int):
    """Set size, fingerprint, half keys and a byte of every minhash per text."""
    names = ["id", "n", "sum", "xor", "first", "second", "marks"]
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            sets = shingle_sets(chunk, words)
            marks = np.array([fingerprint(s) for s in sets], np.int64).reshape(-1, 2)
            hashes = minhashes([s if len(s) else np.zeros(1, np.uint64) for s in sets])
            first, second = half_keys(hashes)
            low = np.ascontiguousarray((hashes >> np.uint64(16)).astype(np.uint8).T)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(chunk.first, len(sets)), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array(marks[:, 0]), pa.array(marks[:, 1]),
                 _lists(first), _lists(second), pa.array([r.tobytes() for r in low], pa.binary())], names)


# --- tables ---------------------------------------------------------------------------------------

def _buckets(classes: DataFrame, work: Workspace) -> DataFrame:
    """``(bucket, node)`` of the buckets with several nodes, equal buckets once."""
    halves = classes.select("node", F.explode("first").alias("half"))
    company = halves.groupBy("half").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    met = work.keep("met", halves.join(company.select("half"), "half"))
    keys = (met.join(classes.select("node", "second"), "node")
            .select("node", "half", F.explode("second").alias("other"))
            .select("node", F.xxhash64("half", "other").alias("bucket")))
    keys = work.keep("keys", keys)
    work.drop("met")
    several = (keys.groupBy("bucket").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("mark")).where("low != high")
        .groupBy("low", "high", "size", "mark").agg(F.min("bucket").alias("bucket")))
    members = work.keep("members", keys.join(several.select("bucket"), "bucket").distinct())
    work.drop("keys")
    return members


# --- verification ---------------------------------------------------------------------------------

def _verified(docs: DataFrame, classes: DataFrame, members: DataFrame, words: int, percent: int,
              work: Workspace) -> DataFrame:
    """``(node, label)`` of all nodes that share a bucket; linked nodes have equal labels."""
    labels = work.keep("labels-0", members.select("node").distinct().withColumn("label", F.col("node")))
    nodes = work.keep("nodes", classes.select("node", "n", "marks").join(labels.select("node"), "node", "left_semi"))
    sets = work.keep("sets", _whole_sets(docs, classes.select("n", "sum", "xor", "id", "node").join(
        labels.select("node"), "node", "left_semi"), words, work))
    rows = members.withColumn("label", F.col("node"))
    for turn, pivots in enumerate(PIVOTS):
        if rows.isEmpty():
            return labels
        chosen = work.keep(f"chosen-{turn}", _pivots(rows, pivots, turn))
        pairs = (rows.join(chosen, "bucket").where("label != of")
                 .select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct())
        links = work.keep(f"links-{turn}", _links(pairs, nodes, sets, percent))
        labels, merged = merged_labels(labels, links, work, f"{turn + 1}")
        rows = work.keep(f"rows-{turn}", mixed(relabelled(rows, merged)))
        work.drop(f"chosen-{turn}", f"rows-{turn - 1}")
    if rows.isEmpty():
        return labels
    few, many = undecided(rows, labels, nodes.select("node", "n"), work)
    links = work.keep("links-few", _links(few, nodes, sets, percent))
    links = links.unionByName(work.keep("links-many", linked_between(many, sets, percent)))
    return merged_labels(labels, links, work, "last")[0]


def _pivots(rows: DataFrame, most: int, turn: int) -> DataFrame:
    """``(bucket, pivot, of)``: up to ``most`` members of each bucket's largest component.

    They are chosen by a hash of the node, so that buckets of one family choose the same and their pairs are
    compared once.
    """
    if turn == 0:                  # all components are single nodes
        return rows.groupBy("bucket").agg(F.min("node").alias("pivot")).withColumn("of", F.col("pivot"))
    spread = F.xxhash64("node", F.lit(turn))
    first = [F.min(F.when(F.pmod(spread, F.lit(most)) == slot, F.struct(spread.alias("spread"), "node")))
             .alias(f"in_{slot}") for slot in range(most)]
    each = rows.groupBy("bucket", "label").agg(F.count("*").alias("size"), *first)
    main = each.groupBy("bucket").agg(F.max(F.struct(
        "size", "label", *[F.col(f"in_{slot}.node").alias(f"pivot_{slot}") for slot in range(most)])).alias("main"))
    return main.select(
        "bucket", F.explode(F.array(*[f"main.pivot_{slot}" for slot in range(most)])).alias("pivot"),
        F.col("main.label").alias("of")).where("pivot IS NOT NULL")


def _whole_sets(docs: DataFrame, wanted: DataFrame, words: int, work: Workspace) -> DataFrame:
    """``(node, items)`` of the wanted classes, from texts of the id that each of them names."""
    wanted = work.keep("wanted", wanted)
    ids = wanted.select(F.col("id").alias("own")).distinct()
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    whole = docs.join(ids, docs.id.eqNullSafe(ids.own), "left_semi").mapInArrow(
        partial(_items, words=words), "n int, sum long, xor long, items array<bigint>")
    return whole.join(wanted.select("n", "sum", "xor", "node"), ["n", "sum", "xor"]).select(
        "node", "items").dropDuplicates(["node"])


def _items(batches, words: int):
    for batch in batches:
        seen = set()
        for chunk in chunks(batch.column(1)):
            sets = [s for s in shingle_sets(chunk, words) if len(s)]
            marks = [(len(s), *fingerprint(s)) for s in sets]
            fresh = [k for k, mark in enumerate(marks) if mark not in seen and not seen.add(mark)]
            if fresh:
                sets, marks = [sets[k] for k in fresh], [marks[k] for k in fresh]
                n, sums, xors = zip(*marks)
                edges = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n, pa.int32()), pa.array(sums, pa.int64()), pa.array(xors, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(sets).view(np.int64)))],
                    ["n", "sum", "xor", "items"])


def least_marks(percent: int) -> int:
    """Minhashes that a linked pair has in common, but for ``DEVIATIONS`` standard deviations of them."""
    t, size = percent / 100, len(_FACTORS)
    return max(0, int(size * t - DEVIATIONS * (size * t * (1 - t)) ** 0.5))


def _alike(batches, least: int):
    """Keep the pairs whose minhashes don't rule them out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for k in (4, 5))
        keep = (a == b).sum(axis=1) >= least
        if keep.any():
            yield batch.select([0, 1, 2, 3]).filter(pa.array(keep))


def _links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are linked, by whole sets."""
    sized = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    alike = (pairs.join(nodes.toDF("a", "n", "p"), "a").join(nodes.toDF("b", "m", "q"), "b").where(sized)
             .select("a", "b", "n", "m", "p", "q")
             .mapInArrow(partial(_alike, least=least_marks(percent)), "a long, b long, n int, m int"))
    common = F.size(F.array_intersect("x", "y"))
    return (alike.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
            .select("a", "b", "n", "m", common.alias("common"))
            .where(100 * F.col("common") >= percent * (F.col("n") + F.col("m") - F.col("common"))).select("a", "b"))
