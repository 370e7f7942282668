"""Exact Jaccard join of word-shingle sets in their metric space.

The Jaccard distance ``d`` is a metric. Texts with nothing in common are all at distance 1, so pivots
drawn from the whole corpus would leave every text in every boundary window; pivots therefore work
inside regions that already have something in common:

1. *Regions.* All shingles have one global order, those of many texts last (counts of all texts, in
   hashed buckets). Two sets of similarity ``t`` share one of the first ``n - ceil(t n) + 1``
   shingles of each, so a text joins the regions of those shingles only, and no link is lost.
2. *Size rings.* Linked sizes differ by a factor of at most ``1 / t``; a region splits into rings of
   sizes, and a text near the upper bound of its ring is replicated to the next.
3. *Pivots.* Some members of a region become pivots and every member's distance to them is found
   exactly. A member within ``r = 1 - t`` of a pivot is linked and belongs to the pivot's Voronoi
   ball. By the triangle inequality whoever is linked with a member of the ball is within ``2 r`` of
   the pivot: members of that window are replicated into the ball. Members outside all balls form
   the region's outer rest.
4. *Recursion.* Balls and rests in which more than one component is left are regions of the next
   round; those whose members are already connected are closed. Pivots leave, as all their pairs are
   decided. After ``ROUNDS`` rounds the members of different components that are still together in a
   region are compared in full: pair by pair where that is little, else block against block. Every pair
   of different components is thereby compared or excluded by a proven bound, while a family of thousands
   of near copies needs a few pivots only.
5. *Pairs.* A link never leaves its component. Who wants all links, or their numbers, gets them from the
   components, whose members are compared block by block.

Distances first meet a cheap bound: adding up a set's shingles in hashed bins only shrinks distances,
so bins that differ too much prove a pair to be far. Only the rest fetches whole sets.
"""

from __future__ import annotations

import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.llm.blocks import linked_between, shared_items
from sparkloom.llm.grouping import merged_labels, mixed, relabelled, undecided
from sparkloom.llm.words import chunks, mix, shingle_sets
from sparkloom.llm.workspace import Workspace

SKETCH_BITS = 20      # buckets of the count of texts per shingle
BLOCK = 1 << 12       # buckets in one row of that table
BROADCAST_ROWS = 1 << 20   # ids (one long each) sent to all executors; more are joined by shuffle
RING = 2 ** 0.5       # upper size of a ring over its lower
CENTRES = 4           # pivots of a region in a round
ROUNDS = 2            # rounds of pivots before the exact comparison of what is left
SQUARE = 256          # members in a block of a component, about
SQUARE_ITEMS = 1 << 18     # shingles in such a block, about


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``(id, n_shingles, component_id)``: set size and smallest linked id, its own included.

    A text's set is its distinct ``words``-word shingles (blank-separated, A-Z in lower case), or its
    whole sequence if it is shorter. Texts link when 100 * intersection >= ``percent`` * union. Equal
    sets are collapsed first and take part once, under 64 bits of hash. Null, empty and blank texts have
    an empty set and link with nothing. A row with a null id links like others but lends no id; a
    component without any id has none. Rows that repeat an id count each for their own text. Ids are whole
    numbers or strings. Other columns are not read.
    """
    return _Join(docs, words, percent, id_col, text_col).rows()


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``jaccard_components`` with ``n_links``, and all links ``(a, b)``, ``a < b``.

    ``n_links`` counts the other rows that a row is linked with, those of an equal set included; it is 0
    for an empty set. Links are those between different sets, each named by its smallest id; they are
    computed when read. A set whose rows have no id is in no link.
    """
    join = _Join(docs, words, percent, id_col, text_col)
    return join.rows(degrees=True), join.links()


class _Join:
    """The tables of one run: ``profile`` per row, ``classes`` per set, ``labels`` of the linked sets."""

    def __init__(self, docs: DataFrame, words: int, percent: int, id_col: str, text_col: str):
        self.words, self.percent, self.id_col = words, percent, id_col
        self.work = Workspace(docs.sparkSession, "jaccard")
        kind = "string" if docs.schema[id_col].dataType.simpleString() == "string" else "long"
        self.docs = docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).alias("text"))
        self.profile = self.work.keep("profile", self.docs.mapInArrow(
            partial(_profile, words=words),
            f"id {kind}, node long, n int, bins binary, block int, counts binary"))
        self.of_row = self.profile.where("block IS NULL").select("id", "node", "n")
        self.classes = self.work.keep("classes", self.of_row.where("n > 0").groupBy("node").agg(
            F.min("id").alias("least"), F.max("n").alias("n"), F.count("*").alias("copies")))
        rank = _rank_of_buckets(self.profile, self.work)
        self.members = _shared_prefixes(self.docs, words, percent, rank, self.work)
        self.labels = _join_regions(self)

    def rows(self, degrees: bool = False) -> DataFrame:
        label = F.coalesce("label", "node").alias("label")
        named = self.classes.join(self.labels, "node", "left").select("node", "least", "copies", label)
        groups = named.groupBy("label").agg(F.min("least").alias("component_id"))
        named = named.join(groups, "label").select("node", "component_id", "copies")
        more = []
        if degrees:
            met = (self._squares().mapInArrow(partial(_degrees, percent=self.percent), "node long, met long")
                   .groupBy("node").agg(F.sum("met").alias("met")))
            named = named.join(met, "node", "left").withColumn(
                "n_links", F.col("copies") - 1 + F.coalesce("met", F.lit(0)))
            more = ["n_links"]
        named = self.work.keep("named-links" if degrees else "named", named.select("node", "component_id", *more))
        linked = self.of_row.where("n > 0").join(named, "node").select("id", "n", "component_id", *more)
        alone = self.of_row.where("n = 0").select(
            "id", "n", F.col("id").alias("component_id"), *[F.lit(0).cast("long").alias(c) for c in more])
        return linked.unionByName(alone).select(
            F.col("id").alias(self.id_col), F.col("n").cast("long").alias("n_shingles"), "component_id", *more)

    def links(self) -> DataFrame:
        found = self._squares().mapInArrow(partial(_pairs, percent=self.percent), "x long, y long")
        first, second = (self.classes.select(F.col("node").alias(x), F.col("least").alias(name))
                         for x, name in (("x", "p"), ("y", "q")))
        return (found.join(first, "x").join(second, "y").where("p IS NOT NULL AND q IS NOT NULL")
                .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")))

    def _squares(self) -> DataFrame:
        several = self.labels.groupBy("label").agg(F.count("*").alias("size")).where("size > 1").select("label")
        linked = self.labels.join(several, "label").select("node", "label")
        return _component_squares(linked, self.classes, self.sets_of(linked, f"linked-{uuid.uuid4().hex[:8]}"))

    def sets_of(self, nodes: DataFrame, name: str) -> DataFrame:
        """``(node, items)`` of the given sets, from the rows that have the smallest id of each: a stored table."""
        wanted = self.work.keep(f"{name}-wanted", nodes.select("node").distinct().join(
            self.classes.select("node", "least"), "node"))
        ids = wanted.select(F.col("least").alias("own")).distinct()
        if ids.count() <= BROADCAST_ROWS:
            ids = F.broadcast(ids)
        whole = self.docs.join(ids, self.docs.id.eqNullSafe(ids.own), "left_semi").select("text").mapInArrow(
            partial(_sets, words=self.words), "node long, items array<bigint>")
        found = whole.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])
        return self.work.keep(f"{name}-sets", found)

    def close(self, pairs: DataFrame, bins: DataFrame, window: int, name: str) -> DataFrame:
        """The pairs ``(x, y)`` of similarity ``window`` and more, with sizes and what they have in common.

        Bins rule most pairs out; only the sets of the others are looked up.
        """
        sized = F.greatest("n", "m") * window <= F.least("n", "m") * 100
        maybe = self.work.keep(f"{name}-maybe", pairs.join(bins.toDF("x", "n", "a"), "x")
                               .join(bins.toDF("y", "m", "b"), "y").where(sized)
                               .select("x", "y", "n", "m", "a", "b")
                               .mapInArrow(partial(_may_be_near, window=window), "x long, y long, n int, m int"))
        sets = self.sets_of(maybe.select(F.col("x").alias("node")).unionByName(
            maybe.select(F.col("y").alias("node"))), name)
        found = self.work.keep(name, maybe.join(sets.toDF("x", "a"), "x").join(sets.toDF("y", "b"), "y").select(
            "x", "y", "n", "m", F.size(F.array_intersect("a", "b")).alias("common")).where(_near(window)))
        self.work.drop(f"{name}-maybe", f"{name}-sets", f"{name}-wanted")
        return found


# --- sets and the order of shingles -------------------------------------------------------------

def set_node(one: np.ndarray) -> int:
    """64 bits that name a set."""
    words = np.array([len(one), one.sum(dtype=np.uint64),
                      np.bitwise_xor.reduce(mix(one ^ np.uint64(77))) if len(one) else 0], np.uint64)
    found = np.uint64(0)
    for word in words:
        found = mix(np.array([found ^ word]) * np.uint64(0x9E3779B97F4A7C15))[0]
    return int(found.view(np.int64))


def _profile(batches, words: int):
    """Name, size and bins of each text's set; at the end of the task its counts of texts per bucket."""
    kind, counts = pa.int64(), np.zeros(1 << SKETCH_BITS, np.int64)
    names = ["id", "node", "n", "bins", "block", "counts"]
    for batch in batches:
        ids, nodes, sizes, bins = batch.column(0), [], [], []
        kind = ids.type
        for chunk in chunks(batch.column(1)):
            sets = shingle_sets(chunk, words)
            nodes += [set_node(one) for one in sets]
            sizes += [len(one) for one in sets]
            bins += [_bins(one) for one in sets]
            counts += np.bincount(_bucket(np.concatenate(sets)), minlength=len(counts))
        empty = pa.nulls(len(ids))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bins, pa.binary()),
             empty.cast(pa.int32()), empty.cast(pa.binary())], names)
    if counts.any():
        blocks = counts.reshape(-1, BLOCK)
        none = pa.nulls(len(blocks))
        yield pa.RecordBatch.from_arrays(
            [none.cast(kind), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.binary()),
             pa.array(range(len(blocks)), pa.int32()),
             pa.array([b.tobytes() for b in blocks], pa.binary())], names)


def _bins(one: np.ndarray) -> bytes:
    """How many shingles fall in each of about n / 4 bins, a byte each (more bins if one runs over)."""
    size = 1 << max(4, (len(one) // 4).bit_length())
    spread = mix(one)
    while True:
        counts = np.bincount((spread & np.uint64(size - 1)).astype(np.int64), minlength=size)
        if counts.max() < 256:
            return counts.astype(np.uint8).tobytes()
        size *= 2


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _add_blocks(batches):
    """Add up the rows of one partition; holds one row per block at most."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            have = total.get(block)
            more = np.frombuffer(counts, np.int64)
            total[block] = more.copy() if have is None else have + more
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([c.tobytes() for c in total.values()], pa.binary())], ["block", "counts"])


def _sums(batches):
    for batch in batches:
        sums = [int(np.frombuffer(counts, np.int64).sum()) for counts in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int64())], ["total"])


def _ranks(batches, mean: float):
    """Per block a byte of rank for each of its buckets."""
    usual = mean + 4 * mean ** 0.5 + 2
    for batch in batches:
        ranks = []
        for part in batch.column(1).to_pylist():
            counts = np.frombuffer(part, np.int64)
            above = np.log2(np.maximum(counts - mean, 1)).astype(np.uint8) + 1
            ranks.append(np.where(counts <= usual, 0, above).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ranks, pa.binary())], ["block", "ranks"])


def _rank_of_buckets(profile: DataFrame, work: Workspace) -> bytes:
    """Per bucket a rank by its number of texts: 0 for the usual, then one more per doubling.

    The table has a fixed size whatever the input (one byte for each of 2 ** 20 buckets), and only these bytes
    come to the driver.
    """
    counts = work.keep("counts", profile.where("block IS NOT NULL").select("block", "counts")
                       .mapInArrow(_add_blocks, "block int, counts binary").repartition("block")
                       .mapInArrow(_add_blocks, "block int, counts binary"))
    total = counts.select("counts").mapInArrow(_sums, "total long").agg(F.sum("total")).first()[0]
    found = counts.mapInArrow(partial(_ranks, mean=(total or 0) / (1 << SKETCH_BITS)), "block int, ranks binary").collect()
    work.drop("counts")
    ranks = bytearray(1 << SKETCH_BITS)
    for block, part in found:
        ranks[block * BLOCK:(block + 1) * BLOCK] = part
    return bytes(ranks)


# --- regions ------------------------------------------------------------------------------------

def _least_overlap(n, percent: int):
    """Shingles that a set of ``n`` has in common with any linked one, at least."""
    return -(-percent * n // 100)


def _prefixes(batches, words: int, percent: int, rank: bytes):
    """``(region, node, n)`` for the first shingles of each set; equal sets of a task once."""
    ranks, seen = np.frombuffer(rank, np.uint8), set()
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            keys, owners, sizes = [], [], []
            for one in shingle_sets(chunk, words):
                n, node = len(one), set_node(one)
                if not n or node in seen:
                    continue
                seen.add(node)
                level = ranks[_bucket(one)].astype(np.uint64)
                order = (level << np.uint64(56)) | (mix(one) >> np.uint64(8))
                first = n - _least_overlap(n, percent) + 1
                keys.append(one[np.argpartition(order, first - 1)[:first]])
                owners.append(np.full(first, node, np.int64))
                sizes.append(np.full(first, n, np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)),
                     pa.array(np.concatenate(owners)), pa.array(np.concatenate(sizes))],
                    ["region", "node", "n"])


def _shared_prefixes(docs: DataFrame, words: int, percent: int, rank: bytes, work: Workspace) -> DataFrame:
    """``(bucket, node, n)``: regions with more than one set, split into size rings."""
    postings = docs.select("text").mapInArrow(
        partial(_prefixes, words=words, percent=percent, rank=rank), "region long, node long, n int")
    region = Window.partitionBy("region")          # one shuffle of the postings; rows may spill, none is held
    met = (postings.withColumn("low", F.min("node").over(region)).withColumn("high", F.max("node").over(region))
           .where("low != high").select("region", "node", "n").distinct())
    ring = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(RING))).cast("int")
    reach = F.floor(F.log(F.col("n") * 100.0 / percent + 1e-6) / F.log(F.lit(RING))).cast("int")
    rings = work.keep("rings", met.select("node", "n", F.explode(F.sequence(ring, reach)).alias("ring"), "region")
                      .select(F.xxhash64("region", "ring").alias("bucket"), "node", "n"))
    several = (rings.groupBy("bucket").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("mark")).where("low != high")
        .groupBy("low", "high", "size", "mark").agg(F.min("bucket").alias("bucket")))   # equal regions once
    members = work.keep("members", rings.join(several.select("bucket"), "bucket"))
    work.drop("rings")
    return members


# --- pivots, balls and windows ------------------------------------------------------------------

def _sets(batches, words: int):
    """``(node, items)``: the whole sorted sets; empty ones are left out."""
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            sets = [one for one in shingle_sets(chunk, words) if len(one)]
            if sets:
                edges = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_node(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(sets).view(np.int64)))],
                    ["node", "items"])


def _may_be_near(batches, window: int):
    """Keep pairs whose bins don't prove that 100 * intersection < window * union."""
    for batch in batches:
        rows = [batch.column(k).to_pylist() for k in range(2, 6)]
        keep = []
        for i, (n, m, a, b) in enumerate(zip(*rows)):
            a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (a, b))
            while len(a) > len(b):
                a = a[:len(a) // 2] + a[len(a) // 2:]
            while len(b) > len(a):
                b = b[:len(b) // 2] + b[len(b) // 2:]
            common = int(np.minimum(a, b).sum())
            if 100 * common >= window * (n + m - common):
                keep.append(i)
        if keep:
            yield batch.select([0, 1, 2, 3]).take(pa.array(keep))


def _near(window: int) -> Column:
    """100 * intersection >= window * union."""
    return 100 * F.col("common") >= window * (F.col("n") + F.col("m") - F.col("common"))


def _join_regions(join: _Join) -> DataFrame:
    """``(node, label)`` of all sets that share a region with another one."""
    work, percent, wide = join.work, join.percent, 2 * join.percent - 100
    labels = work.keep("labels-0", join.members.select("node").distinct().withColumn("label", F.col("node")))
    bins = work.keep("bins", join.profile.where("n > 0").select("node", "n", "bins")
                     .join(labels.select("node"), "node", "left_semi").dropDuplicates(["node"]))
    rows = join.members.withColumn("label", F.col("node"))
    for turn in range(ROUNDS):
        if rows.isEmpty():
            return labels
        slot = F.pmod(F.xxhash64("node", F.lit(-1 - turn)), F.lit(CENTRES))
        chosen = (rows.groupBy("bucket", slot.alias("slot")).agg(F.min(F.struct("node", "n")).alias("p"))
                  .select("bucket", F.col("p.node").alias("pivot"), F.col("p.n").alias("m")))
        chosen = work.keep(f"pivots-{turn}", chosen)
        sized = (F.greatest("n", "m") * wide <= F.least("n", "m") * 100) & F.expr("node != pivot")
        pairs = rows.join(chosen, "bucket").where(sized).select(
            F.col("node").alias("x"), F.col("pivot").alias("y")).distinct()
        close = join.close(pairs, bins, wide, f"close-{turn}")
        linked = close.where(_near(percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))
        labels, merged = merged_labels(labels, linked, work, f"{turn + 1}")

        undecided_rows = rows.join(chosen.select("bucket", F.col("pivot").alias("node")), ["bucket", "node"], "left_anti")
        around = (undecided_rows.join(chosen.select("bucket", "pivot"), "bucket")
                  .join(close.select(F.col("x").alias("node"), F.col("y").alias("pivot"), "common", "m"),
                        ["node", "pivot"]))
        balls = around.select(F.xxhash64("pivot", F.lit(turn)).alias("bucket"), "node", "n", "label")
        inside = around.where(_near(percent)).select("bucket", "node").distinct()
        rest = undecided_rows.join(inside, ["bucket", "node"], "left_anti").select("bucket", "node", "n", "label")
        regions = relabelled(balls.unionByName(rest).distinct(), merged)
        rows = work.keep(f"regions-{turn}", mixed(work.keep(f"split-{turn}", regions)))
        work.drop(f"split-{turn}", f"pivots-{turn}", f"close-{turn}", f"regions-{turn - 1}")
    if rows.isEmpty():
        return labels
    few, many = undecided(rows, labels, bins.select("node", "n"), work)
    few = join.close(few.toDF("x", "y"), bins, percent, "few").select(F.col("x").alias("a"), F.col("y").alias("b"))
    sets = join.sets_of(many, "many")
    links = few.unionByName(work.keep("links-many", linked_between(many, sets, percent)))
    work.drop("many-sets", "many-wanted")
    return merged_labels(labels, links, work, "last")[0]


# --- all links ----------------------------------------------------------------------------------

def _component_squares(labels: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Blocks of the members of each component against each other: a row per member and square."""
    sized = labels.join(classes.select("node", "n", "copies"), "node")
    cuts = sized.groupBy("label").agg(F.count("*").alias("size"), F.ceil(F.greatest(
        F.count("*") / SQUARE, F.sum("n") / SQUARE_ITEMS)).cast("int").alias("cuts")).where("size > 1")
    placed = sized.join(cuts, "label").select(
        "node", "label", "copies", "cuts", F.pmod(F.xxhash64("node"), "cuts").cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    return (placed.select("node", "label", "copies", "block", other)
            .select("node", "label", "copies", "block", F.least("block", "other").alias("i"),
                    F.greatest("block", "other").alias("j"))
            .join(sets, "node").repartition("label", "i", "j").sortWithinPartitions("label", "i", "j"))


def _each_square(batches):
    """``(nodes, copies, rows, columns, sets)`` of each square; its rows come one after the other."""
    at, held = None, ([], [], [], [])

    def square():
        nodes, copies, blocks, sets = held
        first = np.array(blocks) == at[1]
        rows = np.flatnonzero(first)
        return (np.array(nodes, np.int64), np.array(copies, np.int64), rows,
                rows if at[1] == at[2] else np.flatnonzero(~first), sets)

    for batch in batches:
        items = batch.column("items")
        columns = [batch.column(c).to_pylist() for c in ("label", "i", "j", "node", "copies", "block")]
        for k, (label, i, j, *row) in enumerate(zip(*columns)):
            if (label, i, j) != at and held[0]:
                yield square()
                held = ([], [], [], [])
            at = (label, i, j)
            for part, value in zip(held, (*row, items[k].values.to_numpy().copy())):
                part.append(value)
    if held[0]:
        yield square()


def _linked(rows, columns, sets, percent: int) -> np.ndarray:
    """Which pairs are linked; a set is not linked with itself."""
    common = shared_items(sets, rows, columns)
    sizes = np.array([len(s) for s in sets], np.int64)
    linked = 100 * common >= percent * (sizes[rows][:, None] + sizes[columns] - common)
    return linked & (rows[:, None] != columns)


def _degrees(batches, percent: int):
    """``(node, met)``: rows of linked sets, per node and square."""
    for nodes, copies, rows, columns, sets in _each_square(batches):
        linked = _linked(rows, columns, sets, percent)
        met = np.zeros(len(nodes), np.int64)
        met[rows] += linked @ copies[columns]
        if columns is not rows:
            met[columns] += linked.T @ copies[rows]
        has = np.flatnonzero(met)
        if len(has):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[has]), pa.array(met[has])], ["node", "met"])


def _pairs(batches, percent: int):
    """``(x, y)`` of the linked pairs, once each."""
    for nodes, _, rows, columns, sets in _each_square(batches):
        linked = _linked(rows, columns, sets, percent)
        x, y = np.nonzero(np.triu(linked) if columns is rows else linked)
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[rows[x]]), pa.array(nodes[columns[y]])], ["x", "y"])
