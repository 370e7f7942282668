"""The prefix trie of conversations: how many share each opening, and what sharing saves.

1. Every turn becomes two hashes of its role and text, a conversation an array of them. Equal conversations
   are one sequence with a count, so that copies cost nothing further on.
2. Sequences are dealt by range in their own order. A range is a shard: the subtree of a prefix is a run of
   neighbours, so shards share only the nodes on the paths where they meet.
3. Each shard packs a double array over its own dense turn ids and walks it: counts, smallest members, children,
   leaves and savings, summed up level by level.
4. The shared upper nodes' parts add up by the hash of their path, one row per shard and node. A node belongs to the
   first shard that has it, so nothing counts twice.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.llm.double_array import ROOT, DoubleArray
from sparkloom.llm.mixing import token_count
from sparkloom.llm.workspace import Workspace

TURNS_PER_SHARD = 200_000
MEMBER_BITS = 12           # a piece of a list of members has ids that differ in these bits only
BROADCAST_ROWS = 1 << 17   # shared nodes that go to all executors; more are joined by shuffle
NODE = ("path binary, parent_path binary, f1 long, f2 long, conv_id long, depth long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long")
_NOTHING = hashlib.sha256(b"").hexdigest()


def own_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: each conversation's turns in order, as ``(k1, k2, tokens)``.

    Turns are ordered by ``turn``, null first; turns with an equal number by the hash of role and text. A null role or
    text is empty; rows without a conv_id belong to no conversation and are left out. Repeated rows are turns of their
    own. Roles and texts are compared by 128 bits of hashes. Other columns are not read. One conversation's hashes
    (32 bytes a turn) have to fit into a task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("k1"),
            F.xxhash64(text, F.lit(17), role).alias("k2"), token_count("text").cast("long").alias("tokens")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("seq"))
    return ordered.select("conv_id", F.transform("seq", lambda t: t.dropFields("turn")).alias("seq"))


def rebuilt(own: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations that open like the first of their group.

    Conversation c gets the first h turns of conversation c - c % ``group`` (none if there is no such), then its own
    behind its first h; h is the crc32 of c in decimals modulo ``most``.
    """
    own = Workspace(own.sparkSession, "rebuilt").keep("own", own)
    heads = (own.where(F.col("conv_id") % group == 0)
             .select(F.col("conv_id").alias("head_id"), F.slice("seq", 1, most - 1).alias("head")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    tail = F.slice("seq", h + 1, F.greatest(F.size("seq") - h, F.lit(0)))
    head = F.slice(F.coalesce("head", F.slice("seq", 1, 0)), F.lit(1), h)
    return (own.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % group).join(heads, "head_id", "left")
            .select("conv_id", F.concat(head, tail).alias("seq")))


def prefix_trie(conversations: DataFrame, shard_turns: int = TURNS_PER_SHARD) -> DataFrame:
    """One row per node of the trie of ``(conv_id, seq)``; see ``own_turns`` for ``seq``.

    ``conv_id`` the smallest member, ``depth``, ``parent_conv_id`` the parent's smallest member (root: null), ``n_convs``
    members, ``n_children``, ``n_leaves`` childless nodes in the subtree, ``saved_tokens`` (n_convs - 1) x words of the
    last turn, summed over the subtree, ``ends_sha256`` the digest of the ids of the conversations that end here,
    ascending. A conversation without turns ends at the root. No conversations give no rows. A shard has about
    ``shard_turns`` turns.
    """
    work = Workspace(conversations.sparkSession, "trie")
    keys = F.transform("seq", lambda t: F.struct(t["k1"].alias("k1"), t["k2"].alias("k2")))
    convs = work.keep("convs", conversations.select(
        "conv_id", keys.alias("keys"), F.transform("seq", lambda t: t["tokens"]).alias("tokens"))
        .withColumn("f1", F.xxhash64("keys")).withColumn("f2", F.xxhash64(F.lit(29), "keys")))
    shards, meets = _shards(convs, shard_turns, work)
    nodes = work.keep("nodes", shards.unionByName(meets).repartition("shard")
                      .sortWithinPartitions("shard", "side", "keys").mapInArrow(_walk, NODE))
    nodes = _merged(nodes, work)
    ends = _ends(convs.select("f1", "f2", "conv_id"))
    inner = nodes.where("f1 IS NULL").withColumn("ends_sha256", F.lit(_NOTHING))
    return nodes.where("f1 IS NOT NULL").join(ends, ["f1", "f2"]).unionByName(inner).drop("f1", "f2")


def _shards(convs: DataFrame, shard_turns: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences by range, and for every range the sequences next to it (side -1 and 1)."""
    distinct = work.keep("distinct", convs.groupBy("keys", "tokens", "f1", "f2").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least")))
    turns = distinct.agg(F.sum(F.size("keys") + 1)).head()[0] or 0
    shards = work.keep("shards", distinct.repartitionByRange(-(-turns // shard_turns) or 1, "keys")
                       .withColumn("shard", F.spark_partition_id()).withColumn("side", F.lit(0)))
    edges = work.keep("edges", shards.groupBy("shard").agg(F.min("keys").alias("first"), F.max("keys").alias("last")))
    order = sorted(row["shard"] for row in edges.select("shard").collect())     # one number per shard
    after = edges.sparkSession.createDataFrame(list(zip(order, order[1:])), "before int, behind int")
    nothing = {"tokens": F.lit(None).cast("array<long>"), "f1": F.lit(None).cast("long"),
               "f2": F.lit(None).cast("long"), "n": F.lit(0).cast("long"), "least": F.lit(None).cast("long")}
    left = edges.join(after, edges.shard == after.before).select(F.col("behind").alias("shard"), F.lit(-1).alias("side"),
                                                                 F.col("last").alias("keys"))
    right = edges.join(after, edges.shard == after.behind).select(F.col("before").alias("shard"), F.lit(1).alias("side"),
                                                                  F.col("first").alias("keys"))
    return shards, left.unionByName(right).withColumns(nothing)


def _walk(batches):
    """The nodes of each shard; a shard's rows come one after the other, its neighbours first and last."""
    at, parts = None, []
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1]))) if len(shards) else []
        for begin, end in zip(edges, [*edges[1:], len(shards)]):
            if shards[begin] != at and parts:
                yield from _nodes(pa.Table.from_batches(parts))
                parts = []
            at = shards[begin]
            parts.append(batch.slice(begin, end - begin))
    if parts:
        yield from _nodes(pa.Table.from_batches(parts))


def _nodes(rows: pa.Table):
    rows = rows.combine_chunks()
    side, keys = rows["side"].to_numpy(), rows["keys"].chunk(0)
    lengths = np.diff(keys.offsets.to_numpy())
    turns = keys.flatten()
    pairs = np.rec.fromarrays([turns.field(0).to_numpy(), turns.field(1).to_numpy()], names="k1,k2")
    starts = np.concatenate(([0], np.cumsum(lengths)))
    own = np.flatnonzero(side == 0)
    if not len(own):
        return
    codes, n_codes = _dense(pairs)
    tokens = np.zeros(len(pairs), np.int64)
    inner = rows["tokens"].chunk(0)
    tokens[np.repeat(side == 0, lengths)] = inner.flatten().to_numpy()

    trie = DoubleArray(2 * len(pairs))
    here = np.full(len(lengths), ROOT)
    deepest = int(lengths[own].max())
    for depth in range(deepest):                         # build: the distinct (node, code) of each level
        rows_on = own[lengths[own] > depth]
        nodes, kids = here[rows_on], codes[starts[rows_on] + depth]
        trie.add_level(*np.divmod(np.unique(nodes * (n_codes + 1) + kids), n_codes + 1))
        here[rows_on] = trie.follow(nodes, kids)

    size = trie.end
    counts = rows["n"].to_numpy()
    least = rows["least"].fill_null(0).to_numpy()
    n_convs, smallest = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depths, words, of_turn = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1)
    end_of = np.full(size, -1)
    left, right, further = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, bool)
    here = np.full(len(lengths), ROOT)
    active = np.arange(len(lengths))
    for depth in range(deepest + 1):                     # traverse, the neighbours as far as they go
        mine = active[side[active] == 0]
        np.add.at(n_convs, here[mine], counts[mine])
        np.minimum.at(smallest, here[mine], least[mine])
        depths[here[mine]] = depth
        done = mine[lengths[mine] == depth]
        end_of[here[done]] = done
        left[here[active[side[active] < 0]]] = True
        ahead = active[side[active] > 0]
        right[here[ahead]] = True
        further[here[ahead[lengths[ahead] > depth]]] = True
        active = active[lengths[active] > depth]
        turn = starts[active] + depth
        here[active] = trie.follow(here[active], codes[turn])
        mine = side[active] == 0
        words[here[active[mine]]] = tokens[turn[mine]]
        of_turn[here[active[mine]]] = turn[mine]
        active = active[here[active] > 0]

    nodes = np.flatnonzero(n_convs)
    parent = trie.check[:size].copy()
    parent[ROOT] = 0
    owned, shared = ~left, left | right
    kids = np.bincount(parent[nodes], weights=owned[nodes], minlength=size).astype(np.int64)
    childless = np.bincount(parent[nodes], minlength=size) == 0
    leaves = (childless & ~further & owned).astype(np.int64)
    saved = (n_convs - owned) * words
    by_depth = nodes[np.argsort(depths[nodes], kind="stable")]
    edges = np.searchsorted(depths[by_depth], np.arange(1, deepest + 2))
    for depth in range(deepest, 0, -1):                  # sum up, the deepest level first
        level = by_depth[edges[depth - 1]:edges[depth]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])

    paths = _paths(by_depth[shared[by_depth]], parent, of_turn, pairs)
    yield _node_rows(nodes, rows, end_of, paths, parent, smallest, depths, n_convs, kids, leaves, saved)


def _dense(pairs: np.ndarray) -> tuple[np.ndarray, int]:
    """Turn ids 1, 2, ... in order of their first place, so that siblings have ids near each other."""
    _, first, inverse = np.unique(pairs, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first, kind="stable")] = np.arange(1, len(first) + 1)
    return rank[inverse.ravel()] if len(pairs) else np.empty(0, np.int64), len(first)


def _paths(shared: np.ndarray, parent: np.ndarray, of_turn: np.ndarray, pairs: np.ndarray) -> dict[int, bytes]:
    """A digest of the way from the root, for nodes given parents first."""
    paths: dict[int, bytes] = {}
    for node in shared.tolist():
        if node == ROOT:
            paths[node] = bytes(16)
        else:
            paths[node] = hashlib.blake2b(paths[int(parent[node])] + pairs[of_turn[node]].tobytes(),
                                          digest_size=16).digest()
    return paths


def _node_rows(nodes, rows, end_of, paths, parent, smallest, depths, n_convs, kids, leaves, saved) -> pa.RecordBatch:
    ends = pa.array(np.where(end_of[nodes] >= 0, end_of[nodes], 0), mask=end_of[nodes] < 0)
    up = np.where(parent[nodes] > 0, parent[nodes], 0)
    top = up == 0
    arrays = [pa.array([paths.get(s) for s in nodes.tolist()], pa.binary()),
              pa.array([paths.get(s) for s in up.tolist()], pa.binary()),
              rows["f1"].chunk(0).take(ends), rows["f2"].chunk(0).take(ends), pa.array(smallest[nodes]),
              pa.array(depths[nodes]), pa.array(smallest[up], mask=top),
              *(pa.array(v[nodes]) for v in (n_convs, kids, leaves, saved))]
    return pa.RecordBatch.from_arrays(arrays, [part.split()[0] for part in NODE.split(", ")])


def _merged(nodes: DataFrame, work: Workspace) -> DataFrame:
    """The nodes with the parts of shared ones added up and their smallest members known."""
    add = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    upper = work.keep("upper", nodes.where("path IS NOT NULL").groupBy("path").agg(
        F.max("parent_path").alias("parent_path"), F.max("f1").alias("f1"), F.max("f2").alias("f2"),
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *add))
    names = upper.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("met"))
    if upper.count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    alone = nodes.where("path IS NULL").drop("path")
    below = (alone.where("parent_path IS NOT NULL").drop("parent_conv_id")
             .unionByName(upper.drop("path")).join(names, "parent_path", "left")
             .withColumn("parent_conv_id", F.col("met")).drop("met", "parent_path"))
    return alone.where("parent_path IS NULL").drop("parent_path").unionByName(below)


def _ends(convs: DataFrame) -> DataFrame:
    """``(f1, f2, ends_sha256)``: pieces of ascending ids, digested one after the other."""
    piece = F.shiftright("conv_id", MEMBER_BITS)
    pieces = convs.groupBy("f1", "f2", piece.alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    return (pieces.select("f1", "f2", "piece", F.array_join(F.transform("ids", _decimal), ",").alias("ids"))
            .repartition("f1", "f2").sortWithinPartitions("f1", "f2", "piece")
            .mapInArrow(_digest, "f1 long, f2 long, ends_sha256 string"))


def _decimal(number: Column) -> Column:
    return number.cast("string")


def _digest(batches):
    """SHA-256 over the pieces of each sequence; holds one piece and one state."""
    at, state = None, None
    for batch in batches:
        keys, found = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), []
        for key, ids in zip(keys, batch.column(3).to_pylist()):
            if key == at:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                found.append((*at, state.hexdigest()))
            at, state = key, hashlib.sha256(ids.encode())
        if found:
            yield _digests(found)
    if state is not None:
        yield _digests([(*at, state.hexdigest())])


def _digests(found: list) -> pa.RecordBatch:
    f1, f2, sha = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(sha)],
                                      ["f1", "f2", "ends_sha256"])
