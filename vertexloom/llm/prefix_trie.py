"""Prefix trie of conversations in balanced parentheses, one shard after the other.

Conversations are sorted by the digests of their turns and cut into shards. A shard writes
its trie as parentheses in depth-first order: a node opens where the first conversation
through it comes, and closes where one comes that does not pass it. Blocks of the excess
and a tree of their minima find the closing parenthesis of every node. What stands between
the two is the subtree; differences of running counts up to both ends give its leaf pairs,
its members and its savings.

Only the paths of a shard's first and last conversation can go on in its neighbours. How
far they do is known from the neighbours' ends. A node counts as new, and a leaf as one,
in a single shard, so the figures of such a spine add up over the shards it runs through.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256
from math import ceil

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vertexloom.llm.common import small_batches, stored
from vertexloom.runtime import BROADCAST_ROWS, checkpoint

SHARED_TURNS, FAMILY = 9, 5
TURNS_PER_SHARD, LEAST_PER_SHARD = 200_000, 10_000
BLOCK = 256
WHOLE, BELOW_SPINE, SPINE, SPINE_END = 0, 1, 2, 3
NO_ENDS = sha256(b"").hexdigest()


# --- sequences ----------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` (digests ``h1``, ``h2`` and ``bytes`` of each turn, in order) of every conversation.

    Turns stand by ``turn``, null first; turns of one number, by their digests. A null role
    or text counts as empty. Rows without ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn"),
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role).alias("h2"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    known = conversations.where(F.col("conv_id").isNotNull())
    # all of a family in one place, so that rebuilding moves nothing again
    placed = known.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    placed = placed.withColumn("family", _family(F.col("conv_id"))).repartition("family")
    whole = placed.groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("family", "conv_id", F.transform("t", lambda t: F.struct(t["h1"], t["h2"], t["bytes"])).alias("turns"))


def _family(conv_id):
    return conv_id - conv_id % FAMILY


def rebuilt(found: DataFrame) -> DataFrame:
    """Of each conversation c the first h turns of conversation c - c % 5, then its own after its first h.

    h is the crc32 of c in decimal, modulo 9; % keeps the sign of c, as in SQL.
    """
    members = F.collect_list(F.struct("conv_id", "turns"))
    families = found.groupBy("family").agg(members.alias("members"))
    head = F.filter("members", lambda m: m["conv_id"] == F.col("family"))
    none = F.filter(F.get("members", F.lit(0))["turns"], lambda t: F.lit(False))
    each = families.select(F.coalesce(F.get(head, F.lit(0))["turns"], none).alias("head"), F.explode("members").alias("m"))
    h = (F.crc32(F.col("m.conv_id").cast("string").cast("binary")) % SHARED_TURNS).cast("int")
    own = F.slice("m.turns", h + 1, F.size("m.turns"))
    return each.select("m.conv_id", F.concat(F.slice("head", F.lit(1), h), own).alias("turns"))


# --- one shard ----------------------------------------------------------------


class Parentheses:
    """Balanced parentheses with blocks of excess and a tree of the blocks' minima."""

    def __init__(self, opens: np.ndarray):
        steps = np.full(2 * len(opens), -1, np.int32)
        steps[opens] = 1
        self.opens, self.excess = opens, np.cumsum(steps, dtype=np.int32)
        leaf = (steps == 1) & (np.append(steps[1:], 1) == -1)
        self.leaf_pairs = np.concatenate([[0], np.cumsum(leaf)])
        width = 1 << max(0, (-(-len(steps) // BLOCK) - 1).bit_length())
        padded = np.full(width * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(steps)] = self.excess
        self.blocks = padded.reshape(width, BLOCK)
        self.least = [self.blocks.min(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))

    def find_close(self) -> np.ndarray:
        """Place of the closing parenthesis of every opening one."""
        closes = np.full(len(self.opens), -1, np.int64)
        wanted = self.excess[self.opens] - 1
        # in the own block: one step for all that are still open
        active, at = np.arange(len(self.opens)), self.opens.astype(np.int64)
        beyond = []
        while len(active):
            at = at + 1
            inside = at % BLOCK != 0
            beyond.append(active[~inside])
            active, at = active[inside], at[inside]
            there = self.excess[at] == wanted[active]
            closes[active[there]] = at[there]
            active, at = active[~there], at[~there]
        active = np.concatenate(beyond) if beyond else active
        # in other blocks: up the tree of minima to the first one low enough, and down again
        node = self.opens[active].astype(np.int64) // BLOCK + 1
        target = wanted[active]
        found, level = np.zeros(len(active), np.int64), np.zeros(len(active), np.int64)
        rest, rise = np.arange(len(active)), 0
        while len(rest):
            low = self.least[rise][np.minimum(node[rest], len(self.least[rise]) - 1)] <= target[rest]
            found[rest[low]], level[rest[low]] = node[rest[low]], rise
            rest = rest[~low]
            # the next one at this level if it has the same parent, else the parent's neighbour
            right = node[rest] % 2 == 1
            node[rest] = np.where(right, (node[rest] + 1) // 2, node[rest] // 2)
            rise += 1
        for down in range(len(self.least) - 1, 0, -1):
            here = np.flatnonzero(level == down)
            left = 2 * found[here]
            found[here] = np.where(self.least[down - 1][left] <= target[here], left, left + 1)
            level[here] = down - 1
        for start in range(0, len(active), 4096):
            part = slice(start, start + 4096)
            first = (self.blocks[found[part]] <= target[part, None]).argmax(axis=1)
            closes[active[part]] = found[part] * BLOCK + first
        return closes


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def common_turns(lengths: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """How many turns each sequence shares with the one before it; 0 for the first."""
    starts = np.cumsum(lengths) - lengths
    out = np.zeros(len(lengths), np.int64)
    both = np.minimum(lengths[1:], lengths[:-1])
    at = _runs(both)
    same = (turns[np.repeat(starts[1:], both) + at] == turns[np.repeat(starts[:-1], both) + at]).all(axis=1)
    pair = np.repeat(np.arange(len(both)), both)
    out[1:] = both
    np.minimum.at(out[1:], pair[~same], at[~same])
    return out


def shard_nodes(
    ids: np.ndarray, lengths: np.ndarray, turns: np.ndarray, sizes: np.ndarray, before: int, after: int
) -> dict[str, np.ndarray | list]:
    """Nodes of a shard whose sequences are sorted, those of one content by id.

    ``before`` and ``after`` tell how many turns its first and last sequence share with
    their neighbours in other shards; -1 without such a neighbour.
    """
    common = common_turns(lengths, turns)
    starts = np.cumsum(lengths) - lengths
    new = lengths - common
    first_node = 1 + np.cumsum(new) - new
    opener = np.concatenate([[0], np.repeat(np.arange(len(ids)), new)])
    depth = np.concatenate([[0], np.repeat(common, new) + _runs(new) + 1])
    count = len(depth)
    bytes_ = np.concatenate([[0], sizes[starts[opener[1:]] + depth[1:] - 1]])
    closed = np.cumsum(np.concatenate([[0], lengths[:-1] - common[1:]]))
    tree = Parentheses(np.arange(count) + np.where(np.arange(count) > 0, closed[opener], 0))
    closes = tree.find_close()
    stop = np.arange(count) + (closes - tree.opens + 1) // 2

    # A sequence without new nodes equals the one before it.
    last_node = np.maximum.accumulate(np.where(new > 0, first_node + new - 1, 0))
    ends = np.concatenate([[0], np.cumsum(np.bincount(last_node, minlength=count))])
    members = ends[stop] - ends[:count]
    leaves = tree.leaf_pairs[closes + 1] - tree.leaf_pairs[tree.opens]
    final = last_node[-1]
    if after == lengths[-1]:  # goes on in the next shard, which sees whether it is a leaf
        leaves -= (np.arange(count) <= final) & (final < stop)
    owned = np.ones(count, bool)
    owned[: before + 1] = False  # the first sequence's path is 0, 1, ...
    saved = np.concatenate([[0], np.cumsum((members - owned) * bytes_)])
    # the parent is the last node before with one turn less
    order = np.lexsort((np.arange(count), depth))
    marks = depth[order] * count + order
    parent = np.zeros(count, np.int64)
    parent[1:] = order[np.searchsorted(marks, (depth[1:] - 1) * count + np.arange(1, count)) - 1]
    children = np.bincount(parent[1:][owned[1:]], minlength=count)

    # smallest id of a run of sequences, from minima over runs of two to a power
    minima = [ids]
    while 2 ** len(minima) <= len(ids):
        half = 2 ** (len(minima) - 1)
        minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
    power = np.floor(np.log2(members)).astype(np.int64)
    smallest = np.empty(count, np.int64)
    for p in np.unique(power):
        here = np.flatnonzero(power == p)
        smallest[here] = np.minimum(minima[p][opener[here]], minima[p][opener[here] + members[here] - 2**p])

    keys: list[bytes | None] = [None] * count
    last_path = np.zeros(int(lengths[-1]) + 1, np.int64)
    near = depth <= lengths[-1]
    np.maximum.at(last_path, depth[near], np.arange(count)[near])
    for path, start, reach in ((np.arange(before + 1), starts[0], before), (last_path, starts[-1], after)):
        name = b""
        for d in range(reach + 1):
            name = blake2b(name + (turns[start + d - 1].tobytes() if d else b""), digest_size=16).digest()
            keys[path[d]] = name
    spine = np.array([k is not None for k in keys])
    digests = [NO_ENDS] * count
    spine_ends: list[tuple[bytes, int, str]] = []
    for node in np.unique(last_node):
        own = ids[np.searchsorted(last_node, node) : np.searchsorted(last_node, node, side="right")].tolist()
        listed = ",".join(map(str, own))
        if spine[node]:
            spine_ends.append((keys[node], own[0], listed))
        else:
            digests[node] = sha256(listed.encode()).hexdigest()
    kind = np.where(spine, SPINE, np.where(spine[parent], BELOW_SPINE, WHOLE))
    kind[0] = SPINE if spine[0] else WHOLE
    has_parent = np.arange(count) > 0
    return {
        "kind": kind,
        "key": keys,
        "parent_key": [keys[p] if h else None for p, h in zip(parent, has_parent, strict=True)],
        "conv_id": smallest,
        "depth": depth,
        "parent_conv_id": smallest[parent],
        "n_convs": members,
        "n_children": children,
        "n_leaves": leaves,
        "saved_tokens": saved[stop] - saved[:count],
        "ends_sha256": digests,
        "spine_ends": spine_ends,
    }


NODES = (
    "kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def _shards(reach: dict[int, tuple[int, int]]):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        lengths = rows["sizes"].map(len).to_numpy(np.int64)
        flat = np.concatenate([*rows["digests"], np.zeros(0, np.int64)]).astype(np.int64)
        sizes = np.concatenate([*rows["sizes"], np.zeros(0, np.int64)]).astype(np.int64)
        before, after = reach[TaskContext.get().partitionId()]
        nodes = shard_nodes(rows["conv_id"].to_numpy(np.int64), lengths, flat.reshape(-1, 2), sizes, before, after)
        ends = nodes.pop("spine_ends")
        out = pd.DataFrame(nodes)
        for start in range(0, len(out), 50_000):
            yield out.iloc[start : start + 50_000]
        if ends:
            blank = {c: 0 for c in out.columns} | {"kind": SPINE_END, "parent_key": None}
            keys, first, listed = zip(*ends, strict=True)
            yield pd.DataFrame({**blank, "key": keys, "conv_id": first, "ends_sha256": listed})[out.columns]

    return build


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digest of the lists of ids of each key, from rows sorted by key and first id."""
    key, running = None, sha256()
    for batch in batches:
        for k, ids in zip(batch["key"], batch["ids"], strict=True):
            if k == key:
                running.update(f",{ids}".encode())
            else:
                if key is not None:
                    yield pd.DataFrame({"key": [key], "digest": [running.hexdigest()]})
                key, running = k, sha256(ids.encode())
    if key is not None:
        yield pd.DataFrame({"key": [key], "digest": [running.hexdigest()]})


# --- all shards ---------------------------------------------------------------


def _reach(ordered: DataFrame) -> dict[int, tuple[int, int]]:
    """For each shard, the turns that its ends share with its neighbours: two numbers a shard."""
    here = ordered.groupBy(F.spark_partition_id().alias("shard")).agg(
        F.min("digests").alias("first"), F.max("digests").alias("last")
    )
    in_order = Window.orderBy("shard")  # one row per shard
    met = here.withColumns({"earlier": F.lag("last").over(in_order), "later": F.lead("first").over(in_order)})

    def shared(a: str, b: str):
        differ = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True)
        both = F.least(F.size(a), F.size(b))
        turns = F.floor(F.when(differ > 0, F.least(differ - 1, both)).otherwise(both) / 2).cast("int")
        return F.when(F.col(a).isNull() | F.col(b).isNull(), F.lit(-1)).otherwise(turns)

    rows = met.select("shard", shared("earlier", "first").alias("before"), shared("last", "later").alias("after")).collect()
    return {r["shard"]: (r["before"], r["after"]) for r in rows}


def trie(found: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """One row per distinct prefix of the sequences ``conv_id``, ``turns`` (see :func:`sequences`).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. The
    root has depth 0. Sequences that are empty are members of the root alone. Without any
    sequence there are no nodes, no root either. Ids are distinct.

    A conversation's digests, 24 bytes a turn, meet in one row, so a task's memory grows
    with the longest conversation; it does not with the table.
    """
    spark = found.sparkSession
    small_batches(spark)
    flat = F.flatten(F.transform("turns", lambda t: F.array(t["h1"], t["h2"])))
    sizes = F.transform("turns", lambda t: t["bytes"])
    rows = stored(found.select("conv_id", flat.alias("digests"), sizes.alias("sizes")), "sequences")
    volume = rows.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0)).alias("n")).first()["n"]
    spread = min(spark.sparkContext.defaultParallelism, ceil(volume / LEAST_PER_SHARD))
    shards = max(1, spread, ceil(volume / turns_per_shard))
    order = ["digests", "conv_id"]
    # The checkpoint keeps the partitions: a shard is the same for its neighbours and itself.
    ordered = checkpoint(rows.repartitionByRange(shards, *order).sortWithinPartitions(*order))
    nodes = stored(ordered.mapInPandas(_shards(_reach(ordered)), NODES), "trie-nodes")

    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    merged = (
        nodes.where(F.col("kind") == SPINE)
        .groupBy("key")
        .agg(
            F.max("parent_key").alias("parent_key"),
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            *[F.sum(c).alias(c) for c in figures],
        )
    )
    # A digest needs its ids one after the other: of a key that runs through shards, a row for each, streamed.
    ends = nodes.where(F.col("kind") == SPINE_END).select("key", "conv_id", F.col("ends_sha256").alias("ids")).repartition("key")
    digests = ends.sortWithinPartitions("key", "conv_id").mapInPandas(_ends, "key binary, digest string")
    merged = stored(merged.join(digests, "key", "left"), "trie-spines")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    if merged.count() <= BROADCAST_ROWS:
        parents = F.broadcast(parents)
    result = ["conv_id", "depth", "parent_conv_id", *figures, "ends_sha256"]
    whole = nodes.where(F.col("kind") == WHOLE).withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id"))
    )
    below = nodes.where(F.col("kind") == BELOW_SPINE).join(parents, "parent_key").withColumn("parent_conv_id", F.col("above"))
    spines = merged.withColumn("ends_sha256", F.coalesce("digest", F.lit(NO_ENDS))).join(parents, "parent_key", "left")
    spines = spines.withColumn("parent_conv_id", F.col("above"))
    return whole.select(result).unionByName(below.select(result)).unionByName(spines.select(result))


def prefix_trie(conversations: DataFrame, rebuild: bool = False, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """The trie of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``; further columns are not looked at).

    Nodes are distinct sequences of first turns, told apart by role and text; see
    :func:`trie`. Rows that repeat are turns of their own. ``rebuild`` puts the turns of
    another conversation first, see :func:`rebuilt`.
    """
    found = sequences(conversations)
    return trie(rebuilt(found) if rebuild else found.select("conv_id", "turns"), turns_per_shard)
