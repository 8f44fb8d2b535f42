"""The trie of conversation prefixes, as balanced parentheses per shard.

A node is a distinct sequence of a conversation's first d turns. Turns are compared by a
128-bit digest of role and text; a conversation's path is its digests one after another.

- Conversations are dealt to shards by ranges of (path, conversation), so that those of one
  node lie next to each other whatever their number, and a path of which there are very many
  is split by conversation.
- A shard writes its trie in preorder as balanced parentheses. ``find_close`` delimits a
  subtree: the next place with a smaller excess, looked for in the block, then over a tree of
  the blocks' least excesses, then in the block found. Ranks of "()" pairs count leaves, and
  cumulative arrays over preorder give members and savings of a subtree as differences.
- Only nodes on a shard's first and last path, its spine, can lie in other shards as well. All
  others are complete. Spines carry what the complete nodes below give them, and are merged
  ``FAN_IN`` shards at a time until one group is left; nodes that no other group can have are
  completed on the way. Ends of a node that spans shards are digested in shard order as a
  stream.

Bounds. A shard is a shuffle partition of narrow rows: 16 bytes and a size a turn, no texts. A
conversation is one row of these, so the longest must fit a task many times over. A merge
reads two paths a shard, so ``FAN_IN`` shards are about one shard's rows. SHA-256 is sequential:
the ids that end at one node pass one task as a stream, some thousand a row.

Defined cases: a null role or text is empty; rows without a conversation belong to none and are
left out; equal turns of a conversation are ordered by their digest, and repeated rows are turns
of their own; an empty table gives no nodes. Columns beside the four read do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import written

DIGEST = 16
BLOCK = 64
FAN_IN = 1024
IDS_A_PIECE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODES = (
    "part string, shard bigint, place bigint, key binary, parent_key binary, depth bigint, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_bytes bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends binary"
)
ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
FIELDS = [tuple(x.split()) for x in NODES.split(", ")]


def turn_lists(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as digest and bytes of text."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.md5(empty("role").cast("binary")), empty("text")).cast("binary"))
    named = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), digest.alias("digest"),
            F.octet_length(empty("text")).cast("bigint").alias("size"),
        ).alias("t"),
    )
    return named.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % ``group``.

    h is the CRC-32 of c in decimal, modulo ``most``; c's own turns after its first h follow.
    """
    base = lists.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, most - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = lists.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % group).alias("base_id"), h.alias("h"))
    both = own.join(base, "base_id", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    tail = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return both.select("conv_id", F.concat(head, tail).alias("turns"))


def paths(lists: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): the turns' digests one after another, and the bytes of their texts."""
    field = lambda name: F.transform("turns", lambda t: t[name])
    return lists.select("conv_id", F.unhex(F.array_join(field("digest"), "")).alias("path"), field("size").alias("sizes"))


# -- balanced parentheses -----------------------------------------------------------------
class Excess:
    """Excess of a sequence of parentheses, with the least excess of every block and a tree over them."""

    def __init__(self, opens: np.ndarray, block: int = BLOCK):
        self.block = block
        self.excess = np.cumsum(np.where(opens, 1, -1))
        n = -(-max(len(opens), 1) // block)
        leaves = 1 << (n - 1).bit_length()
        padded = np.full(leaves * block, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.leaves = leaves
        self.tree = np.empty(2 * leaves, np.int64)
        self.tree[leaves:] = padded.reshape(leaves, block).min(1)
        for level in range(leaves.bit_length() - 2, -1, -1):
            low = 1 << level
            self.tree[low : 2 * low] = np.minimum(self.tree[2 * low : 4 * low : 2], self.tree[2 * low + 1 : 4 * low : 2])

    def _within(self, at: np.ndarray, below: np.ndarray) -> np.ndarray:
        """First place from ``at`` to its block's end with excess under ``below``, or -1."""
        out = np.full(len(at), -1, np.int64)
        asking, place = np.arange(len(at)), at.copy()
        end = np.minimum((at // self.block + 1) * self.block, len(self.excess))
        while len(asking):
            inside = place < end[asking]
            asking, place = asking[inside], place[inside]
            hit = self.excess[place] < below[asking]
            out[asking[hit]] = place[hit]
            asking, place = asking[~hit], place[~hit] + 1
        return out

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of the opening ones at ``at``."""
        below = self.excess[at]
        out = self._within(at + 1, below)
        left = np.flatnonzero(out < 0)
        if len(left):
            target = below[left]
            node = at[left] // self.block + self.leaves
            # Up, until a right neighbour holds a smaller excess; then down to its first block that does.
            while True:
                climbs = (node & 1 == 1) | (self.tree[np.minimum(node + 1, 2 * self.leaves - 1)] >= target)
                if not climbs.any():
                    break
                node = np.where(climbs, node >> 1, node)
            node = node + 1
            while (node < self.leaves).any():
                down = node < self.leaves
                child = 2 * node
                child = np.where(self.tree[np.minimum(child, 2 * self.leaves - 1)] < target, child, child + 1)
                node = np.where(down, child, node)
            out[left] = self._within((node - self.leaves) * self.block, target)
        return out


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * DIGEST] == b[: middle * DIGEST] else (low, middle - 1)
    return low


def _subtree_least(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least of each node's own and its descendants' values, in preorder."""
    out, level, width = values.copy(), values, 1
    while width <= size.max(initial=0):
        here = np.flatnonzero((size >= width) & (size < 2 * width))
        out[here] = np.minimum(level[here], level[here + size[here] - width])
        level = np.minimum(level[:-width], level[width:]) if len(level) > width else level[:0]
        width *= 2
    return out


def _keys(path: bytes) -> list[bytes]:
    """Names of the nodes on a path, the root's first."""
    seen = hashlib.md5(usedforsecurity=False)
    out = [seen.digest()]
    for at in range(0, len(path), DIGEST):
        seen.update(path[at : at + DIGEST])
        out.append(seen.digest())
    return out


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], ARROW[t]) for n, t in FIELDS], [n for n, _ in FIELDS])


def shard_nodes(conv: np.ndarray, path: list[bytes], sizes: list[np.ndarray], shard: int) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard's conversations, which lie sorted by (path, conversation).

    Rows of part "node" are complete but for a parent on the spine; those of part "spine" lack
    what other shards and spine nodes below add; those of part "ends" are pieces of a spine
    node's ids in order.
    """
    n_paths = len(path)
    depth_of = np.array([len(p) // DIGEST for p in path], np.int64)
    shared = np.array([0, *[_common(a, b) for a, b in zip(path, path[1:])]], np.int64)
    # Each path closes what it does not share with the one before and opens its rest; the root is opened first.
    closes = np.concatenate([[0], depth_of[:-1] - shared[1:]])
    opened = depth_of - shared
    runs = np.stack([closes, opened], 1).ravel()
    opens = np.concatenate([[True], np.repeat(np.tile([False, True], n_paths), runs), np.zeros(depth_of[-1] + 1, bool)])
    at = np.flatnonzero(opens)
    n = len(at)
    bits = Excess(opens)
    close = bits.find_close(at)
    size = (close - at + 1) // 2
    depth = bits.excess[at] - 1
    first_new = 1 + np.cumsum(opened) - opened
    # The node each path ends at, and each node's parent, along the path that opens it.
    ends_at, parent = np.empty(n_paths, np.int64), np.arange(-1, n - 1)
    along: np.ndarray = np.zeros(int(depth_of.max(initial=0)) + 1, np.int64)
    node_bytes = np.zeros(n, np.int64)
    for k in range(n_paths):
        low, high, new = int(shared[k]), int(depth_of[k]), int(first_new[k])
        if high > low:
            parent[new] = along[low]
            along[low + 1 : high + 1] = np.arange(new, new + high - low)
            node_bytes[new : new + high - low] = sizes[k][low:high]
        ends_at[k] = along[high]
    spine = np.zeros(n, bool)
    first, last = np.zeros(int(depth_of[0]) + 1, np.int64), along[: int(depth_of[-1]) + 1].copy()
    first[1:] = np.arange(1, int(depth_of[0]) + 1)
    spine[first] = spine[last] = True

    upto = lambda values: np.concatenate([[0], np.cumsum(values)])
    below = lambda sums: sums[np.arange(n) + size] - sums[:n]
    members = below(upto(np.bincount(ends_at, minlength=n)))
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, ends_at, conv)
    least = _subtree_least(least, size)
    # Leaves are "()" pairs; those on the spine are counted when spines are merged.
    pair = np.zeros(len(opens), bool)
    pair[:-1] = opens[:-1] & ~opens[1:]
    pair[at[spine]] = False
    rank = upto(pair)
    leaves = rank[close + 1] - rank[at]
    saved = below(upto(np.where(spine, 0, (members - 1) * node_bytes)))
    children = np.bincount(parent[1:][~spine[1:]], minlength=n)
    # A spine node leaves what lies below its child on the spine to that child.
    inner = np.flatnonzero(spine)[1:]
    for sums in (leaves, saved):
        np.subtract.at(sums, parent[inner], sums[inner].copy())

    # Conversations that end at a node lie in one run, in ascending order.
    where = np.searchsorted(ends_at, np.arange(n)), np.searchsorted(ends_at, np.arange(n), "right")
    text = conv.astype(str)
    key_of: dict[int, bytes] = {}
    for nodes, whole_path in ((first, path[0]), (last, path[-1])):
        key_of.update(zip(nodes.tolist(), _keys(whole_path)))

    def rows(chosen: np.ndarray, part: str) -> pa.RecordBatch:
        some = chosen.tolist()
        above = parent[chosen].tolist()
        open_ = part == "spine"
        digest = lambda k: hashlib.sha256(",".join(text[where[0][k] : where[1][k]]).encode()).digest()
        return _batch({
            "part": [part] * len(some), "shard": [shard] * len(some), "place": some,
            "key": [key_of.get(k) for k in some], "parent_key": [key_of.get(p) for p in above], "depth": depth[chosen].tolist(),
            "conv_id": least[chosen].tolist(), "parent_conv_id": [None if p < 0 or p in key_of else int(least[p]) for p in above],
            "n_convs": members[chosen].tolist(), "n_bytes": node_bytes[chosen].tolist(), "n_children": children[chosen].tolist(),
            "n_leaves": leaves[chosen].tolist(), "saved_tokens": saved[chosen].tolist(),
            "ends": [None if open_ else digest(k) for k in some],
        })

    nodes = np.flatnonzero(~spine)
    for low in range(0, len(nodes), 10_000):
        yield rows(nodes[low : low + 10_000], "node")
    on_spine = np.flatnonzero(spine)
    for low in range(0, len(on_spine), 10_000):
        yield rows(on_spine[low : low + 10_000], "spine")
    for k in on_spine.tolist():
        for piece, low in enumerate(range(int(where[0][k]), int(where[1][k]), IDS_A_PIECE)):
            ids = ",".join(text[low : min(low + IDS_A_PIECE, int(where[1][k]))]).encode()
            blank = {name: [None] for name, _ in FIELDS}
            yield _batch(blank | {"part": ["ends"], "shard": [shard], "place": [piece], "key": [key_of[k]], "ends": [ids]})


def _shards(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        flat = table.column("sizes").combine_chunks()
        cut = np.concatenate([[0], np.cumsum(flat.value_lengths().to_numpy())])
        values = flat.flatten().to_numpy(zero_copy_only=False)
        sizes = [values[low:high] for low, high in zip(cut[:-1], cut[1:])]
        yield from shard_nodes(table.column("conv_id").to_numpy(), table.column("path").to_pylist(), sizes, TaskContext.get().partitionId())

    return rows.mapInArrow(run, NODES)


# -- spines -------------------------------------------------------------------------------
def merge_spines(rows: list[dict], only: bool) -> tuple[list[dict], list[dict]]:
    """Spine rows of neighbouring shards as one: (complete nodes, the group's own spine).

    Rows come by shard and preorder, so a parent before its children. Nodes that lie neither on
    the first shard's first path nor on the last shard's last path are complete; all are if
    there is ``only`` this group.
    """
    nodes: dict[bytes, dict] = {}
    first, last = rows[0]["shard"], rows[-1]["shard"]
    for row in rows:
        have = nodes.get(row["key"])
        if have is None:
            nodes[row["key"]] = have = {**row, "outer": False}
        else:
            have["conv_id"] = min(have["conv_id"], row["conv_id"])
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                have[name] += row[name]
        # A shard's own spine has its first and its last path; both stay open in an outer shard.
        have["outer"] |= not only and row["shard"] in (first, last)
    order = list(nodes.values())
    for node in reversed(order):
        if not node["outer"]:
            node["n_leaves"] += node["n_children"] == 0
            node["saved_tokens"] += (node["n_convs"] - 1) * node["n_bytes"]
            above = nodes.get(node["parent_key"])
            if above is not None:
                above["n_children"] += 1
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
    for node in order:
        if not node.pop("outer"):
            node["part"] = "done"
            above = nodes.get(node["parent_key"])
            if above is not None and above["part"] == "done":
                node["parent_conv_id"] = above["conv_id"]
    for place, node in enumerate(order):
        node["place"] = place
    return [x for x in order if x["part"] == "done"], [x for x in order if x["part"] == "spine"]


def _merged(spines: DataFrame, fan_in: int, only: bool) -> DataFrame:
    """One round of merges; rows of part "done" are complete but for their ends and parents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                done, open_ = merge_spines(held, only)
                rows = done + [{**x, "shard": group} for x in open_]
                yield _batch({n: [x[n] for x in rows] for n, _ in FIELDS})

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] // fan_in != group:
                    yield from flush()
                    group, held = row["shard"] // fan_in, []
                held.append(row)
        yield from flush()

    group = F.floor(F.col("shard") / fan_in)
    return spines.repartition(group).sortWithinPartitions("shard", "place").mapInArrow(run, NODES)


def _digests(pieces: DataFrame) -> DataFrame:
    """(key, ends): digest of a node's ids, from its pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.digest()], pa.binary())], ["key", "ends"])
        for batch in batches:
            for name, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if name != key:
                    if state is not None:
                        yield row()
                    key, state = name, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
        if state is not None:
            yield row()

    rows = pieces.select("key", "shard", "place", "ends").repartition("key").sortWithinPartitions("key", "shard", "place")
    return rows.mapInArrow(run, "key binary, ends binary")


def trie(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Nodes of the trie of paths (conv_id, path, sizes), one row each.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    ``conv_id`` is the smallest of the node's ``n_convs`` conversations, ``saved_tokens`` counts
    bytes that the subtree's nodes share.
    """
    dealt = written(rows, "trie-paths").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = written(_shards(dealt), "trie-shards")
    done, spines = [], found.filter("part = 'spine'")
    while True:
        top = spines.agg(F.max("shard")).first()[0]
        only = top is None or top < fan_in
        level = written(_merged(spines, fan_in, only), "trie-spines")
        done.append(level.filter("part = 'done'"))
        if only:
            break
        spines = level.filter("part = 'spine'")
    merged = done[0]
    for more in done[1:]:
        merged = merged.unionByName(more)
    merged = written(merged.drop("ends").join(_digests(found.filter("part = 'ends'")), "key", "left"), "trie-spine")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    hex_ends = F.coalesce(F.lower(F.hex("ends")), F.lit(NO_ENDS))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", hex_ends.alias("ends_sha256")]
    nodes = found.filter("part = 'node'").select(*columns, "parent_key", "parent_conv_id")
    both = nodes.unionByName(merged.select(*columns, "parent_key", "parent_conv_id"))
    # Most nodes have no spine node above and need no look-up.
    inner = both.filter("parent_key IS NULL")
    outer = both.filter("parent_key IS NOT NULL").join(above, "parent_key", "left")
    outer = outer.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    out = inner.unionByName(outer, allowMissingColumns=True)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
