"""Prefix trie of conversations in balanced parentheses, built per shard; nodes that shards share are merged.

A conversation becomes the row of its turns (16 bytes of digest and a length each, never the texts). Conversations are
sorted by that row, then by id, and cut into ranges: a range is a shard, one task. Equal conversations may lie in several
shards, so a group of copies of any size is dealt evenly. In a shard the sorted rows spell out the trie in preorder: what
a row shares with the row before it stays open, the rest is closed and opened. That gives balanced parentheses.
`findclose`, by excess over blocks of places and a tree of block minima, delimits each subtree; the rank of `()` pairs
between a node's parentheses counts its leaves; cumulative arrays in preorder give its savings.

Shards share only what the last row before a cut has in common with the first row behind it, so a shard need know no more
of the others than the last row of the shard before and the first row of the shard behind. A shared node is counted as
a node in the first shard that has it; later shards add their members to it, and take its leaf back where they give it its
first child. All figures of a node are then sums over the shards that hold it, and shared nodes are merged by one
grouping on the digest of their prefix.

Members that end at a shared node are put in order of id by one more shuffle and hashed in a stream, with one running hash
in memory, since SHA-256 is sequential by definition.

Defined results: rows without conv_id belong to no conversation; null role or text is empty; rows of one conversation with
equal turn come in the order of their digests; an empty table has no node. The turns of one conversation must fit one
row: 16 bytes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import staged, tasks_for

#: Width of a turn in a path: a truncated SHA-256.
WIDTH = 16
TURNS_PER_SHARD = 200_000
#: Places a block of the min-max tree covers.
BLOCK = 64

_NODE = ("kind int, shard int, seq int, parent_seq int, key binary, parent_key binary, conv_id long, depth long, "
         "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
_FIELDS = [part.split()[0] for part in _NODE.split(", ")]
#: Kinds of rows a shard gives: a node with known parent, one whose parent is shared, its part of a shared node, and a
#: conversation that ends at a shared node.
WHOLE, ORPHAN, PART, END = range(4)


# --- conversations -----------------------------------------------------------------------------------------

def turn_digest(role: Column, text: Column) -> Column:
    """Digest of a turn; the length keeps role and text apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)


def conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """conv_id and turns (array of digest, size) in order of turn, null first."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).isNotNull().alias("numbered"), F.col(turn_col).alias("turn"),
                 turn_digest(role, text).alias("digest"), F.char_length(text).cast("long").alias("size")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(
        t.digest.alias("digest"), t["size"].alias("size"))).alias("turns"))


def with_shared_heads(convs: DataFrame, head: Column, heads: int, span: int = 100) -> DataFrame:
    """Each conversation with its first `head` turns (below `heads`) replaced by those of the conversation at the start of
    its span of ids; none if that is absent."""
    base = F.col("conv_id") - F.col("conv_id") % span
    starts = convs.where(F.col("conv_id") % span == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads).alias("opening"))
    none = F.slice("turns", 1, 0)
    joined = convs.withColumn("base", base).join(starts, "base", "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("opening", none), F.lit(1), head),
                                             F.slice("turns", head + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


# --- balanced parentheses ----------------------------------------------------------------------------------

class Parentheses:
    """Balanced parentheses (1 opens, 0 closes) with the excess over them in blocks, and a tree of block minima."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        blocks = 1 << max(0, (max(1, -(-len(bits) // BLOCK)) - 1).bit_length())
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:len(bits)] = self.excess
        self.padded = padded.reshape(blocks, BLOCK)
        least = self.padded.min(axis=1)
        self.levels = [least]  # from the blocks up to the root
        while len(least) > 1:
            least = least.reshape(-1, 2).min(axis=1)
            self.levels.append(least)

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Place of the parenthesis that closes each of the given open ones: the first behind it of lower excess."""
        want = self.excess[opens] - 1
        found = np.full(len(opens), -1)
        block = opens // BLOCK
        later = np.arange(BLOCK)[None, :] > (opens % BLOCK)[:, None]
        self._first(found, np.arange(len(opens)), block, want, later)
        rest = np.flatnonzero(found < 0)
        if len(rest):
            self._first(found, rest, self._block_after(block[rest], want[rest]), want[rest], True)
        return found

    def _first(self, found: np.ndarray, rows: np.ndarray, block: np.ndarray, want: np.ndarray, where) -> None:
        """Scan one block for each row."""
        for at in range(0, len(rows), 4096):
            part = slice(at, at + 4096)
            hit = (self.padded[block[part]] <= want[part, None]) & (where if where is True else where[part])
            there = hit.any(axis=1)
            found[rows[part][there]] = block[part][there] * BLOCK + hit[there].argmax(axis=1)

    def _block_after(self, block: np.ndarray, want: np.ndarray) -> np.ndarray:
        """First block behind `block` whose least excess is at most `want`: up the tree, then down."""
        node, level = block.copy(), np.zeros(len(block), int)
        climbing = np.arange(len(block))
        for height in range(len(self.levels) - 1):
            n = node[climbing]
            least = self.levels[height]
            stop = (n % 2 == 0) & (least[n ^ 1] <= want[climbing])
            node[climbing[stop]] += 1
            level[climbing[stop]] = height
            climbing = climbing[~stop]
            node[climbing] >>= 1
        for height in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(level >= height)
            left = node[down] * 2
            node[down] = left + (self.levels[height - 1][left] > want[down])
        return node


def common_turns(a: bytes, b: bytes) -> int:
    """Number of leading turns that two paths share."""
    n = min(len(a), len(b)) // WIDTH
    if a[:n * WIDTH] == b[:n * WIDTH]:
        return n
    x, y = (np.frombuffer(p[:n * WIDTH], np.uint8).reshape(n, WIDTH) for p in (a, b))
    return int((x != y).any(axis=1).argmax())


class Shard:
    """Trie of sorted (path, sizes, conv_id), in preorder."""

    def __init__(self, paths: list[bytes], sizes: list[np.ndarray], ids: np.ndarray, before: bytes | None, behind: bytes | None):
        self.paths, self.ids = paths, ids
        turns = np.array([len(p) // WIDTH for p in paths])
        same = np.array([0, *(common_turns(a, b) for a, b in zip(paths, paths[1:]))])
        opened = turns - same
        first = np.concatenate([[1], 1 + np.cumsum(opened)])  # number of the first node a row opens; 0 is the root
        n = int(first[-1])
        self.depth, self.size, self.parent = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1)
        self.row = np.zeros(n, np.int64)  # row that opens a node, which is its first member
        open_nodes = np.zeros(int(turns.max(initial=0)) + 1, np.int64)
        self.last = np.zeros(len(paths), np.int64)  # node at which a row ends
        for i, (low, high) in enumerate(zip(same, turns)):
            fresh = np.arange(first[i], first[i + 1])
            open_nodes[low + 1:high + 1] = fresh
            self.depth[fresh], self.row[fresh] = np.arange(low + 1, high + 1), i
            self.size[fresh] = sizes[i][low:high]
            self.parent[fresh] = open_nodes[low:high]
            self.last[i] = open_nodes[high]
        # Before the nodes of a row come the closing parentheses of what it does not share with the row before.
        closed = np.concatenate([[0], turns[:-1] - same[1:]])
        counts = np.concatenate([[1], np.stack([closed, opened], 1).ravel(), [turns[-1] + 1]])
        self.bp = Parentheses(np.repeat(np.concatenate([[1], np.tile([0, 1], len(paths)), [0]]).astype(np.uint8), counts))
        self.place = np.flatnonzero(self.bp.bits)
        self.close = self.bp.findclose(self.place)
        # The subtree of a node is the run of nodes, in preorder, that are open by its closing parenthesis.
        self.end = np.cumsum(self.bp.bits)[self.close]
        # Its members are the rows from the one that opens it on that are over by then.
        self.rows_end = np.searchsorted(1 + np.cumsum(closed + opened), self.close, "right")
        self.left = common_turns(before, paths[0]) if before is not None else -1
        self.right = common_turns(paths[-1], behind) if behind is not None else -1
        self.continued = np.zeros(n, bool)
        self.continued[0] = self.left >= 0
        self.continued[1:1 + max(0, self.left)] = True
        self.shared = self.continued.copy()
        self.shared[self._path(len(paths) - 1)[:self.right + 1]] = True
        #: The node at which the last row before this shard ends, where the shard has it: a leaf so far.
        self.leaf_before = self.left if before is not None and self.left == len(before) // WIDTH else -1

    def _path(self, row: int) -> np.ndarray:
        """Nodes from the root to the one at which a row ends."""
        path, node = [], int(self.last[row])
        while node >= 0:
            path.append(node)
            node = int(self.parent[node])
        return np.array(path[::-1])

    def nodes(self, shard: int) -> Iterator[pd.DataFrame]:
        n, bits = len(self.depth), self.bp.bits
        members = self.rows_end - self.row
        owned = ~self.continued
        children = np.bincount(self.parent[1:][owned[1:]], minlength=n)
        # `()` is a node without children here. One that continues was counted by the shard that opened it.
        pair = bits[self.place + 1] == 0
        leaf = (pair & owned).astype(np.int64)
        if self.leaf_before >= 0 and not pair[self.leaf_before]:
            leaf[self.leaf_before] = -1
        saving = (members - owned) * self.size
        rank = np.concatenate([[0], np.cumsum(leaf)])
        saved = np.concatenate([[0], np.cumsum(saving)])
        own = np.arange(n)
        least = np.minimum.reduceat(np.append(self.ids, np.iinfo(np.int64).max),
                                    np.stack([self.row, self.rows_end], 1).ravel())[::2]
        ending = np.argsort(self.last, kind="stable")
        cuts = np.searchsorted(self.last[ending], np.arange(n + 1))
        digests, empty = [], hashlib.sha256(b"").hexdigest()
        for node in range(n):
            rows = ending[cuts[node]:cuts[node + 1]]
            digests.append(empty if not len(rows) or self.shared[node] else
                           hashlib.sha256(",".join(map(str, self.ids[rows].tolist())).encode()).hexdigest())
        keys = self._keys()
        orphan = self.shared[self.parent] & (own > 0)
        kind = np.where(self.shared, PART, np.where(orphan, ORPHAN, WHOLE))
        upper = [keys.get(p) if s else None for p, s in zip(self.parent.tolist(), self.shared.tolist())]
        table = pd.DataFrame({
            "kind": kind, "shard": shard, "seq": own, "parent_seq": self.parent, "key": [keys.get(i) for i in range(n)],
            "parent_key": upper, "conv_id": least, "depth": self.depth,
            "parent_conv_id": pd.array(least[self.parent], "Int64"), "n_convs": members, "n_children": children,
            "n_leaves": rank[self.end] - rank[own], "saved_tokens": saved[self.end] - saved[own], "ends_sha256": digests})
        table.loc[kind != WHOLE, "parent_conv_id"] = pd.NA
        table.loc[0, "parent_conv_id"] = pd.NA
        yield table
        ends = np.flatnonzero(self.shared[self.last])
        for at in range(0, len(ends), 65_536):
            part = ends[at:at + 65_536]
            yield pd.DataFrame({"kind": END, "key": [keys[i] for i in self.last[part].tolist()], "conv_id": self.ids[part]}).reindex(
                columns=_FIELDS)

    def _keys(self) -> dict[int, bytes]:
        """Digest of the prefix of each shared node; these lie on the first and the last path alone."""
        keys = {}
        for row in {0, len(self.paths) - 1}:
            running, path = hashlib.sha256(), self.paths[row]
            for depth, node in enumerate(self._path(row).tolist()):
                if not self.shared[node]:
                    break
                if depth:
                    running.update(path[(depth - 1) * WIDTH:depth * WIDTH])
                keys[node] = running.digest()
        return keys


# --- the trie ----------------------------------------------------------------------------------------------

def _table(frame: pd.DataFrame) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(name, types[kind]) for name, kind in (part.split() for part in _NODE.split(", "))])
    return pa.Table.from_pandas(frame, schema, preserve_index=False)


def trie(convs: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """One row per node of the trie over `convs` (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.digest)), ""))
    rows = staged(convs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")),
                  "paths")
    size = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = tasks_for(size, turns_per_shard)
    # An explicit number of ranges is not changed at run time, and what is written once keeps its cuts.
    placed = staged(rows.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
                    .mapInArrow(_numbered, "shard int, line long, conv_id long, path binary, sizes array<long>"), "shards")
    # One row per shard: its first and its last path, beside those of its neighbours.
    edge = placed.groupBy("shard").agg(F.min_by("path", "line").alias("first"), F.max_by("path", "line").alias("last"))
    order = Window.orderBy("shard")
    edges = edge.select("shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("behind"))
    parts = staged(placed.groupBy("shard").cogroup(edges.groupBy("shard")).applyInArrow(_shard_nodes, _NODE), "nodes")

    shared = parts.where(F.col("kind") == PART).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    shared = staged(shared, "shared")
    names = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    ends = (parts.where(F.col("kind") == END).select("key", "conv_id").repartition("key")
            .sortWithinPartitions("key", "conv_id").mapInArrow(_hash_runs, "key binary, ends_sha256 string"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    merged = (shared.join(names, "parent_key", "left").join(ends, "key", "left")
              .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))).select(*columns))
    # Children of shared nodes find them by shard and number there, so no key has more rows than a shard has nodes.
    there = (parts.where(F.col("kind") == PART).select("shard", F.col("seq").alias("parent_seq"), "key")
             .join(names.withColumnRenamed("parent_key", "key"), "key").select("shard", "parent_seq", "parent_conv_id"))
    orphans = (parts.where(F.col("kind") == ORPHAN).drop("parent_conv_id").join(there, ["shard", "parent_seq"])
               .select(*columns))
    return parts.where(F.col("kind") == WHOLE).select(*columns).unionByName(orphans).unionByName(merged)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their range and their place in it."""
    shard, line = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(line, line + n)), *batch.columns],
            ["shard", "line", "conv_id", "path", "sizes"])
        line += n


def _shard_nodes(rows: pa.Table, edges: pa.Table) -> pa.Table:
    rows = rows.sort_by("line")
    edge = edges.to_pylist()[0]
    sizes = rows.column("sizes").combine_chunks()
    values, offsets = sizes.values.to_numpy(), sizes.offsets.to_numpy()
    shard = Shard(rows.column("path").to_pylist(), [values[a:b] for a, b in zip(offsets, offsets[1:])],
                  rows.column("conv_id").to_numpy(), edge["before"], edge["behind"])
    return pa.concat_tables([_table(f) for f in shard.nodes(edge["shard"])])


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each run of equal keys, comma-joined; one running hash is held."""
    key = running = None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])

    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(keys):
            stop = at
            while stop < len(keys) and keys[stop] == keys[at]:
                stop += 1
            if keys[at] != key:
                if key is not None:
                    yield done()
                key, running = keys[at], hashlib.sha256()
            else:
                running.update(b",")
            running.update(",".join(map(str, ids[at:stop])).encode())
            at = stop
    if key is not None:
        yield done()
