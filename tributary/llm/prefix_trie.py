"""The trie of conversation prefixes by sorted shards and a skeleton of splitter paths.

A conversation is a path of turns, a turn two 64-bit digests of its role and text and
the number of bytes of its text. Paths are range-partitioned by (path, conv_id): even
a path that many conversations share is cut between shards, along their ids. In the
order of paths a node's members stand together, so a node lies in one shard unless it
is a prefix of the paths on both sides of a splitter. These are the skeleton: the trie
of splitter paths, given by the depths which neighbouring shards share (the depths
shared by sorted paths determine their trie). It is broadcast, two numbers a shard.

Each shard goes through its sorted paths once with a stack of open nodes and finishes
all nodes outside the skeleton. For skeleton nodes it gives partial aggregates, all of
them sums or minima over its own paths:

* a node is new where a path leaves the one before it, also across a splitter, so
  children are counted once;
* a childless node ends where the next path does not go on from it;
* the bytes that a path shares with the one before it are what its subtrees save.

A reduction by node adds them up. Ids that end in a skeleton node come as blocks of
text in order and are hashed as a stream, whatever their number.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.skew import skew_join
from tributary.staging import stage

#: Turns of a shard at most, on average; a shard's nodes are held by one task.
TURNS_A_SHARD = 250_000
#: Ids in one block of the text that is hashed for a skeleton node.
IDS_A_BLOCK = 4096

_PATH = "array<struct<a: bigint, b: bigint, bytes: bigint>>"
_NONE_ENDS = hashlib.sha256().hexdigest()

# what a row of a shard's result is: a finished node whose parent is known, or stands in
# the skeleton; a part of a skeleton node; a block of ids that end in a skeleton node
_DONE, _UNDER_SKELETON, _PART, _ENDS = range(4)

_RESULT = pa.schema([
    ("kind", pa.int32()), ("key", pa.string()), ("parent_key", pa.string()), ("shard", pa.int32()), ("block", pa.int32()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string())])
_RESULT_DDL = ("kind int, key string, parent_key string, shard int, block int, conv_id long, depth long, parent_conv_id long, "
               "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """conv_id and path of each conversation, its turns in order.

    Null turns come first; turns of one number are ordered by their digests, so repeated
    rows are turns of their own. Null roles and texts are empty. Rows without conv_id take
    no part. Columns beside conv_id, turn, role and text are not read. A conversation is one
    row, of 24 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"), F.octet_length(text).cast("long").alias("bytes"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("own")).where("conv_id IS NOT NULL")
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("own")).alias("turns"))
    return ordered.select("conv_id", F.expr("transform(turns, t -> struct(t.a, t.b, t.bytes))").cast(_PATH).alias("path"))


def with_shared_heads(paths: DataFrame, family: int = 5, longest: int = 8) -> DataFrame:
    """Paths whose first turns come from the first conversation of their family.

    Conversation c takes the first h turns of conversation c - c % family, all if there are
    fewer and none without such a conversation, then its own turns after its first h, h being
    crc32 of c in decimal modulo longest + 1.
    """
    head = F.crc32(F.col("conv_id").cast("string")) % (longest + 1)
    own = paths.select("conv_id", "path", head.cast("int").alias("h"), F.expr(f"conv_id - conv_id % {family}").alias("base"))
    heads = paths.where(f"conv_id % {family} = 0").select(
        F.col("conv_id").alias("base"), F.slice("path", 1, longest).alias("shared"))
    both = own.join(heads.hint("merge"), "base", "left")
    return both.select("conv_id", F.concat(
        F.expr(f"slice(coalesce(shared, cast(array() AS {_PATH})), 1, h)"), F.expr("slice(path, h + 1, size(path))")).alias("path"))


def _shared_depth(left: str, right: str) -> Column:
    """Number of first turns that two paths have in common."""
    differs = F.expr(f"array_position(transform(arrays_zip({left}, {right}), z -> z.{left} <=> z.{right}), false)")
    return F.when(differs == 0, F.size(left)).otherwise(differs - 1).cast("int")


def _skeleton_depths(shards: DataFrame) -> DataFrame:
    """shard, before, after: depths shared with the last path of the shard before and the first of the next; -1 at the ends."""
    path = F.struct("path", "conv_id")
    edges = shards.groupBy("shard").agg(F.min(path).alias("first"), F.max(path).alias("last"))
    order = Window.orderBy("shard")  # one row a shard
    edges = edges.select("shard", F.col("first.path").alias("first"), F.col("last.path").alias("last")).select(
        "*", F.lag("last").over(order).alias("left"), F.lead("first").over(order).alias("right"))

    def depth(one: str, other: str, neighbour: str) -> Column:
        return F.when(F.col(neighbour).isNull(), -1).otherwise(_shared_depth(one, other))

    return edges.select("shard", depth("left", "first", "left").alias("before"), depth("last", "right", "right").alias("after"))


class _Node:
    """An open node of the stack; what its closed children had is added to it."""

    __slots__ = ("bytes", "children", "continued", "ids", "leaves", "low", "n", "rows", "saved")

    def __init__(self, size: int, continued: bool):
        self.bytes, self.continued = size, continued
        self.n = self.children = self.leaves = self.saved = 0
        self.low = None
        self.ids, self.rows = [], []  # members that end here; rows of the result that are its children


class _Shard:
    """The nodes of one shard, from its paths in order."""

    def __init__(self, shard: int, before: int, after: int):
        self.shard, self.before, self.after = shard, before, after
        self.open: list[_Node] = []
        self.path: list[tuple[int, int, int]] = []
        self.first_keys: list[str] = []
        self.columns: dict[str, list] = {name: [] for name in _RESULT.names}

    def add(self, conv_id: int, path: list[tuple[int, int, int]]) -> None:
        if self.open:
            shared = 0
            for one, other in zip(self.path, path):
                if one != other:
                    break
                shared += 1
            self._close(shared)
            continued = -1
        else:
            continued = self.before
            self.first_keys = _keys(path[:max(continued, 0)])
        for depth in range(len(self.open), len(path) + 1):
            if depth > max(continued, 0):
                self.open[-1].children += 1
            self.open.append(_Node(path[depth - 1][2] if depth else 0, depth <= continued))
        end = self.open[-1]
        end.n += 1
        end.low = conv_id if end.low is None else min(end.low, conv_id)
        end.ids.append(conv_id)
        self.path = path

    def _close(self, shared: int) -> None:
        """Close the nodes of the last path that lie deeper than `shared`."""
        if shared < len(self.path):
            self.open[-1].leaves += 1
        while len(self.open) > shared + 1:
            depth = len(self.open) - 1
            self._emit(self.open.pop(), depth, self.first_keys)

    def finish(self) -> pa.RecordBatch:
        self._close(self.after)
        keys = _keys(self.path[:max(self.after, 0)])
        while self.open:
            depth = len(self.open) - 1
            node = self.open.pop()
            node_goes_on = depth <= self.after
            self._emit(node, depth, keys if node_goes_on else self.first_keys, node_goes_on)
        return pa.RecordBatch.from_pydict(self.columns, _RESULT)

    def _emit(self, node: _Node, depth: int, keys: list[str], goes_on: bool = False) -> None:
        partial = node.continued or goes_on
        node.saved += (node.n - (not node.continued)) * node.bytes
        for row in node.rows:
            if partial:
                self.columns["kind"][row], self.columns["parent_key"][row] = _UNDER_SKELETON, keys[depth]
            else:
                self.columns["parent_conv_id"][row] = node.low
        node.rows = []
        if self.open:
            parent = self.open[-1]
            parent.n += node.n
            parent.low = node.low if parent.low is None else min(parent.low, node.low)
            parent.leaves += node.leaves
            parent.saved += node.saved
            if not partial:
                parent.rows.append(len(self.columns["kind"]))
        own = {"kind": _PART if partial else _DONE, "shard": self.shard, "conv_id": node.low, "depth": depth, "n_convs": node.n,
               "n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved}
        if partial:
            self._row(own | {"key": keys[depth], "parent_key": keys[depth - 1] if depth else None})
            for block, start in enumerate(range(0, len(node.ids), IDS_A_BLOCK)):
                self._row({"kind": _ENDS, "key": keys[depth], "shard": self.shard, "block": block,
                           "ends": ",".join(map(str, node.ids[start:start + IDS_A_BLOCK]))})
        else:
            ends = hashlib.sha256(",".join(map(str, node.ids)).encode()).hexdigest() if node.ids else _NONE_ENDS
            self._row(own | {"ends": ends})

    def _row(self, values: dict) -> None:
        for name, column in self.columns.items():
            column.append(values.get(name))


def _keys(path: list[tuple[int, int, int]]) -> list[str]:
    """A digest for each prefix of a path, from the empty one on."""
    keys = [""]
    for a, b, _ in path:
        keys.append(hashlib.blake2b(f"{keys[-1]} {a} {b}".encode(), digest_size=16).hexdigest())
    return keys


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of shards whose paths come one after the other, each in order."""
    current = None
    for batch in batches:
        paths = batch.column("path")
        starts = paths.offsets.to_pylist()
        turns = list(zip(*(paths.values.field(name).to_pylist() for name in ("a", "b", "bytes")), strict=True))
        heads = zip(*(batch.column(c).to_pylist() for c in ("shard", "before", "after", "conv_id")), strict=True)
        for i, (shard, before, after, conv_id) in enumerate(heads):
            if current is None or current.shard != shard:
                if current is not None:
                    yield current.finish()
                current = _Shard(shard, before, after)
            current.add(conv_id, turns[starts[i]:starts[i + 1]])
    if current is not None:
        yield current.finish()


def _hashed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and SHA-256 of the blocks of each key, joined by commas; blocks of a key come one after the other, in order."""
    key, running = None, None
    for batch in batches:
        done: list[tuple[str, str]] = []
        for own, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if own != key:
                if running is not None:
                    done.append((key, running.hexdigest()))
                key, running = own, hashlib.sha256()
            else:
                running.update(b",")
            running.update(text.encode())
        yield pa.RecordBatch.from_pydict({"key": [k for k, _ in done], "ends": [e for _, e in done]}, _HASHED)
    if running is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "ends": [running.hexdigest()]}, _HASHED)


_HASHED = pa.schema([("key", pa.string()), ("ends", pa.string())])


def prefix_trie(paths: DataFrame, turns_a_shard: int = TURNS_A_SHARD) -> DataFrame:
    """A row for each distinct prefix of the paths; `paths` has one row for each conv_id.

    conv_id (the smallest member), depth, parent_conv_id (that of the parent, null for the
    root), n_convs, n_children, n_leaves (childless nodes of the subtree), saved_tokens (over
    the subtree, bytes of each node's last text for all members but one), ends_sha256 (of the
    ids that end here, in ascending order). An empty table has no nodes; equal paths are one
    node with several ends; an empty path ends in the root.
    """
    spark = paths.sparkSession
    turns = paths.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(turns / turns_a_shard))
    sorted_paths = paths.select("conv_id", "path").repartitionByRange(shards, "path", "conv_id")
    sharded = stage(sorted_paths.withColumn("shard", F.spark_partition_id()), "trie-shards")
    skeleton = stage(_skeleton_depths(sharded), "trie-skeleton")  # 12 bytes a shard
    work = sharded.join(F.broadcast(skeleton), "shard").repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    nodes = stage(work.mapInArrow(_shard_nodes, _RESULT_DDL), "trie-nodes")

    blocks = nodes.where(f"kind = {_ENDS}").select("key", "shard", "block", "ends")
    ends = blocks.repartition("key").sortWithinPartitions("key", "shard", "block").select("key", "ends").mapInArrow(
        _hashed_blocks, "key string, ends string")
    parts = nodes.where(f"kind = {_PART}").groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    parts = stage(parts.join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.lit(_NONE_ENDS))), "trie-skeleton-nodes")
    parents = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    shape = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    done = nodes.where(f"kind = {_DONE}").select(*shape)
    under = nodes.where(f"kind = {_UNDER_SKELETON}").drop("parent_conv_id")
    return (done.union(skew_join(under, parents, ["parent_key"]).select(*shape))
            .union(skew_join(parts, parents, ["parent_key"], "left").select(*shape)).toDF(*NODE))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations with shared heads; see `conversation_paths`, `with_shared_heads`, `prefix_trie`."""
    paths = stage(conversation_paths(conversations), "conversation-paths")
    return prefix_trie(stage(with_shared_heads(paths), "rebuilt-paths"))
