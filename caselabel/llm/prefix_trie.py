"""Trie of conversation prefixes by sorted shards and a skeleton of splitter paths.

A node is a distinct sequence of first turns, the root the empty one.  A
conversation is a path of turn digests, 16 bytes of SHA-256 each, so comparing
two of them as binary values compares them turn by turn.

* **Shards.**  The paths are range-partitioned and sorted, with the id as the
  last key, so any number of equal conversations is cut like everything else.
  The members of a node are consecutive rows.
* **Skeleton.**  Only nodes whose members lie on both sides of a cut between
  shards can't be finished in one: these are the prefixes that the paths beside
  a splitter have in common.  Along the sorted rows, one depth for the cut before
  a shard and one for the cut after it say which of its nodes they are; this form
  of the splitters' trie, two numbers a shard, is broadcast.
* **Local nodes.**  One pass over a sorted shard keeps a stack of open nodes.  A
  node that closes hands its sums to its parent, and its row waits there until
  the parent's least member is known.
* **Skeleton nodes** give a partial of each shard they lie in, and their partials
  add up by key: what belongs to a node once, such as being a child, is counted
  in the shard in which it starts, and being childless in the one in which it
  ends.  As rows are sorted by id within a path, the lists of conversations that
  end at a skeleton node are consecutive; they are hashed as a stream of pieces.

A task holds the open nodes of one shard, the rows that wait there and the ids
that end at them, so memory is bounded by a shard; one conversation is held as 20
bytes a turn.  No group is collected, however many conversations share a prefix.

Rows without ``conv_id`` belong to no conversation and are left out.  Null turns
come first; turns of equal number are ordered by digest, repeated rows are turns
each.  Null role and text are empty.  An empty table has no node.  Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.llm.tables import hot_join, written

#: Conversations of so many consecutive ids share the head of the first of them.
FAMILY = 5
#: A head has fewer turns than this.
HEADS = 9

_BYTES = 16
_PIECE = 400
_ROWS = 4096
_NO_ENDS = hashlib.sha256().hexdigest()
#: Rows that a shard gives: nodes with their parent, nodes below the skeleton, partials of it, pieces of its ends.
_NODE, _BELOW, _PARTIAL, _ENDS = range(4)
_STATS = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("parent_conv_id", pa.int64())]
    + [(c, pa.int64()) for c in _STATS]
    + [("ends", pa.string()), ("shard", pa.int64()), ("piece", pa.int64()), ("local", pa.int64())]
)
_DDL = ", ".join(f"{f.name} {({'int32': 'int', 'int64': 'long'}).get(str(f.type), str(f.type))}" for f in _SCHEMA)


def turn_digest(role: Column, text: Column) -> Column:
    """The first 16 bytes of the SHA-256 of a turn; the length of the role keeps it apart from the text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * _BYTES))


def paths(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """``(conv_id, path, sizes)`` of every rebuilt conversation: turn digests in a row and the bytes of each turn's text.

    A conversation starts with the first turns of its family's first one and goes
    on with its own; both meet in one shuffle of digests.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", turn_digest(role, text).alias("digest"), F.octet_length(text).alias("size"))
    base = F.col("conv_id") - F.col("conv_id") % family
    turns = conversations.where("conv_id IS NOT NULL").select(base.alias("base"), "conv_id", turn.alias("t"))
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, heads - 1))).over(W.partitionBy("base"))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    told = own.select("conv_id", "own", first.alias("first"), head.alias("head"))
    whole = F.concat(
        F.slice(F.coalesce("first", F.slice("own", 1, 0)), F.lit(1), F.col("head")),
        F.slice("own", F.col("head") + 1, F.greatest(F.size("own") - F.col("head"), F.lit(0))),
    )
    told = told.select("conv_id", whole.alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    return told.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def shared(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths have in common."""
    if a == b:
        return len(a) // _BYTES
    n = min(len(a), len(b)) // _BYTES
    low = 0
    while low < n:  # the longest common prefix by halving: slices are compared as a whole
        mid = (low + n + 1) // 2
        if a[: mid * _BYTES] == b[: mid * _BYTES]:
            low = mid
        else:
            n = mid - 1
    return low


def _prefix_keys(path: bytes, depth: int) -> list[bytes]:
    """Names of the prefixes of 0 to ``depth`` turns."""
    state, keys = hashlib.sha256(), []
    for d in range(depth + 1):
        if d:
            state.update(path[(d - 1) * _BYTES : d * _BYTES])
        keys.append(state.copy().digest()[:_BYTES] + d.to_bytes(8, "big"))
    return keys


class _Open:
    """A node on the path of the row being read."""

    __slots__ = ("depth", "size", "starts", "key", "first", "n", "children", "leaves", "saved", "ends", "waiting", "childless")

    def __init__(self, depth: int, size: int, starts: int, key: bytes | None):
        self.depth, self.size, self.starts, self.key = depth, size, starts, key
        self.first = self.ends = None
        self.childless = True  # in this shard; children that began in an earlier one count too
        self.n = self.children = self.leaves = self.saved = 0
        self.waiting: list[tuple] = []


class _Shard:
    """The pass over one sorted shard; ``out`` collects its rows."""

    def __init__(self, shard: int, before: int, after: int, out: list[tuple]):
        self.shard, self.before, self.after, self.out = shard, before, after, out
        self.stack: list[_Open] = []
        self.path: bytes | None = None

    def row(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        depth = len(path) // _BYTES
        if self.path is None:
            keys = _prefix_keys(path, self.before)
            self.stack = [_Open(d, sizes[d - 1] if d else 0, int(d > self.before), keys[d] if d <= self.before else None) for d in range(depth + 1)]
        else:
            common = shared(self.path, path)
            while len(self.stack) - 1 > common:
                self._close(True)
            self.stack += [_Open(d, sizes[d - 1], 1, None) for d in range(common + 1, depth + 1)]
        self.path = path
        end = self.stack[-1]
        end.n += 1
        end.first = conv_id if end.first is None else min(end.first, conv_id)
        if end.ends is None:
            end.ends = []
        end.ends.append(conv_id)

    def finish(self) -> None:
        if self.path is None:
            return
        for node, key in zip(self.stack, _prefix_keys(self.path, self.after), strict=False):
            node.key = key
        while self.stack:
            self._close(self.stack[-1].depth > self.after)

    def _close(self, closes: bool) -> None:
        """Take the deepest open node away; ``closes`` unless it goes on in the next shard."""
        node = self.stack.pop()
        parent = self.stack[-1] if self.stack else None
        if closes and node.childless:
            node.leaves += 1
        node.saved += (node.n - node.starts) * node.size
        stats = (node.first, node.n, node.children, node.leaves, node.saved)
        if node.key is None:
            self.out += [(_NODE, None, None, d, node.first, *s, e, None, None, None) for d, s, e in node.waiting]
            ends = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest() if node.ends else _NO_ENDS
            if parent:
                parent.waiting.append((node.depth, stats, ends))
            else:
                self.out.append((_NODE, None, None, node.depth, None, *stats, ends, None, None, None))
        else:
            # The parent of a skeleton node is one as well.
            self.out += [(_BELOW, None, node.key, d, None, *s, e, None, None, None) for d, s, e in node.waiting]
            self.out.append((_PARTIAL, node.key, parent.key if parent else None, node.depth, None, *stats, None, None, None, len(node.waiting)))
            for i in range(0, len(node.ends or []), _PIECE):
                piece = ",".join(map(str, node.ends[i : i + _PIECE]))
                self.out.append((_ENDS, node.key, None, node.depth, None, *(None,) * len(_STATS), piece, self.shard, i, None))
        if parent:
            parent.first = node.first if parent.first is None else min(parent.first, node.first)
            parent.n += node.n
            parent.childless = False
            parent.children += node.starts
            parent.leaves += node.leaves
            parent.saved += node.saved


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, partials and pieces of shards whose rows come one shard after the other, sorted."""
    out: list[tuple] = []
    now: _Shard | None = None
    for batch in batches:
        for shard, before, after, path, sizes, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.shard != shard:
                if now:
                    now.finish()
                now = _Shard(shard, before, after, out)
            now.row(conv_id, path, sizes)
            while len(out) >= _ROWS:
                yield _batch(out[:_ROWS])
                del out[:_ROWS]
    if now:
        now.finish()
    for i in range(0, len(out), _ROWS):
        yield _batch(out[i : i + _ROWS])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces joined by commas; they come sorted by key, shard and piece."""
    key, state, found = None, None, []
    for batch in batches:
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k == key:
                state.update(b"," + piece.encode())
                continue
            if state:
                found.append((key, state.hexdigest()))
            key, state = k, hashlib.sha256(piece.encode())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["key", "ends_sha256"])
            found = []
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])


def _shared_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([-1 if x is None or y is None else shared(bytes(x), bytes(y)) for x, y in zip(a, b, strict=True)])


def cuts(ranged: DataFrame) -> DataFrame:
    """``(shard, before, after)``: how many first turns the paths on both sides of a shard's cuts share; -1 where there is none."""
    ends = ranged.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    order = W.orderBy("shard")  # one row per shard
    common = F.pandas_udf(_shared_series, "int")
    beside = ends.select("shard", "low", F.lag("high").over(order).alias("high")).select("shard", common("high", "low").alias("before"))
    return beside.select("shard", "before", F.coalesce(F.lead("before").over(order), F.lit(-1)).alias("after"))


def trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per node: ``conv_id`` (its least member), ``depth``, ``parent_conv_id`` and the node's and its subtree's sums."""
    ranged = paths(conversations, family, heads).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    ranged = written(ranged.withColumn("shard", F.spark_partition_id().cast("long")), "trie-shards")
    skeleton_depths = F.broadcast(written(cuts(ranged), "trie-cuts"))  # two numbers per range partition
    sorted_rows = ranged.join(skeleton_depths, "shard").select("shard", "before", "after", "path", "sizes", "conv_id")
    sorted_rows = sorted_rows.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    found = written(sorted_rows.mapInArrow(_walk, _DDL), "trie-nodes")

    columns = ["conv_id", "depth", "parent_conv_id", *_STATS[1:], F.col("ends").alias("ends_sha256")]
    local = found.where(F.col("kind") == _NODE).select(*columns)

    pieces = found.where(F.col("kind") == _ENDS).select("key", "ends", "shard", "piece")
    pieces = pieces.repartition("key").sortWithinPartitions("key", "shard", "piece").select("key", "ends")
    ends = pieces.mapInArrow(_hash_pieces, "key binary, ends_sha256 string")
    whole = found.where(F.col("kind") == _PARTIAL).groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in (*_STATS[1:], "local")]
    )
    whole = whole.join(ends, "key", "left").withColumn("ends", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    whole = written(whole.drop("ends_sha256"), "trie-skeleton")

    total = whole.agg(F.coalesce(F.sum("local"), F.lit(0))).first()[0]
    parents = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"), "local")
    below = found.where(F.col("kind") == _BELOW).drop("parent_conv_id", "local")
    below = hot_join(below, parents, ["parent_key"], "local", total).withColumnRenamed("_parent", "parent_conv_id").select(*columns)
    skeleton = whole.join(parents.drop("local"), "parent_key", "left").withColumnRenamed("_parent", "parent_conv_id").select(*columns)
    return local.unionByName(below).unionByName(skeleton)
