"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns; conversations that start with the same
turns share the nodes of those turns. A turn is written as 24 bytes, 16 of
its SHA-256 and 8 of its word count, so a path is bytes and its order is that
of bytes: the members of a node lie side by side.

Splitters (path, conversation) cut that order into shards. A node can have
members in several shards only if its path is a beginning of a splitter's
path: these nodes are the skeleton, a trie that is sent to every task. Each
shard is sorted and read once with a stack of open nodes; nodes off the
skeleton are finished there and then, for those on it the shard puts out
partial sums, which are added up by node and then along the skeleton from its
leaves. The skeleton has at most ``shards`` x ``SPLITTER_TURNS`` nodes, whatever
the table's size. Equal conversations are told apart by id, so a
conversation with very many copies is cut too; the ids that end at a
skeleton node come back as text pieces, which one task reads in order to
hash them (a hash of a sequence has no parallel form; its memory is one
piece).

Memory: a task holds the open nodes and, for those off the skeleton, the
figures of their finished children until the node's smallest member is
known: at most the nodes of one shard. A conversation is held as 24 bytes a
turn.

Defined results: rows without a conversation id belong to no conversation;
null role or text is empty; turns with equal numbers (null first) are
ordered by their SHA-256; an empty table gives no node, not even a root;
further columns do not matter.
"""
from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import stored, words

TURN = 24  # bytes of a turn in a path: 16 of its hash, 8 of its word count
SPLITTER_TURNS = 256  # a splitter's path is cut after so many turns
PER_SHARD = 32  # sampled conversations a splitter is chosen from
PIECE = 4096  # ids in a piece
LOWEST = -(1 << 63)

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
OUT = pa.schema([(c, pa.int64()) for c in ("skeleton", "under", "shard", "piece", "conv_id", "depth", "parent_conv_id",
                                           "n_convs", "n_children", "n_leaves", "saved_tokens")] + [("text", pa.string())])
OUT_DDL = ("skeleton long, under long, shard long, piece long, conv_id long, depth long, parent_conv_id long, "
           "n_convs long, n_children long, n_leaves long, saved_tokens long, text string")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): a conversation's turns in order, 48 hex digits each."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    size = F.lpad(F.hex(F.size(words(F.col("text"))).cast("long")), 16, "0")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), digest.alias("digest"), size.alias("size")).alias("t"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.concat(F.substring(t["digest"], 1, 32), t["size"])).alias("turns"))


def rebuilt(found: DataFrame, stride: int = 20) -> DataFrame:
    """Conversation c with its first h turns replaced by those of
    conversation c - c % stride; h is the CRC-32 of c's digits modulo 4."""
    found = stored(found, "trie-turns")
    base = found.filter(F.col("conv_id") % stride == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    joined = found.withColumn("base", F.col("conv_id") - F.col("conv_id") % stride).join(base, "base", "left")
    lead = F.slice(F.coalesce("first", F.array().cast("array<string>")), F.lit(1), h)
    own = F.slice("turns", h + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(lead, own).alias("turns"))


def paths(found: DataFrame) -> DataFrame:
    return found.select("conv_id", F.unhex(F.array_join("turns", "")).alias("path"))


def splitters(table: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards`` - 1 keys (path, conv_id) that cut the table into
    shards of about equal size, from a bounded sample. A path cut short
    stands before all that start with it."""
    n = table.count()
    share = math.ceil((1 << 30) * min(1.0, PER_SHARD * shards / max(n, 1)))
    sample = table.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < share).select(
        F.substring("path", 1, SPLITTER_TURNS * TURN).alias("path"), "conv_id")
    keys = sorted((bytes(r["path"]), r["conv_id"]) for r in sample.toLocalIterator())
    keys = [(p, LOWEST if len(p) == SPLITTER_TURNS * TURN else c) for p, c in keys]
    return sorted({keys[len(keys) * k // shards] for k in range(1, shards)}) if keys else []


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root, and a node
    comes after its parent."""

    def __init__(self, cuts: list[tuple[bytes, int]]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.words = [-1], [0], [0]
        for path, _ in cuts:
            at = 0
            for k in range(0, len(path), TURN):
                turn = path[k:k + TURN]
                if (at, turn) not in self.child:
                    self.child[at, turn] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                    self.words.append(int.from_bytes(turn[16:], "big"))
                at = self.child[at, turn]


class _Open:
    """A node whose members are being read."""

    __slots__ = ("skeleton", "words", "first", "n", "children", "leaves", "saved", "ends", "ids", "waiting")

    def __init__(self, skeleton: int, n_words: int):
        self.skeleton, self.words, self.first = skeleton, n_words, None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends, self.ids, self.waiting = None, [], []


def _finish(batches: Iterator[pa.RecordBatch], skeleton: Skeleton, ids: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Sorted (shard, path, conv_id) -> finished nodes and partial sums."""
    out: list[tuple] = []
    stack: list[_Open] = []
    path, shard, piece = b"", 0, 0

    def drained(force: bool = False) -> Iterator[pa.RecordBatch]:
        nonlocal out
        if out and (force or len(out) >= 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), OUT)], schema=OUT)
            out = []

    def put_ids(node: _Open) -> None:
        nonlocal piece
        if node.ids:
            out.append((node.skeleton, None, shard, piece, *[None] * 7, ",".join(node.ids)))
            piece, node.ids = piece + 1, []

    def close() -> None:
        node = stack.pop()
        depth = len(stack)
        if node.skeleton >= 0:
            put_ids(node)
            out.append((node.skeleton, None, shard, None, node.first, depth, None, node.n, node.children, node.leaves, node.saved, None))
            return
        above = stack[-1]
        node.leaves += not node.children
        node.saved += (node.n - 1) * node.words
        out.extend((*r[:6], node.first, *r[7:]) for r in node.waiting)
        ends = (node.ends or hashlib.sha256()).hexdigest()
        row = (-1, above.skeleton, None, None, node.first, depth, None, node.n, node.children, node.leaves, node.saved, ends)
        (out if above.skeleton >= 0 else above.waiting).append(row)
        above.first = node.first if above.first is None else min(above.first, node.first)
        above.n += node.n
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved

    for b in batches:
        for at, new, conv in zip(*(c.to_pylist() for c in b.columns)):
            if at != shard or not stack:
                while stack:
                    close()
                stack, path, shard, piece = [_Open(0, 0)], b"", at, 0
            same = 0
            while same < min(len(path), len(new)) and path[same:same + TURN] == new[same:same + TURN]:
                same += TURN
            while len(stack) > same // TURN + 1:
                close()
            for k in range(same, len(new), TURN):
                turn = new[k:k + TURN]
                above = stack[-1].skeleton
                stack.append(_Open(skeleton.child.get((above, turn), -1) if above >= 0 else -1, int.from_bytes(turn[16:], "big")))
            path, end = new, stack[-1]
            end.n += 1
            end.first = conv if end.first is None else min(end.first, conv)
            if end.skeleton >= 0:
                end.ids.append(str(conv))
                if len(end.ids) >= ids:
                    put_ids(end)
            elif end.ends is None:
                end.ends = hashlib.sha256(str(conv).encode())
            else:
                end.ends.update(f",{conv}".encode())
            yield from drained()
    while stack:
        close()
        yield from drained()
    yield from drained(True)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (skeleton, shard, piece) -> (skeleton, hash)."""
    now, h = None, None
    for b in batches:
        for node, text in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
            if node != now:
                if h is not None:
                    yield pa.RecordBatch.from_pydict({"skeleton": [now], "ends_sha256": [h.hexdigest()]})
                now, h = node, hashlib.sha256(text.encode())
            else:
                h.update(b"," + text.encode())
    if h is not None:
        yield pa.RecordBatch.from_pydict({"skeleton": [now], "ends_sha256": [h.hexdigest()]})


def _reduced(skeleton: Skeleton, sums: dict[int, tuple]) -> list[tuple]:
    """The skeleton's nodes (index, parent_conv_id and figures) from their
    shards' sums, added along the skeleton from its leaves."""
    size = len(skeleton.parent)
    first: list[int | None] = [None] * size
    n, children, leaves, saved = ([0] * size for _ in range(4))
    for k in range(size - 1, -1, -1):
        if k in sums:
            low, more, kids, leaf, words_ = sums[k]
            first[k] = low if first[k] is None else first[k] if low is None else min(first[k], low)
            n[k], children[k], leaves[k], saved[k] = n[k] + more, children[k] + kids, leaves[k] + leaf, saved[k] + words_
        if not n[k]:
            continue
        leaves[k] += not children[k]
        saved[k] += (n[k] - 1) * skeleton.words[k]
        up = skeleton.parent[k]
        if up >= 0:
            first[up] = first[k] if first[up] is None else min(first[up], first[k])
            n[up] += n[k]
            children[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
    return [(k, first[k], skeleton.depth[k], first[skeleton.parent[k]] if k else None, n[k], children[k], leaves[k], saved[k])
            for k in range(size) if n[k]]


def trie(table: DataFrame, shards: int | None = None, ids: int = PIECE) -> DataFrame:
    """The nodes of the trie of ``table`` (conv_id, path): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ``ids`` is the number of ids in a piece."""
    spark = table.sparkSession
    table = stored(table, "trie-paths")
    shards = int(shards or spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = splitters(table, shards)
    skeleton = Skeleton(cuts)
    sent = spark.sparkContext.broadcast((cuts, skeleton))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(b.column(1).to_pylist(), b.column(0).to_pylist())
            at = pa.array([bisect_right(sent.value[0], k) for k in keys], pa.int64())
            yield pa.RecordBatch.from_arrays([at, b.column(1), b.column(0)], ["shard", "path", "conv_id"])

    shard = table.select("conv_id", "path").mapInArrow(dealt, "shard long, path binary, conv_id long")
    shard = shard.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "path", "conv_id")
    found = stored(shard.mapInArrow(lambda it: _finish(it, sent.value[1], ids), OUT_DDL), "trie-nodes")
    sums = found.filter("skeleton >= 0 and piece is null").groupBy("skeleton").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"))
    top = spark.createDataFrame(
        _reduced(skeleton, {r[0]: tuple(r)[1:] for r in sums.toLocalIterator()}),
        "skeleton long, " + NODE.rpartition(",")[0])
    pieces = found.filter("piece is not null").select("skeleton", "shard", "piece", "text")
    ends = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece").mapInArrow(
        _hashed, "skeleton long, ends_sha256 string")
    own = top.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    nodes = found.filter("skeleton < 0").withColumnRenamed("text", "ends_sha256")
    above = top.select(F.col("skeleton").alias("under"), F.col("conv_id").alias("above"))
    nodes = nodes.join(F.broadcast(above), "under", "left").withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id"))
    columns = [c.split()[0] for c in NODE.split(", ")]
    return nodes.select(*columns).unionByName(own.select(*columns))
