"""The prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns. Paths are dealt into shards by range and
sorted there, so the members of every node are neighbours. A node that spans two
shards is a common prefix of the last path of one and the first path of the next:
these nodes are the skeleton, the trie of the paths at which the ranges are
split. It is broadcast as two depths per shard, how much of its first path its
last one shares and how much of its last path the next shard's first one does,
which say which of a shard's nodes are in the skeleton and name each by the first
boundary it spans.

A shard is read once with a stack of the open nodes. Nodes outside the skeleton
are finished there. Of skeleton nodes each shard gives partial aggregates that
add up: a node's own saving, its place among its parent's children and its being
a leaf are each counted by one of its shards, the first, the first and the last.

Defined results: rows without a conversation id belong to none and are left out;
a null turn comes first, turns of one number go by their digest, and repeated
rows are turns of their own; null role or text is empty; a remainder has the sign
of its dividend; other columns are not read; an empty table has no node. Turns
are told apart by 128 bits of SHA-256. A conversation's digests, 24 bytes a turn,
are one row, and a task holds the nodes of one shard that wait for their parent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta.llm.common import SMALL_ROWS, materialize, table

GROUP = 20  # conversations that share the beginning of the first of them
HOST_TURNS = 4  # the first 0 to 3 turns are shared
STEP = 24  # bytes of a turn: 16 of its digest, 8 of its number of words
BATCH = 10_000
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NODE_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long, ends_sha256 string")
SHARD_SCHEMA = f"{NODE_SCHEMA}, owner int, parent_owner int, shard int, ids binary"


def turn_key(role: Column, text: Column) -> Column:
    """48 hexadecimal digits that stand for a turn: its digest and the number of words of its text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.concat(F.substring(told, 1, 32), F.lpad(F.hex(words.cast("long")), 16, "0"))


def conversation_paths(turns: DataFrame) -> DataFrame:
    """``(conv_id, keys)``: the turn keys of each conversation in order."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), turn_key(F.col("role"), F.col("text")).alias("key")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["key"].alias("keys"))


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """``conversation_paths`` with the first h turns replaced by those of the first conversation of the group.

    h is the CRC-32 of the id modulo HOST_TURNS. A host's few first turns meet at most GROUP conversations.
    """
    paths = materialize(conversation_paths(turns), "conversation-paths")
    h = (F.crc32(F.col("conv_id").cast("string")) % HOST_TURNS).cast("int")
    hosts = paths.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("host"), F.slice("keys", 1, HOST_TURNS - 1).alias("first"))
    joined = paths.withColumn("host", F.col("conv_id") - F.col("conv_id") % GROUP).join(hosts, "host", "left")
    begun = F.slice(F.coalesce("first", F.array().cast("array<string>")), F.lit(1), h)
    own = F.slice("keys", h + 1, F.greatest(F.size("keys") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(begun, own).alias("keys"))


class _Node:
    """A node that is open in a shard. ``kids`` counts the children met here, ``children`` those that begin here."""

    __slots__ = ("children", "conv", "convs", "ends", "first", "kids", "leaves", "saved", "waiting", "words")

    def __init__(self, words: int, first: bool):
        self.words, self.first = words, first
        self.conv: int | None = None
        self.convs = self.children = self.kids = self.leaves = self.saved = 0
        self.ends = bytearray()
        self.waiting: list[list] = []


def _common(a: bytes, b: bytes) -> int:
    """The number of turns that two paths begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // STEP
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // STEP


class Shard:
    """One pass over the sorted paths of a shard; rows for SHARD_SCHEMA gather in ``out``.

    ``within[i]`` is the common depth of the first and last path of shard i,
    ``across[i]`` that of its last and the next shard's first one.
    """

    def __init__(self, shard: int, within: list[int], across: list[int]):
        self.shard = shard
        self.left = across[shard - 1] if shard else -1
        self.right = across[shard] if shard < len(across) else -1
        self.owners = [0] * (self.left + 1)  # of the skeleton nodes on the first path
        b = shard - 1
        for depth in range(self.left, -1, -1):
            while b and across[b - 1] >= depth and within[b] >= depth:
                b -= 1
            self.owners[depth] = b
        self.out: list[list] = []
        self.previous: bytes | None = None
        self.stack: list[_Node] = []

    def add(self, path: bytes, conv: int) -> None:
        first = self.previous is None
        if first:
            self.stack.append(_Node(0, True))
        common = 0 if first else _common(self.previous, path)
        while len(self.stack) - 1 > common:
            self._close(False)
        for at in range(common * STEP, len(path), STEP):
            self.stack.append(_Node(int.from_bytes(path[at + 16:at + STEP], "big"), first))
        node = self.stack[-1]
        node.conv = conv if node.conv is None else min(node.conv, conv)
        node.convs += 1
        node.ends += b",%d" % conv if node.ends else b"%d" % conv
        self.previous = path

    def end(self) -> None:
        while self.stack:
            self._close(True)

    def _owner(self, node: _Node, depth: int) -> int:
        return self.owners[depth] if node.first and depth <= self.left else self.shard

    def _close(self, at_end: bool) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        begins = not (node.first and depth <= self.left)
        ends = not (at_end and depth <= self.right)
        node.saved += (node.convs - begins) * node.words
        node.leaves += ends and not node.kids
        parent = self.stack[-1] if self.stack else None
        if parent:
            parent.conv = node.conv if parent.conv is None else min(parent.conv, node.conv)
            parent.convs += node.convs
            parent.leaves += node.leaves
            parent.saved += node.saved
            parent.kids += 1
            parent.children += begins
        row = [node.conv, depth, None, node.convs, node.children, node.leaves, node.saved, None, None, None, None, None]
        if begins and ends:
            row[7] = hashlib.sha256(node.ends).hexdigest()
            (parent.waiting if parent else self.out).append(row)
            for child in node.waiting:
                child[2] = node.conv
        else:
            owner = self._owner(node, depth)
            row[8], row[10], row[11] = owner, self.shard, bytes(node.ends)
            row[9] = self._owner(parent, depth - 1) if parent else None
            self.out.append(row)
            for child in node.waiting:
                child[9] = owner
        self.out += node.waiting


def _shard_rows(batches: Iterator[pa.RecordBatch], within: list[int], across: list[int]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 7 + [pa.string()] + [pa.int32()] * 3 + [pa.binary()]
    names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]

    def made(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    now: Shard | None = None
    for batch in batches:
        for shard, path, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.shard != shard:
                if now:
                    now.end()
                    yield made(now.out)
                now = Shard(shard, within, across)
            now.add(path, conv)
            if len(now.out) >= BATCH:
                yield made(now.out)
                now.out = []
    if now:
        now.end()
        yield made(now.out)


def _skeleton(shards: DataFrame) -> tuple[DataFrame, list[int], list[int]]:
    """``(place of each shard that has rows, within, across)``; the paths themselves stay in the executors."""
    from pyspark.sql import Window

    # Two paths and, collected, two numbers per shard.
    edges = shards.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    edges = edges.select("part", F.row_number().over(order).alias("place"), "first", "last", F.lead("first").over(order).alias("next"))

    def depths(batches):
        for batch in batches:
            part, place, first, last, next_ = (c.to_pylist() for c in batch.columns)
            across = [-1 if n is None else _common(x, n) for x, n in zip(last, next_)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array([p - 1 for p in place], pa.int32()),
                 pa.array(map(_common, first, last), pa.int32()), pa.array(across, pa.int32())],
                names=["part", "shard", "within", "across"])

    found = materialize(edges.mapInArrow(depths, "part int, shard int, within int, across int"), "trie-skeleton")
    rows = sorted(found.select("shard", "within", "across").collect())
    return found.select("part", "shard"), [r["within"] for r in rows], [r["across"] for r in rows[:-1]]


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``(owner, depth, ends_sha256)`` of lists of ids that go on from shard to shard; a digest streams over its lists."""

    def run(batches):
        key, digest, any_ = None, None, False
        for batch in batches:
            rows = []
            for owner, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (owner, depth):
                    if key is not None:
                        rows.append((*key, digest.hexdigest()))
                    key, digest, any_ = (owner, depth), hashlib.sha256(), False
                if ids:
                    digest.update(b"," + ids if any_ else ids)
                    any_ = True
            yield _digest_rows(rows)
        if key is not None:
            yield _digest_rows([(*key, digest.hexdigest())])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ends.select("owner", "depth", "shard", "ids").repartition(parts, "owner", "depth")
    return dealt.sortWithinPartitions("owner", "depth", "shard").mapInArrow(run, "owner int, depth long, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    owner, depth, digest = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(owner, pa.int32()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())],
                                      names=["owner", "depth", "ends_sha256"])


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row (NODE) for each distinct beginning of the paths ``(conv_id, keys)``, the empty one included."""
    spark = paths.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = paths.select("conv_id", F.unhex(F.array_join("keys", "")).alias("path"))
    # Written, as a second run of the sampling could split the ranges elsewhere.
    ranged = materialize(rows.repartitionByRange(parts, "path", "conv_id").withColumn("part", F.spark_partition_id()), "trie-ranges")
    places, within, across = _skeleton(ranged)
    # One row per shard.
    placed = ranged.join(F.broadcast(places), "part").select("shard", "path", "conv_id")
    sorted_ = placed.repartition(parts, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = materialize(sorted_.mapInArrow(lambda batches: _shard_rows(batches, within, across), SHARD_SCHEMA), "trie-nodes")
    finished = found.filter("owner is null")
    partial = found.filter("owner is not null")
    skeleton = partial.groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_owner").alias("parent_owner"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    skeleton = materialize(skeleton.join(_ends_digests(partial), ["owner", "depth"]), "trie-skeleton-nodes")
    above = skeleton.select(F.col("owner").alias("parent_owner"), F.col("depth").alias("above"), F.col("conv_id").alias("found"))
    if skeleton.count() <= SMALL_ROWS:
        above = F.broadcast(above)
    below = finished.filter("parent_owner is not null").select(*NODE, "parent_owner").unionByName(
        skeleton.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*NODE, "parent_owner"))
    below = below.withColumn("above", F.col("depth") - 1).join(above, ["parent_owner", "above"], "left")
    return finished.filter("parent_owner is null").select(*NODE).unionByName(
        below.withColumn("parent_conv_id", F.col("found")).select(*NODE))


def op11_splitter_skeleton_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of the first of its group."""
    return prefix_trie(rebuilt_paths(table(spark, sf_dir, "conversations")))
