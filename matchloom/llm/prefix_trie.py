"""Prefix trie of conversations by union-find over the common prefixes of sorted neighbours.

Conversations are sequences of turn hashes, sorted and cut into ranges. A range joins neighbours along their common prefix
lengths, longest first: every merge makes a branching node, and the turns between two merges are nodes with one child. What a
range cannot know alone are the nodes on the paths of its first and its last sequence, which other ranges may share. These
paths are contracted to sums; equal prefixes of all ranges are merged, and sums over their subtrees are differences of
running sums in the order in which prefixes first appear.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ranges
from . import common as C

TOKEN = 16
IDS = 50_000
HASHED = "c long, turn long, token binary, size int"
NODE = "kind string, cut int, conv_id long, depth int, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, key binary, side int, size int, ends array<binary>"
FIELDS = ("kind", "conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key", "side", "size", "ends")


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A turn as a 16-byte hash of its role and text, and the code points of its text."""
    for b in batches:
        roles, texts = ([x or "" for x in b[c].to_pylist()] for c in ("role", "text"))
        tokens = [hashlib.sha256(C.encoded(r) + b"\xff" + C.encoded(t)).digest()[:TOKEN] for r, t in zip(roles, texts, strict=True)]
        yield pa.record_batch([b["c"], b["turn"], pa.array(tokens, pa.binary()), pa.array([len(t) for t in texts], pa.int32())], ["c", "turn", "token", "size"])


def rebuilt(df: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """(c, at, token, size): conversation c begins with the first h turns of conversation c - c % every and goes on with its own
    after its first h; h is crc32(c) % most. Also (c, null, null, null) for each conversation."""
    turns = C.stored(df.where("c is not null").mapInArrow(hashed, HASHED))
    numbered = C.stored(ranges.running(turns, ["c"], F.struct("turn", "token", "size"), {"at": F.lit(1).cast("long")}).withColumn("at", F.col("at") - 1))
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(most))
    heads = numbered.where((F.col("c") % every == 0) & (F.col("at") < most - 1)).groupBy(F.col("c").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "token", "size"))).alias("first"))
    convs = numbered.select("c").distinct().join(heads, F.col("c") - F.col("c") % every == F.col("base"), "left")
    convs = convs.select("c", F.coalesce(F.filter("first", lambda t: t["at"] < h), F.array().cast("array<struct<at:bigint,token:binary,size:int>>")).alias("first"))
    begun = convs.select("c", F.explode("first").alias("t")).select("c", "t.*")
    size = convs.select(F.col("c").alias("k"), F.size("first").alias("n"))
    own = numbered.where(F.col("at") >= h).join(size, F.col("c") == F.col("k")).select("c", (F.col("at") - h + F.col("n")).alias("at"), "token", "size")
    empty = convs.select("c", F.lit(None).cast("long").alias("at"), F.lit(None).cast("binary").alias("token"), F.lit(None).cast("int").alias("size"))
    return begun.unionByName(own).unionByName(empty)


def sequences(turns: DataFrame) -> DataFrame:
    """(c, seq, sizes): the turns of a conversation as one run of hashes and their code points."""
    turn = F.struct("at", "token", "size")
    listed = turns.groupBy("c").agg(F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), turn))).alias("t"))
    return listed.select("c", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["token"])), "")).alias("seq"), F.transform("t", lambda x: x["size"]).alias("sizes"))


def common(a: bytes, b: bytes) -> int:
    """Turns of the common prefix."""
    n = min(len(a), len(b))
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(x.argmax()) if n and x.any() else n) // TOKEN


class Node:
    __slots__ = ("children", "convs", "depth", "ends", "first", "leaves", "low", "saved", "size")

    def __init__(self, depth: int, first: int, size: int):
        self.depth, self.first, self.size = depth, first, size
        self.children: list[Node] = []
        self.ends: list[int] = []
        self.convs, self.low, self.saved, self.leaves = 0, C.LAST, 0, 0

    def closed(self) -> Node:
        """With sums over its children and the conversations that end here."""
        self.convs = len(self.ends) + sum(c.convs for c in self.children)
        self.low = min([*self.ends[:1], *(c.low for c in self.children)])
        self.leaves = sum(c.leaves for c in self.children) or 1
        self.saved = (self.convs - 1) * self.size + sum(c.saved for c in self.children)
        return self


def forest(seqs: list[bytes], sizes: list[list[int]], ends: list[list[int]]) -> Node:
    """The root of the trie of distinct sorted sequences; `ends` are the ascending ids of each.

    Neighbours are joined by descending common prefix length. A component's top node rises to one turn below the merge, and
    the merge makes the node there, or adds to it, if an equally deep merge has made it."""
    n = len(seqs)
    lcp = np.array([common(a, b) for a, b in zip(seqs, seqs[1:])], np.int64)
    groups, tops = C.Groups(n), []
    for i in range(n):
        depth = len(seqs[i]) // TOKEN
        leaf = Node(depth, i, sizes[i][-1] if depth else 0)
        leaf.ends = ends[i]
        tops.append(leaf)

    def risen(node: Node, depth: int) -> Node:
        while node.depth > depth:
            up = Node(node.depth - 1, node.first, sizes[node.first][node.depth - 2] if node.depth > 1 else 0)
            up.children.append(node.closed())
            node = up
        return node

    for e in np.argsort(-lcp, kind="stable").tolist():
        left, right, d = groups.top(e), groups.top(e + 1), int(lcp[e])
        a, b = tops[left], tops[right]
        if a.depth > d:
            up = Node(d, a.first, sizes[a.first][d - 1] if d else 0)
            up.children.append(risen(a, d + 1).closed())
            a = up
        a.children.append(risen(b, d + 1).closed())  # the right one's top is deeper: it has no edge as short as this one yet
        groups.join(left, right)
        tops[groups.top(left)] = a
    return risen(tops[groups.top(0)], 0).closed()


def digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def prefix_keys(seq: bytes, depth: int) -> list[bytes]:
    """Key of the prefix of each length up to `depth`."""
    h = xxhash.xxh3_128()
    out = [h.digest()]
    for k in range(depth):
        h.update(seq[TOKEN * k : TOKEN * (k + 1)])
        out.append(h.digest())
    return out


def nodes_of(root: Node, seqs: list[bytes]) -> Iterator[tuple]:
    """Rows of a range: whole nodes, and as partial ones those on the paths of the first and the last sequence, which hold the
    sums over their whole children only. Whole children of partial nodes name the parent's key."""
    last = len(seqs) - 1
    keys = [prefix_keys(seqs[i], len(seqs[i]) // TOKEN) for i in (0, last)]
    stack: list[tuple[Node, int | None, bytes | None, int | None]] = [(root, None, None, 0)]
    while stack:
        node, parent, parent_key, side = stack.pop()
        if side is None:
            yield ("whole", node.low, node.depth, parent, parent_key, node.convs, len(node.children), node.leaves, node.saved, digest(node.ends), None, None, None, None)
            stack += [(c, node.low, None, None) for c in node.children]
            continue
        key = keys[side][node.depth]
        inner = []
        for c in node.children:
            on = 0 if c.first == 0 else 1 if seqs[last][: TOKEN * c.depth] == seqs[c.first][: TOKEN * c.depth] else None
            inner += [c] if on is None else []
            stack.append((c, None, key, on))
        blocks = [np.array(node.ends[k : k + IDS], "<i8").tobytes() for k in range(0, len(node.ends), IDS)]
        sides = (0, 1) if side == 0 and seqs[last][: TOKEN * node.depth] == seqs[0][: TOKEN * node.depth] else (side,)
        for s in sides:
            own = s == sides[0]
            yield ("part", node.low, node.depth, None, parent_key, node.convs if own else 0, len(inner) if own else 0, sum(c.leaves for c in inner) if own else 0,
                   sum(c.saved for c in inner) if own else 0, None, key, s, node.size, blocks if own else [])


def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each range; a partition's rows are sorted by range, sequence and id."""
    def written(cut: int, held: list) -> Iterator[pa.RecordBatch]:
        seqs, sizes, ends = map(list, zip(*held, strict=True))
        rows = []
        types = {"kind": pa.string(), "ends_sha256": pa.string(), "parent_key": pa.binary(), "key": pa.binary(), "depth": pa.int32(), "side": pa.int32(), "size": pa.int32(), "ends": pa.list_(pa.binary())}
        order = [x.split()[0] for x in NODE.split(", ")]

        def batch(rows: list) -> pa.RecordBatch:
            columns = dict(zip(FIELDS, zip(*rows, strict=True), strict=True)) | {"cut": [cut] * len(rows)}
            return pa.record_batch([pa.array(columns[c], pa.int32() if c == "cut" else types.get(c, pa.int64())) for c in order], order)

        for row in nodes_of(forest(seqs, sizes, ends), seqs):
            rows.append(row)
            if len(rows) == 10_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    held: list[tuple[bytes, list[int], list[int]]] = []
    at = None
    for b in batches:
        for cut, c, seq, sizes in zip(*(b[n].to_pylist() for n in ("_cut", "c", "seq", "sizes")), strict=True):
            if held and cut != at:
                yield from written(at, held)
                held = []
            at = cut
            if not held or held[-1][0] != seq:
                held.append((seq, sizes, []))
            held[-1][2].append(c)
    if held:
        yield from written(at, held)


def joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids in blocks, sorted by key and first id; one block is held at a time."""
    key, h, done = None, None, []
    for b in batches:
        for k, block in zip(b["key"].to_pylist(), b["block"].to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    done.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(",".join(map(str, np.frombuffer(block, "<i8").tolist())).encode())
        if done:
            yield pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["key", "ends_sha256"])
            done = []
    if key is not None:
        yield pa.record_batch([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends_sha256"])


def merged(parts: DataFrame) -> DataFrame:
    """Partial nodes of all ranges as whole ones: (key, conv_id, depth, parent_key, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    Ranges follow the order of the sequences, so prefixes in the order of their first appearance (range, side, depth) are a
    preorder, and what appears from a node to the end of its last path is its subtree."""
    place = F.struct("cut", "side", "depth")
    one = parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.first("size").alias("size"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.min(place).alias("begin"), F.max(F.struct("cut", "side")).alias("end"),
    )
    one = C.stored(one)
    below = one.where("parent_key is not null").groupBy(F.col("parent_key").alias("pk")).agg(F.count(F.lit(1)).alias("outer"))
    one = one.join(below, F.col("key") == F.col("pk"), "left").withColumn("outer", F.coalesce("outer", F.lit(0)))
    one = one.withColumn("leaf", F.when(F.col("inner") + F.col("outer") == 0, 1).otherwise(F.col("leaves"))).withColumn("own", (F.col("n_convs") - 1) * F.col("size") + F.col("saved"))
    summed = ranges.running(one, [], F.struct("begin", "key"), {"upto_leaf": F.col("leaf"), "upto_own": F.col("own")})
    summed = C.stored(summed)
    line = Window.orderBy("cut", "side").rowsBetween(Window.unboundedPreceding, 0)
    paths = parts.select("cut", "side").distinct().join(
        summed.groupBy(F.col("begin.cut").alias("c"), F.col("begin.side").alias("s")).agg(F.max("upto_leaf").alias("l"), F.max("upto_own").alias("o")), (F.col("cut") == F.col("c")) & (F.col("side") == F.col("s")), "left")
    paths = paths.select(F.struct("cut", "side").alias("path"), F.max("l").over(line).alias("path_leaf"), F.max("o").over(line).alias("path_own"))
    whole = summed.join(paths, F.col("end") == F.col("path"))
    blocks = parts.select("key", F.explode("ends").alias("block"), "cut", "side").select("key", "block", "cut", F.monotonically_increasing_id().alias("n"))
    hashes = blocks.repartition("key").sortWithinPartitions("key", "cut", "n").select("key", "block").mapInArrow(joined_digests, "key binary, ends_sha256 string")
    return whole.join(hashes.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left").select(
        "key", "conv_id", "depth", "parent_key", "n_convs", (F.col("inner") + F.col("outer")).alias("n_children"), (F.col("path_leaf") - F.col("upto_leaf") + F.col("leaf")).alias("n_leaves"),
        (F.col("path_own") - F.col("upto_own") + F.col("own")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(digest([]))).alias("ends_sha256"))


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", every: int = 100, most: int = 6) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations, the empty one included, with its sums.

    Turns are ordered by `turn`, null first; equal ones, and repeated rows, by the hash of role and text, each a turn of its
    own. Null roles and texts are empty. Rows without a conversation id belong to none and are left out. Extra columns are not
    read; an empty table gives no rows. One conversation's hashes and sizes (20 bytes a turn) must fit a task's memory; its
    turns are numbered, and conversations that are alike are counted, in many tasks."""
    named = df.select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    listed = C.stored(sequences(rebuilt(named, every, most)))
    rows, n = ranges.placed(listed.withColumn("_k", F.struct("seq", "c")))
    rows = rows.select("_cut", "c", "seq", "sizes")
    rows = rows.repartitionById(1, F.col("_cut")) if n == 1 else rows
    nodes = C.stored(rows.sortWithinPartitions("_cut", "seq", "c").mapInArrow(ranged, NODE))
    parts = nodes.where("kind = 'part'").drop("parent_conv_id", "ends_sha256")
    shared = C.stored(merged(parts))
    tops = parts.select("cut", "key").distinct().join(shared.select("key", F.col("conv_id").alias("top")), "key").select(F.col("cut").alias("tc"), F.col("key").alias("tk"), "top")
    whole = nodes.where("kind = 'whole'").join(tops, (F.col("cut") == F.col("tc")) & (F.col("parent_key") == F.col("tk")), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top"))
    up = shared.select(F.col("key").alias("pk"), F.col("conv_id").alias("parent_conv_id"))
    return whole.select(*RESULT).unionByName(shared.join(up, F.col("parent_key") == F.col("pk"), "left").select(*RESULT))
