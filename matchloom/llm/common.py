"""Helpers shared by the operators: words, hashes over whole texts, text shards, packed exchanges between shards, components.

A *shard* is a group of documents of about equal size, dealt out by a hash. Operators that ask "does this piece of text
occur elsewhere?" let every shard send the hashes of its pieces to hash buckets and get back those that recur. Each side
holds one shard or one bucket at a time, so memory is bounded by the shard size, and a piece that occurs in every document
is one entry for each shard.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SHARD_BYTES = 1 << 20
LARGE_SHARD_BYTES = 64 << 20
MANY_SHARDS = 4096
LAST = (1 << 63) - 1
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Written once to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def encoded(text) -> bytes:
    """UTF-8 bytes; null is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def words(text) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and carriage return."""
    return encoded(text).split()


class WordHash(dict):
    """64-bit hash of each word; forgets when it grows beyond `most` words."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(30))) * C2
    a = (a ^ (a >> np.uint64(27))) * C3
    return a ^ (a >> np.uint64(31))


def gram_hash(x: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of n elements, by doubling; shorter input gives an empty array."""
    if len(x) < n:
        return np.zeros(0, np.uint64)
    size, h = 1, x if seed == 0 else mix(x + np.uint64(seed * int(C1) % (1 << 64)))
    while size * 2 <= n:
        h = mix(h[:-size] * C1 + (h[size:] ^ C3)) if size < len(h) else h
        size *= 2
    if size < n:
        gap = n - size
        h = mix(h[: len(h) - gap] * C1 + (h[gap:] ^ C3) + np.uint64(gap))
    return h


def sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every run of n elements."""
    size, m = 1, x
    while size * 2 <= n:
        m = pick(m[:-size], m[size:])
        size *= 2
    if size < n:
        gap = n - size
        m = pick(m[: len(m) - gap], m[gap:])
    return m


def anchors(grams: np.ndarray, per_window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of so many grams its smallest hash, and which grams are the smallest of some window.

    Two equal windows have the same smallest hash, wherever they stand."""
    if len(grams) < per_window:
        return np.zeros(0, np.uint64), np.zeros(len(grams), bool)
    low = sliding(grams, per_window, np.minimum)
    pad = np.zeros(per_window - 1, np.uint64)
    high = sliding(np.concatenate([pad, low, pad]), per_window, np.maximum)
    return low, grams == high


def shard_count(total_bytes: int) -> int:
    """Shards of a megabyte up to some thousands, then more of them and larger ones up to 64 MB."""
    return max(1, min(-(-total_bytes // SHARD_BYTES), MANY_SHARDS), -(-total_bytes // LARGE_SHARD_BYTES))


def total_bytes(df: DataFrame, text: str) -> int:
    return int(df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0)


def sharded(df: DataFrame, id_col: str, text: str, carry: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(shard, id, text) rows, and carried columns as carry_0, carry_1 ...; and the number of shards."""
    n = shard_count(total_bytes(df, text))
    return df.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text)), F.lit(n)).cast("int").alias("shard"), F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *[F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)],
    ), n


def bucket_count(n_shards: int) -> int:
    return max(16, n_shards // 4)


def bucket_slices(h: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, positions) for hashes dealt to n buckets."""
    if not len(h):
        return []
    b = (h >> np.uint64(32)).astype(np.int64) % n
    order = np.argsort(b, kind="stable")
    at, first = np.unique(b[order], return_index=True)
    return list(zip(at.tolist(), np.split(order, first[1:]), strict=True))


def packed(shard: int, rows: np.ndarray, key: np.ndarray, n: int, kind: int = 0) -> pd.DataFrame:
    """One row for each bucket with the rows that belong there, as bytes."""
    parts = bucket_slices(key, n)
    return pd.DataFrame({"bucket": np.array([b for b, _ in parts], np.int32), "shard": np.full(len(parts), shard, np.int32), "kind": np.full(len(parts), kind, np.int32), "data": [rows[i].tobytes() for _, i in parts]})


PACKED = "bucket int, shard int, kind int, data binary"
REPLY = "shard int, kind int, data binary"


def unpacked(pdf: pd.DataFrame, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All rows of a group, and the shard of each."""
    arrays = [np.frombuffer(x, dtype) for x in pdf["data"]]
    if not arrays:
        return np.zeros(0, dtype), np.zeros(0, np.int32)
    return np.concatenate(arrays), np.repeat(pdf["shard"].to_numpy(np.int32), [len(a) for a in arrays])


def reply(rows: np.ndarray, shard: np.ndarray, kind: int = 0) -> pd.DataFrame:
    """One row for each shard with what it gets back."""
    order = np.argsort(shard, kind="stable")
    at, first = np.unique(shard[order], return_index=True)
    parts = np.split(order, first[1:]) if len(at) else []
    return pd.DataFrame({"shard": at.astype(np.int32), "kind": np.full(len(at), kind, np.int32), "data": [rows[i].tobytes() for i in parts]})


COUNTED = np.dtype([("h", "<u8"), ("n", "<u4")])


def recurring_anchors(pairs: DataFrame, hot: int) -> DataFrame:
    """From packed (hash, count) rows those that occur twice or more, back to every shard that has them; n is 1, or 2 if
    the hash occurs more than `hot` times."""
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, shard = unpacked(pdf, COUNTED)
        _, at, inverse = np.unique(rows["h"], return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=rows["n"], minlength=len(at))[inverse]
        keep = total >= 2
        out = np.zeros(int(keep.sum()), COUNTED)
        out["h"], out["n"] = rows["h"][keep], 1 + (total[keep] > hot)
        return reply(out, shard[keep])

    return pairs.groupBy("bucket").applyInPandas(meet, REPLY)


def counted(h: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    values, n = np.unique(h, return_counts=True)
    out = np.zeros(len(values), COUNTED)
    out["h"], out["n"] = values, n
    return out


def member(x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which x are among sorted values."""
    if not len(values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    return values[at] == x


def joined_runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    d = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return d[::2], d[1::2]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Positions within `length` of a flagged start."""
    d = np.zeros(n + 1, np.int32)
    s, e = joined_runs(starts)
    np.add.at(d, s, 1)
    np.add.at(d, e - 1 + length, -1)
    return np.cumsum(d[:n]) > 0


class Groups:
    """Union-find over positions, for one task's bounded block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def components(edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest reachable node, for every node of the (a, b) edges.

    Until every node has one parent, rounds of two steps: every edge moves its smaller end to that end's smallest neighbour,
    then a node hands its other smaller neighbours to its smallest one. After that, parents are followed by pointer jumping.
    The number of rounds has no bound set here (it grows like the logarithm of a path's length). A node is keyed by its own
    row, and has as many rows as smaller neighbours, so a popular parent is no hot key of an aggregation; the joins' both
    sides come from stored tables, which lets AQE split popular parents. Null or self edges are ignored."""
    def state(df):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"), F.count_distinct("u").alias("u")).first()
        return row["n"], row["h"], row["u"]

    def jumped(df, parents):
        return df.join(parents.select(F.col("u").alias("pu"), F.col("v").alias("pv")), F.col("v") == F.col("pu"), "left").select("u", F.coalesce("pv", "v").alias("v"))

    e = stored(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    n, h, u = state(e)
    while n != u:
        g = jumped(e, stored(e.groupBy("u").agg(F.min("v").alias("v")))).groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("vs"))
        e = stored(g.select(F.explode(F.concat(F.array(F.struct(F.col("u"), F.col("m").alias("v"))), F.expr("transform(filter(vs, x -> x <> m), x -> struct(x as u, m as v))"))).alias("s")).select("s.u", "s.v").distinct())
        before, (n, h, u) = h, state(e)
        if h == before and n != u:
            raise RuntimeError(f"components: {n} edges of {u} nodes no longer change, but some nodes have several parents")
    before = None
    while n and h != before:
        e = stored(jumped(e, e))
        before, (n, h, u) = h, state(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
