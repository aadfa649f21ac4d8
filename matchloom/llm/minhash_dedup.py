"""Near-duplicate documents by a multi-index Hamming join of b-bit minhash signatures.

A signature has `SLOTS` slots of 16 bits. Documents of similarity s agree in a slot with probability s at least; at the share
asked for fewer than one pair in a million differs in more than `far` slots (41 at 0.85, 49 at 0.80). The slots are split into
chunks. If two signatures differ in at most far slots, pigeonhole leaves a chunk with at most one difference (chunks * 2 > far), and leaving
out each of its slots in turn enumerates that error: some shortened chunk is equal. So every pair within the signature
distance shares a key. Keys that several documents share join them to candidate groups; groups meet in blocks of bounded
size, where pairs within the distance are verified on full shingle sets and only links that join something new are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SHINGLE, SLOTS, MISSED = 5, 128, 1e-6
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 4_000_000
SALTS = np.random.default_rng(11).integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, seen: C.WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words are one shingle, none give none."""
    ws = C.encoded(text).translate(UPPER).split()
    if not ws:
        return np.zeros(0, np.uint64)
    return np.unique(C.gram_hash(seen.of(ws), min(SHINGLE, len(ws))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of the smallest of every slot's hashes."""
    low = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        low = np.minimum(low, (shingles[at : at + 1024, None] * SALTS).min(0))
    return (C.mix(low) & np.uint64(0xFFFF)).astype("<u2")


def reach(share: int) -> tuple[int, int]:
    """(far, chunks): the smallest distance that a pair of similarity share / 100 exceeds with probability below MISSED, and the
    fewest chunks one of which has at most one of so many differences."""
    p, tail, far = share / 100, 0.0, SLOTS
    while tail + (t := math.comb(SLOTS, far) * (1 - p) ** far * p ** (SLOTS - far)) < MISSED:
        tail, far = tail + t, far - 1
    return far, far // 2 + 1


def keys(signatures: np.ndarray, chunks: int) -> np.ndarray:
    """For each signature the hashes of its chunks with each slot left out in turn."""
    out = []
    s = signatures.astype(np.uint64)
    edges = np.linspace(0, SLOTS, chunks + 1).astype(int)
    for c in range(chunks):
        slots = range(edges[c], edges[c + 1])
        for gone in slots:
            h = np.full(len(s), (c * 64 + gone - edges[c]) * 2654435761 + 1, np.uint64)
            for k in slots:
                if k != gone:
                    h = C.mix(h * C.C1 + s[:, k])
            out.append(h)
    return np.stack(out, 1)


def sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, a, b, sig): set size, 128-bit identity of the set, signature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = C.WordHash()
        for pdf in batches:
            out = []
            for i, text in zip(pdf["id"], pdf["text"], strict=True):
                x = shingle_set(text, seen)
                a = int(np.bitwise_xor.reduce(C.mix(x)).astype(np.int64)) if len(x) else 0
                b = int((C.mix(x ^ C.C3).sum(dtype=np.uint64)).astype(np.int64)) if len(x) else 0
                out.append((None if pd.isna(i) else int(i), len(x), a, b, signature(x).tobytes() if len(x) else b""))
            yield pd.DataFrame(out, columns=["id", "n", "a", "b", "sig"]).astype({"id": "Int64"})

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(run, "id long, n long, a long, b long, sig binary")


KEYED = np.dtype([("h", "<u8"), ("id", "<i8")])


def candidate_links(reps: DataFrame, n_buckets: int, chunks: int) -> DataFrame:
    """(a, b) rows that join all documents of a key to the first of them."""
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 5000):
                p = pdf.iloc[at : at + 5000]
                k = keys(np.frombuffer(b"".join(p["sig"]), "<u2").reshape(-1, SLOTS), chunks)
                rows = np.zeros(k.size, KEYED)
                rows["h"], rows["id"] = k.ravel(), np.repeat(p["id"].to_numpy(np.int64), k.shape[1])
                yield C.packed(0, rows, rows["h"], n_buckets)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.concatenate([np.frombuffer(x, KEYED) for x in pdf["data"]])
        rows = rows[np.lexsort((rows["id"], rows["h"]))]
        new = np.concatenate([[True], rows["h"][1:] != rows["h"][:-1]])
        first = rows["id"][np.flatnonzero(new)][np.cumsum(new) - 1]
        pairs = np.unique(np.stack([rows["id"][~new], first[~new]], 1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return reps.select("id", "sig").mapInPandas(send, C.PACKED).groupBy("bucket").applyInPandas(meet, "a long, b long").distinct()


def verify(share: int):
    """The documents of a block, one or two chunks of a group: links that join something new."""
    far, _ = reach(share)

    def linked(x: set, y: set) -> bool:
        both = len(x & y)
        return 100 * both >= share * (len(x) + len(y) - both)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").reset_index(drop=True)
        ids, chunk = pdf["id"].tolist(), pdf["chunk"].to_numpy()
        across = len(np.unique(chunk)) > 1
        seen = C.WordHash()
        shingles = [set(shingle_set(t, seen).tolist()) for t in pdf["text"]]
        size = np.array([len(x) for x in shingles])
        sig = np.frombuffer(b"".join(pdf["sig"]), "<u2").reshape(-1, SLOTS)
        groups, out = C.Groups(len(ids)), []
        for i in range(len(ids) - 1):
            fit = 100 * np.minimum(size[i], size[i + 1 :]) >= share * np.maximum(size[i], size[i + 1 :])
            if across:
                fit &= chunk[i + 1 :] != chunk[i]
            at = np.flatnonzero(fit) + i + 1
            at = at[(sig[at] != sig[i]).sum(1) <= far]
            for j in at.tolist():
                if groups.top(i) != groups.top(j) and linked(shingles[i], shingles[j]):
                    groups.join(i, j)
                    out.append((ids[j], ids[i]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def near_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each input row.

    Links are 100 * intersection >= share * union of the sets of distinct 5-word shingles, `share` from 80 to 99 (distance
    and chunks follow from it). Documents without words, and rows with a null id, link with nothing;
    fewer than five words are one shingle; equal sets are always linked; rows of one id are one document, with all
    their links; extra columns are not read; an empty table gives no rows."""
    rows = C.stored(sets(df, id_col, text_col))
    usable = rows.where("n > 0 and id is not null")
    reps = C.stored(usable.groupBy("n", "a", "b").agg(F.min("id").alias("id"), F.first("sig").alias("sig")))
    n_buckets = max(16, -(-reps.count() // 4096))
    groups = C.stored(C.components(candidate_links(reps, n_buckets, reach(share)[1])))
    # members of candidate groups, dealt to chunks of bounded rows and shingles; then every pair of chunks of a group meets
    members = C.stored(groups.join(reps.select(F.col("id").alias("node"), "n", "sig"), "node"))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")).select("component", F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("chunks"))
    members = members.join(C.stored(sizes), "component").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    texts = df.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    placed = C.stored(members.join(texts, "node").select("component", "chunks", "chunk", F.col("node").alias("id"), "sig", "n", "text"))
    pairs = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    blocks = placed.withColumn("other", pairs).select(F.concat_ws("-", "component", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("block"), "chunk", "id", "sig", "text")
    links = blocks.groupBy("block").applyInPandas(verify(share), "a long, b long")
    comps = C.stored(C.components(links))
    classes = C.stored(reps.join(comps, F.col("id") == F.col("node"), "left").select("n", "a", "b", F.coalesce("component", "id").alias("component_id")))
    keyed = rows.where("n > 0 and id is not null").join(classes, ["n", "a", "b"]).select("id", "n", "component_id")
    rest = rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    out = keyed.union(rest)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
