"""Near-duplicate vectors by an inverted multi-index.

Vectors are normalised; two codebooks, one for each half of the components and fitted on a bounded sample, span a grid of
cells. Every vector lies in its nearest cell, and visits cells in the multi-sequence order of the two distances, as many as
let simulated neighbours be found with the target recall. Cells meet their visitors in blocks of bounded size, where cosines
are computed in double precision. Equal vectors are one representative with a multiplicity.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .metric_search import usable

SAMPLE = 8192
CELL_ROWS = 400
MOST_CENTRES = 512
MEMBERS, VISITORS = 2048, 8192


def normalised(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, : len(r)] = r[:width]
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def centres(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's centres from evenly spaced start rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = distances(x, c).argmin(1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].mean(0)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (c**2).sum(1)[None] - 2 * x @ c.T, 0.0)


class MultiIndex:
    def __init__(self, first: np.ndarray, second: np.ndarray, half: int, visits: int):
        self.first, self.second, self.half, self.visits = first, second, half, visits

    def cells(self, x: np.ndarray) -> np.ndarray:
        return distances(x[:, : self.half], self.first).argmin(1) * len(self.second) + distances(x[:, self.half :], self.second).argmin(1)

    def places(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Place of y's cell in the traversal from x, for each pair of rows: cells that are nearer or as near come before it."""
        d1, d2 = distances(x[:, : self.half], self.first), distances(x[:, self.half :], self.second)
        cell = self.cells(y)
        out = np.zeros(len(x), np.int64)
        for r in range(len(x)):
            far = d1[r, cell[r] // len(self.second)] + d2[r, cell[r] % len(self.second)]
            out[r] = (d1[r][:, None] + d2[r][None] <= far).sum() - 1
        return out

    def sequences(self, x: np.ndarray, visits: int | None = None) -> np.ndarray:
        """For each vector the nearest cells, by multi-sequence traversal of both sorted distance lists."""
        visits = min(visits or self.visits, len(self.first) * len(self.second))
        d1, d2 = distances(x[:, : self.half], self.first), distances(x[:, self.half :], self.second)
        o1, o2 = np.argsort(d1, 1, kind="stable"), np.argsort(d2, 1, kind="stable")
        s1, s2 = np.take_along_axis(d1, o1, 1).tolist(), np.take_along_axis(d2, o2, 1).tolist()
        n1, n2 = len(self.first), len(self.second)
        out = np.zeros((len(x), visits), np.int32)
        for r in range(len(x)):
            a, b, seq = s1[r], s2[r], []
            queue = [(a[0] + b[0], 0, 0)]
            while len(seq) < visits:
                _, i, j = heapq.heappop(queue)
                seq.append((i, j))
                if j + 1 < n2:
                    heapq.heappush(queue, (a[i] + b[j + 1], i, j + 1))
                if j == 0 and i + 1 < n1:
                    heapq.heappush(queue, (a[i + 1] + b[0], i + 1, 0))
            at = np.array(seq)
            out[r] = o1[r, at[:, 0]] * n2 + o2[r, at[:, 1]]
        return out


def fit(sample: np.ndarray, n: int, least: float, recall: float) -> MultiIndex:
    """Codebooks, and how many cells to visit: enough for `recall` of neighbours put at random directions from sample
    vectors, at cosines evenly between `least` and 1, however many these are."""
    half = sample.shape[1] // 2
    k = int(min(MOST_CENTRES, max(2, round((n / CELL_ROWS) ** 0.5)), len(sample)))
    index = MultiIndex(centres(sample[:, :half], k), centres(sample[:, half:], k), half, 1)
    rng = np.random.default_rng(7)
    x = sample[np.linspace(0, len(sample) - 1, min(len(sample), 500)).astype(int)]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    norm = np.linalg.norm(noise, axis=1, keepdims=True)
    noise = np.divide(noise, norm, out=np.zeros_like(noise), where=norm > 0)
    cos = rng.uniform(least, 1.0, (len(x), 1))
    y = cos * x + np.sqrt(1 - cos**2) * noise
    index.visits = int(np.quantile(index.places(x, y), recall)) + 1
    return index


BLOCK = "a long, b long, n long"


def compare(index: MultiIndex, width: int, least: float):
    """Streams the visitors of each block past its members: (a, null, n) rows count links, (a, b, null) rows join."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, rows, members = None, [], None
        for pdf in batches:
            keys = pdf["block"].to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(pdf) else []
            for lo, hi in zip(cut, [*cut[1:], len(pdf)], strict=True):
                part = pdf.iloc[lo:hi]
                if part["block"].iloc[0] != block:
                    block, rows, members = part["block"].iloc[0], [], None
                own, guests = part[part["kind"] == 0], part[part["kind"] == 1]
                rows += list(zip(own["id"], own["m"], own["v"], strict=True))
                if len(guests):
                    if members is None:
                        members = prepared(index, rows, width)
                    yield from links(members, prepared(index, list(zip(guests["id"], guests["m"], guests["v"], strict=True)), width, guests["cell"].to_numpy()), least, index)

    return run


def prepared(index, rows, width, cells=None):
    ids = np.array([r[0] for r in rows], np.int64)
    x = normalised([r[2] for r in rows], width) if rows else np.zeros((0, width))
    return ids, np.array([r[1] for r in rows], np.int64), x, cells


def links(members, guests, least, index) -> Iterator[pd.DataFrame]:
    ids, many, x, _ = members
    gids, gmany, gx, cells = guests
    if not len(ids):
        return
    for at in range(0, len(gids), 512):
        g, gm, v = gids[at : at + 512], gmany[at : at + 512], gx[at : at + 512]
        close = (v @ x.T >= least) & (g[:, None] != ids[None])
        if not close.any():
            continue
        gi, mi = np.flatnonzero(close.any(1)), np.flatnonzero(close.any(0))
        close = close[np.ix_(gi, mi)]
        # a member that does not visit the guest's cell would not count this link itself
        homes = index.cells(v[gi])
        visited = index.sequences(x[mi])
        unseen = close & ~np.stack([(visited == h).any(1) for h in homes])
        out = [pd.DataFrame({"a": g[gi], "n": close @ many[mi]}), pd.DataFrame({"a": ids[mi], "n": gm[gi] @ unseen})]
        nodes = np.concatenate([g[gi], ids[mi]])
        label, before = nodes.copy(), None
        while before is None or (label != before).any():
            before = label.copy()
            left, right = label[: len(gi)], label[len(gi) :]
            left = np.minimum(left, np.where(close, right[None], C.LAST).min(1))
            right = np.minimum(right, np.where(close, left[:, None], C.LAST).min(0))
            label = np.concatenate([left, right])
        out.append(pd.DataFrame({"a": nodes[label != nodes], "b": label[label != nodes]}))
        yield pd.concat(out).reindex(columns=["a", "b", "n"]).astype({"a": "int64", "b": "Int64", "n": "Int64"})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, recall: float = 0.99) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each input row.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do rows with a null id; shorter
    vectors count as filled up with zeros; repeated rows are vectors of their own with the same id; extra columns are not
    read; an empty table gives no rows. The codebooks see at most SAMPLE vectors, those with the smallest hash."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    norm = F.aggregate(F.col("v"), F.lit(0.0), lambda s, x: s + x * x)
    largest = F.aggregate(F.col("v"), F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    # where the squares would overflow or lose digits, the largest component becomes 1
    scaled = F.when(norm.between(1e-200, 1e300), F.col("v")).otherwise(F.transform(F.array(largest), lambda t: F.transform(F.col("v"), lambda x: x / t))[0])
    nonzero = F.coalesce(F.exists(F.col(vector_col), lambda x: x.cast("double") != 0), F.lit(False))
    good = C.stored(vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull() & nonzero).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).withColumn("v", scaled).withColumn("h", F.xxhash64("v")).withColumn("g", F.xxhash64("v", F.lit(1))))
    reps = C.stored(good.groupBy("h", "g").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m"), F.min("v").alias("v")))
    n, width = reps.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blank = vectors.select(F.col(id_col).alias("vec_id"))
    if not n:
        return blank.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sample = [r["v"] for r in reps.select("v", "h", "g").orderBy("h", "g").limit(SAMPLE).collect()]
    index = fit(normalised(sample, width), n, least, recall)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 2000):
                p = pdf.iloc[at : at + 2000]
                x = normalised(list(p["v"]), width)
                yield pd.DataFrame({"id": p["id"], "m": p["m"], "v": p["v"], "home": index.cells(x), "cells": list(index.sequences(x))})

    placed = C.stored(reps.select("id", "m", "v").mapInPandas(place, "id long, m long, v array<double>, home int, cells array<int>"))
    # one row for each cell: bounded by MOST_CENTRES squared
    inside = placed.groupBy("home").agg(F.count(F.lit(1)).alias("inside"))
    visiting = placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("visiting"))
    sizes = C.stored(inside.join(visiting, F.col("home") == F.col("cell")).select("cell", F.ceil(F.col("inside") / MEMBERS).cast("int").alias("mc"), F.ceil(F.col("visiting") / VISITORS).cast("int").alias("vc")))
    members = placed.join(F.broadcast(sizes), F.col("home") == F.col("cell")).select("cell", F.pmod(F.xxhash64("id"), F.col("mc")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("vc") - 1)).alias("j"), F.lit(0).alias("kind"), "id", "m", "v")
    guests = placed.select("id", "m", "v", F.explode("cells").alias("cell")).join(F.broadcast(sizes), "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("mc") - 1)).alias("i"), F.pmod(F.xxhash64("id"), F.col("vc")).cast("int").alias("j"), F.lit(1).alias("kind"), "id", "m", "v")
    blocks = members.union(guests).withColumn("block", F.concat_ws("-", "cell", "i", "j"))
    found = C.stored(blocks.repartition("block").sortWithinPartitions("block", "kind").mapInPandas(compare(index, width, least), BLOCK))
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    comps = C.stored(C.components(found.where("b is not null").select("a", "b")))
    by_rep = C.stored(reps.select("h", "g", "id", "m").join(counts, F.col("id") == F.col("a"), "left").join(comps, F.col("id") == F.col("node"), "left").select("h", "g", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    linked = good.select("id", "h", "g").join(by_rep, ["h", "g"]).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    rest = vectors.where(~usable(F.col(vector_col)) | F.col(id_col).isNull() | ~nonzero).select(F.col(id_col).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"))
    return linked.union(rest).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
