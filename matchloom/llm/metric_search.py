"""Exact top-k inner-product search by best-first traversal of M-trees.

Inner products become distances: a vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm of its tree, and
a query 0; nearer is then a larger product. Rows are dealt to shards of bounded size. A shard's rows fill an M-tree of paged
nodes; every entry holds its distance to the parent's routing object, every routing entry a covering radius. Queries stream
through each shard; nodes are opened by their lower bound, and the triangle inequality on stored distances saves computing
others. A shard returns its best k, whose best k are the answer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = 256
FEWEST_SHARDS = 24
LARGEST_SHARD = 65_536
EXACT = 2.0**52


def quantised(embedding: Column) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(256) * x.cast("double")).cast("long"))


def usable(embedding: Column) -> Column:
    """Not null, and without null or non-finite components."""
    return embedding.isNotNull() & ~F.coalesce(F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))), F.lit(True))


def padded(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


class MTree:
    """Nodes in flat lists; node 0 is the root, whose routing object is its first entry."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE):
        order = np.argsort(ids, kind="stable")
        self.ids, self.ints = ids[order], vectors[order]
        self.x = self.ints.astype(np.float64)
        norms = (self.x**2).sum(1)
        self.top = float(norms.max()) if len(norms) else 0.0
        self.extra = np.sqrt(np.maximum(self.top - norms, 0.0))
        self.norms, self.page = norms, page
        self.exact = self.top * 4 < EXACT
        # for each node: routing object, entries (objects of a leaf, nodes else), their distances to it, and their radii
        self.router: list[int] = []
        self.entries: list[np.ndarray] = []
        self.parent_distance: list[np.ndarray] = []
        self.radii: list[np.ndarray | None] = []
        self.routers: list[np.ndarray | None] = []
        self.seed = np.random.default_rng(len(ids))
        if len(ids):
            self.build(np.arange(len(ids)), 0)

    def distances(self, i: int, js: np.ndarray) -> np.ndarray:
        d = self.x[js] - self.x[i]
        return np.sqrt((d * d).sum(1) + (self.extra[js] - self.extra[i]) ** 2)

    def build(self, members: np.ndarray, router: int) -> tuple[int, float]:
        """The node over these members and its covering radius."""
        node = len(self.router)
        self.router.append(router)
        self.entries.append(members)
        to_router = self.distances(router, members)
        self.parent_distance.append(to_router)
        self.radii.append(None)
        self.routers.append(None)
        if len(members) > self.page:
            fan = min(self.page, -(-len(members) // self.page) + 1, 16)
            centres, near = [], np.full(len(members), np.inf)
            part = np.zeros(len(members), np.int64)
            nxt = int(to_router.argmax())
            for c in range(fan):
                centres.append(int(members[nxt]))
                d = self.distances(centres[-1], members)
                part[d < near] = c
                near = np.minimum(near, d)
                nxt = int(near.argmax())
            if near.max() == 0 and len(np.unique(part)) == 1:  # equal objects are dealt evenly
                part = np.arange(len(members)) % fan
                centres = [int(members[c]) for c in range(fan)]
            kept = [c for c in range(fan) if (part == c).any()]
            children = [self.build(members[part == c], centres[c]) for c in kept]
            self.entries[node] = np.array([n for n, _ in children])
            self.routers[node] = np.array([centres[c] for c in kept])
            self.parent_distance[node] = self.distances(router, self.routers[node])
            self.radii[node] = np.array([r for _, r in children])
        return node, float(to_router.max())

    def scores(self, q: np.ndarray, js: np.ndarray) -> np.ndarray:
        return (self.x[js] @ q.astype(np.float64)).astype(np.int64) if self.exact else self.ints[js] @ q

    def search(self, query_id, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id), larger scores and then smaller ids first."""
        if not len(self.ids):
            return []
        qq = float((q.astype(np.float64) ** 2).sum())
        slack = 1e-7 * (np.sqrt(self.top) + np.sqrt(qq) + 1)

        def to(js: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(qq + self.top - 2.0 * (self.x[js] @ q), 0.0))

        best: list[tuple[int, int]] = []  # heap of (score, -id)
        limit = np.inf
        queue = [(0.0, 0, float(to(np.array([self.router[0]]))[0]))]
        while queue:
            bound, node, distance = heapq.heappop(queue)
            if bound > limit + slack:
                break
            gap, radii, entries = np.abs(distance - self.parent_distance[node]), self.radii[node], self.entries[node]
            if radii is None:
                js = entries[gap <= limit + slack]
                if not len(js):
                    continue
                s = self.scores(q, js)
                if len(best) == k:
                    better = s >= best[0][0]
                    s, js = s[better], js[better]
                elif len(s) > k + 1:  # the page's k best and their ties, and the query itself
                    better = s >= np.partition(s, -k - 1)[-k - 1]
                    s, js = s[better], js[better]
                for score, j in zip(s.tolist(), js.tolist(), strict=True):
                    i = int(self.ids[j])
                    if i == query_id:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
                if len(best) == k:
                    limit = np.sqrt(max(qq + self.top - 2.0 * best[0][0], 0.0))
            else:
                open_ = np.flatnonzero(gap - radii <= limit + slack)
                if len(open_):
                    nodes = entries[open_]
                    d = to(self.routers[node][open_])
                    for n, dn, low in zip(nodes.tolist(), d.tolist(), np.maximum(d - radii[open_], 0.0).tolist(), strict=True):
                        if low <= limit + slack:
                            heapq.heappush(queue, (low, n, dn))
        return sorted(((s, -i) for s, i in best), key=lambda t: (-t[0], t[1]))


FOUND = "query_id long, vec_id long, score long"


def search_shards(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, rows, tree = None, [], None
        for pdf in batches:
            out = []
            for s, kind, i, v in zip(pdf["shard"], pdf["kind"], pdf["id"], pdf["v"], strict=True):
                if s != shard:
                    shard, rows, tree = s, [], None
                if kind == 0:
                    rows.append((int(i), v))
                    continue
                if tree is None:
                    width = max([len(x) for _, x in rows], default=0)
                    tree = MTree(np.array([x for x, _ in rows], np.int64), padded([x for _, x in rows], width))
                    rows = []
                width = tree.ints.shape[1]
                q = np.zeros(width, np.int64)
                q[: min(width, len(v))] = v[:width]
                out += [(int(i), j, score) for score, j in tree.search(int(i), q, k)]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every` its k best others.

    Components become floor(256 * x). Vectors that are null or hold null or non-finite components, and null ids, take no part;
    a shorter vector counts as filled up with zeros; ties go to the smaller id; rows of one id are one vector, the one of the
    largest array; fewer than k rows give them all; empty tables give none. Extra columns are not read."""
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("v")).groupBy("id").agg(F.max("v").alias("v"))
    n = vectors.count()
    shards = max(FEWEST_SHARDS, -(-n // LARGEST_SHARD))
    members = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "id", "v")
    queries = rows.where(F.col("id") % every == 0).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "id", "v")
    found = members.union(queries).repartition(shards, "shard").sortWithinPartitions("shard", "kind").mapInPandas(search_shards(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, max(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""
