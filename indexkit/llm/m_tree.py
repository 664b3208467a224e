"""Exact top-k by integer inner product: best-first search in M-trees.

Method: each shard of the vectors is one M-tree of paged nodes.  An entry of an
inner page holds a routing vector, the covering radius of its subtree and the
distance to the page's own routing vector (the parent distance); an entry of a
leaf page holds a vector and its parent distance.  With Euclidean distance d,
2 q.x = |q|^2 + |x|^2 - d(q,x)^2, so a lower bound on d gives an upper bound on
the score.  Entries are first bounded by |d(q,p) - d(p,e)| from stored numbers
alone; only survivors have their distance or score computed.  Pages wait in a
queue ordered by bound; search ends when the best bound is below the k-th
score.  Ties at the k-th score are searched on, so the smaller id wins.

Queries meet all shards in blocks: each shard's task builds its tree and
streams the query rows past it, keeping k rows per query.

Defined results: null vectors and vectors with null or non-finite components
take no part; only vectors of a query's own length are compared; rows that
carry the query's id are its own; a repeated query row is answered once; a null
id is never a query and sorts last; fewer candidates than k give fewer rows.
Scores beyond a long are held at its limits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexkit.llm.common import parts

PAGE = 64
SHARD_ROWS = 4096
_NO_ID = 2 ** 63 - 1
_EXACT = 2.0 ** 53


class MTree:
    """Bulk-loaded M-tree over integer vectors (held as float64 while every
    inner product is exact in it, else as Python integers)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE):
        self.page = page
        self.ids = ids
        self.x = vectors
        self.f = vectors.astype(np.float64)
        self.n2 = (self.f * self.f).sum(1)
        self.computed = 0
        self.root = self._build(np.arange(len(ids)), None) if len(ids) else None

    def _distance(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        return np.sqrt(((self.f[rows] - self.f[pivot]) ** 2).sum(1))

    def _build(self, rows: np.ndarray, pivot: int | None) -> tuple:
        to_pivot = self._distance(rows, pivot) if pivot is not None else np.zeros(len(rows))
        if len(rows) <= self.page:
            return ("leaf", rows, to_pivot)
        fan = min(self.page, -(-len(rows) // self.page))
        seeds = np.unique(rows[np.argsort(to_pivot, kind="stable")][np.linspace(0, len(rows) - 1, fan).astype(int)])
        d2 = self.n2[rows][:, None] + self.n2[seeds][None, :] - 2 * (self.f[rows] @ self.f[seeds].T)
        nearest = d2.argmin(1)
        groups = [rows[nearest == k] for k in range(len(seeds))]
        if max(map(len, groups)) > 0.9 * len(rows):  # near-equal vectors: cut evenly instead
            groups = np.array_split(rows, fan)
            seeds = np.array([g[0] for g in groups])
        entries = [(s, g) for s, g in zip(seeds, groups) if len(g)]
        routing = np.array([s for s, _ in entries])
        radius = np.array([self._distance(g, s).max() for s, g in entries])
        parent = self._distance(routing, pivot) if pivot is not None else np.zeros(len(entries))
        most = np.array([self.n2[g].max() for _, g in entries])
        return ("node", routing, radius, parent, most, [self._build(g, s) for s, g in entries])

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, ordered by score, then id."""
        best_ids, best = np.empty(0, np.int64), np.empty(0, self.x.dtype)
        if self.root is None or k < 1:
            return best_ids, best
        qf = q.astype(np.float64)
        q2 = float(qf @ qf)
        slack = 1e-9 * (q2 + float(self.n2.max())) + 1e-6
        floor = -np.inf
        queue = [(-np.inf, 0, self.root, 0.0, False)]
        pushed = 0
        while queue:
            bound, _, node, to_parent, has_parent = heapq.heappop(queue)
            if -bound + slack < floor:
                break
            if node[0] == "leaf":
                rows, stored = node[1], node[2]
                if has_parent:
                    gap = to_parent - stored
                    rows = rows[~((q2 + self.n2[rows] - gap * gap) / 2 + slack < floor)]
                rows = rows[self.ids[rows] != query_id]
                x = self.x[rows]
                score = x @ q if x.dtype == q.dtype else _whole(x) @ _whole(q)
                self.computed += len(rows)
                ids = np.concatenate([best_ids, self.ids[rows]])
                score = np.concatenate([best, score]) if best.dtype == score.dtype else \
                    np.concatenate([_whole(best), _whole(score)])
                order = np.lexsort((ids, -score))[:k] if score.dtype != object else \
                    np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k], dtype=int)
                best_ids, best = ids[order], score[order]
                if len(best) == k:
                    floor = float(best[-1])
                continue
            _, routing, radius, stored, most, children = node
            keep = np.arange(len(routing))
            if has_parent:
                near = np.maximum(np.abs(to_parent - stored) - radius, 0)
                keep = keep[~((q2 + most - near * near) / 2 + slack < floor)]
            if not len(keep):
                continue
            at = routing[keep]
            dot = self.f[at] @ qf
            self.computed += len(at)
            d = np.sqrt(np.maximum(q2 + self.n2[at] - 2 * dot, 0))
            near = np.maximum(d - radius[keep], 0)
            upper = np.minimum((q2 + most[keep] - near * near) / 2, dot + np.sqrt(q2) * radius[keep])
            upper = np.nan_to_num(upper, nan=np.inf, posinf=np.inf)  # components near the float limit: no bound
            for j, i in enumerate(keep):
                if upper[j] + slack >= floor:
                    pushed += 1
                    heapq.heappush(queue, (-upper[j], pushed, children[i], d[j], True))
        return best_ids, best


def _whole(a: np.ndarray) -> np.ndarray:
    return a if a.dtype == object else np.frompyfunc(int, 1, 1)(a)


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _integers(vectors: pd.Series) -> np.ndarray:
    """floor(1024 x) of every component."""
    raw = np.floor(1024.0 * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))
    if not raw.size or np.abs(raw).max() ** 2 * max(1, raw.shape[1]) * 4 < _EXACT:
        return raw
    return np.array([[int(x) if np.isfinite(x) else int(np.sign(x)) << 1100 for x in row] for row in raw], dtype=object)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best ``rows`` for each of
    ``queries``; both have (vec_id, embedding)."""
    def clean(df: DataFrame) -> DataFrame:
        vec = F.col("embedding").cast("array<double>")
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("v")).filter(usable(F.col("v")))
    vectors, asked = clean(rows), clean(queries).filter("vec_id IS NOT NULL").distinct()
    shards = parts(vectors.count(), shard_rows)
    placed = vectors.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"),
                            F.lit(0).alias("kind"), F.coalesce("vec_id", F.lit(_NO_ID)).alias("vec_id"), "v",
                            F.lit(0).cast("long").alias("q"))
    shown = asked.select(F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                         F.lit(1).alias("kind"), "vec_id", "v", F.xxhash64("v").alias("q"))
    both = placed.unionByName(shown).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, tree = None, [], None
        for batch in batches:
            for now, part in batch.groupby(["dim", "shard"], sort=False):
                if now != key:
                    key, held, tree = now, [], None
                held.append(part[part["kind"] == 0])
                shown_now = part[part["kind"] == 1]
                if not len(shown_now):
                    continue
                if tree is None:
                    all_rows = pd.concat(held)
                    held = []
                    tree = MTree(all_rows["vec_id"].to_numpy(np.int64), _integers(all_rows["v"])) if len(all_rows) else None
                if tree is None:
                    continue
                out = []
                for q_id, mark, q in zip(shown_now["vec_id"], shown_now["q"], _integers(shown_now["v"])):
                    ids, scores = tree.search(q_id, q, k)
                    out += [(q_id, mark, i, max(min(int(s), _NO_ID), -_NO_ID - 1)) for i, s in zip(ids.tolist(), scores.tolist())]
                yield pd.DataFrame(out, columns=["query_id", "q", "vec_id", "score"])

    found = both.mapInPandas(answer, "query_id long, q long, vec_id long, score long")
    w = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != _NO_ID, F.col("vec_id")).alias("vec_id"), "score")
