"""Approximate nearest neighbours: stable projections, kd-trees, and a chi-square stopping test.

A Gaussian projection to `dims` dimensions turns a distance d into a projected one whose square, over d squared, is
chi-square with `dims` degrees of freedom. Projected neighbours are therefore visited in increasing order and verified
with exact distances, until the next one is so far that, with probability `sure`, nothing as near as the k-th verified
neighbour is left: projected^2 > quantile * d_k^2.

The projected space is cut into cells by a kd-tree on a bounded sample; every row is put into its cell, and large cells
are dealt into shards by a hash of the id. In each shard a kd-tree serves neighbours in order. A query first visits its
own cell; the distance it finds there bounds, by the same test, which other cells it must visit.

Of equal vectors only the k + 1 smallest ids can be among anybody's k nearest, so the others are not indexed, and
equal queries are searched once.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers take no part, nor do vectors of
another length than most; fewer than k candidates give as many as there are; ties go to the smaller id; rows repeated
under one id count as one; null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from math import exp, inf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import staged

DIMS = 8
SURE = 0.99
SAMPLE = 20_000
ROWS_PER_CELL = 8_000
ROWS_PER_SHARD = 40_000
QUERIES_PER_BLOCK = 20_000
LEAF = 48


def chi_square_quantile(p: float, dims: int) -> float:
    """For an even number of degrees of freedom, where the distribution has a closed form."""
    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def projection(length: int, dims: int = DIMS, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(length, dims))


class Cells:
    """Top of the kd-tree: 2^depth cells with split planes from a sample."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, dims = depth, sample.shape[1]
        self.axis, self.value = np.zeros(1 << depth, int), np.zeros(1 << depth)
        self.lo, self.hi = np.full((2 << depth, dims), -inf), np.full((2 << depth, dims), inf)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            spread = part.max(0) - part.min(0) if len(part) else np.zeros(dims)
            a = self.axis[node] = int(spread.argmax())
            v = self.value[node] = float(np.median(part[:, a])) if len(part) else 0.0
            left = part[:, a] <= v
            parts[2 * node], parts[2 * node + 1] = part[left], part[~left]
            for child in (2 * node, 2 * node + 1):
                self.lo[child], self.hi[child] = self.lo[node], self.hi[node]
            self.hi[2 * node, a] = v
            self.lo[2 * node + 1, a] = v

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), int)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - (1 << self.depth)

    def squared(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance from a point to every cell."""
        lo, hi = self.lo[1 << self.depth:], self.hi[1 << self.depth:]
        return (np.maximum(np.maximum(lo - point, point - hi), 0.0) ** 2).sum(1)


class KdTree:
    """Boxes over projected points, halved at the median of the widest axis down to leaves."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[np.ndarray, np.ndarray, int, int, int, int]] = []
        self._grow(points, 0, len(points))

    def _grow(self, points: np.ndarray, a: int, b: int) -> int:
        own = points[self.order[a:b]]
        lo, hi = own.min(0), own.max(0)
        at = len(self.nodes)
        self.nodes.append((lo, hi, a, b, -1, -1))
        if b - a > LEAF:
            axis, m = int((hi - lo).argmax()), (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], m)]
            left, right = self._grow(points, a, a + m), self._grow(points, a + m, b)
            self.nodes[at] = (lo, hi, a, b, left, right)
        return at

    def blocks(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Leaves as (squared projected distance of the leaf, indices), nearest first."""
        heap = [(0.0, 0)]
        while heap:
            far, at = heappop(heap)
            lo, hi, a, b, left, right = self.nodes[at]
            if left < 0:
                yield far, self.order[a:b]
                continue
            for child in (left, right):
                c_lo, c_hi = self.nodes[child][:2]
                gap = np.maximum(np.maximum(c_lo - q, q - c_hi), 0.0)
                heappush(heap, (float(gap @ gap), child))


def nearest(tree: KdTree, vectors: np.ndarray, ids: np.ndarray, q: np.ndarray, q_low: np.ndarray, k: int,
            bound: float, quantile: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of the k nearest, verified until the stopping test holds for `bound` or better."""
    best_d, best_i = np.zeros(0), np.zeros(0, np.int64)
    for far, block in tree.blocks(q_low):
        d_k = min(bound, best_d[k - 1] if len(best_d) >= k else inf)
        if far > quantile * d_k * d_k:
            break
        d = np.sqrt(((vectors[block] - q) ** 2).sum(1))
        near = d <= d_k
        if near.any():
            best_d, best_i = np.append(best_d, d[near]), np.append(best_i, ids[block[near]])
            top = np.lexsort((best_i, best_d))[:k]
            best_d, best_i = best_d[top], best_i[top]
    return best_i, best_d


def usable(vector: str) -> Column:
    return F.expr(f"{vector} IS NOT NULL AND exists({vector}, x -> x <> 0) AND "
                  f"NOT exists({vector}, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           dims: int = DIMS, sure: float = SURE, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that `is_query`, a condition on the id as `id`, admits."""
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & usable("v")))
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").head()
    if lengths is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    length, total = lengths["n"], lengths["rows"]
    key = F.struct(F.xxhash64("v").alias("a"), F.xxhash64("v", F.lit(1)).alias("b"))
    rows = rows.where(F.size("v") == length).withColumn("key", key)
    smallest = Window.partitionBy("key").orderBy("id")
    points = rows.withColumn("place", F.dense_rank().over(smallest)).where(F.col("place") <= k + 1)
    points = staged(points.dropDuplicates(["id"]).select("id", "v"), "points")
    asked = staged(rows.where(is_query).select("id", "key", "v"), "asked")
    queries = staged(asked.dropDuplicates(["key"]).select(F.col("id").alias("q"), "key", "v"), "queries")

    a = projection(length, dims)
    chosen = points.orderBy(F.xxhash64("id")).limit(sample).select("v").collect()
    low = np.array([r["v"] for r in chosen]) @ a
    depth = max(0, min(int(np.log2(max(1, total / ROWS_PER_CELL))) + 1, int(np.log2(max(1, len(low) / 32)))))
    cells, quantile = Cells(low, depth), chi_square_quantile(sure, dims)
    k_all = k + 1  # a query's own row is among the points and is taken out at the end

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=cells.of(np.stack(batch["v"]) @ a))

    placed = staged(points.mapInPandas(place, "id long, v array<double>, cell int"), "placed")
    shards = placed.groupBy("cell").agg(F.ceil(F.count("*") / ROWS_PER_SHARD).cast("int").alias("shards"))
    placed = placed.join(F.broadcast(shards), "cell").withColumn("shard", F.pmod(F.xxhash64("id"), "shards").cast("int"))

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q, v, far, cell = [], [], [], []
            for r in batch.itertuples(index=False):
                low = np.asarray(r.v) @ a
                reach = inf if pd.isna(r.bound) else r.bound
                hit = np.flatnonzero(cells.squared(low) <= quantile * reach * reach)
                hit = hit[hit != cells.of(low[None])[0]]
                q += [r.q] * len(hit)
                v += [r.v] * len(hit)
                far += [reach] * len(hit)
                cell += hit.tolist()
            if q:
                yield pd.DataFrame({"q": q, "v": v, "bound": far, "cell": cell})

    def answer(points: pd.DataFrame, visits: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(visits):
            vectors, ids = np.stack(points["v"]), points["id"].to_numpy()
            low = vectors @ a
            tree = KdTree(low)
            for r in visits.itertuples(index=False):
                q = np.asarray(r.v)
                found, d = nearest(tree, vectors, ids, q, q @ a, k_all, r.bound, quantile)
                out.append(pd.DataFrame({"q": r.q, "id": found, "score": d}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "id": [], "score": []})

    def visit(visits: DataFrame) -> DataFrame:
        """Visits (q, v, bound, cell) answered in every shard of their cell, queries in blocks."""
        visits = visits.join(F.broadcast(shards), "cell").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        blocks = staged(visits.groupBy("cell", "shard").agg(
            F.ceil(F.count("*") / QUERIES_PER_BLOCK).cast("int").alias("blocks")), "blocks")
        dealt = visits.join(F.broadcast(blocks), ["cell", "shard"]).withColumn("block", F.pmod(F.xxhash64("q"), "blocks").cast("int"))
        copies = (placed.join(F.broadcast(blocks), ["cell", "shard"])
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
        by = ["cell", "shard", "block"]
        return (copies.select(*by, "id", "v").groupBy(*by)
                .cogroup(dealt.select(*by, "q", "v", "bound").groupBy(*by))
                .applyInPandas(answer, "q long, id long, score double"))

    home = queries.select(F.col("q").alias("id"), "v").mapInPandas(place, "id long, v array<double>, cell int")
    first = staged(visit(home.select(F.col("id").alias("q"), "v", F.lit(inf).alias("bound"), "cell")), "found")
    order = Window.partitionBy("q").orderBy("score", "id")
    bounds = (first.withColumn("place", F.row_number().over(order)).where(F.col("place") == k_all)
              .select("q", F.col("score").alias("bound")))
    reach = queries.select("q", "v").join(bounds, "q", "left").mapInPandas(
        others, "q long, v array<double>, bound double, cell int")
    found = staged(first.unionByName(staged(visit(staged(reach, "visits")), "found")), "found")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k_all)
    best = best.join(queries.select("q", "key"), "q").select("key", F.col("id").alias("vec_id"), "score")
    pairs = asked.select(F.col("id").alias("query_id"), "key").dropDuplicates(["query_id"]).join(best, "key")
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (pairs.where("query_id <> vec_id").withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
