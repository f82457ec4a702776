"""Nearest neighbours: recall and distances against brute force, ties, unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancy_lake.llm import neighbours, queries


def brute(vectors, ids, q, k):
    d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
    d, ids = d[ids != q], ids[ids != q]
    top = np.lexsort((ids, d))[:k]
    return ids[top], d[top]


def test_recall_on_given_table(spark):
    out = queries.QUERIES["op2_nearest_neighbours"](spark, "/root/testdata/sf0.1").toPandas()
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    vectors, ids = np.stack(t.embedding).astype(float), t.vec_id.to_numpy()
    hits = total = 0
    for q, part in out.groupby("query_id"):
        part = part.sort_values("rank")
        want, d = brute(vectors, ids, q, 10)
        assert list(part["rank"]) == list(range(1, 11)) and (np.diff(part.score) >= 0).all()
        exact = np.sqrt(((vectors[[np.flatnonzero(ids == i)[0] for i in part.vec_id]] - vectors[ids == q][0]) ** 2).sum(1))
        assert np.allclose(part.score, exact, rtol=1e-12)
        hits, total = hits + len(set(want) & set(part.vec_id)), total + 10
    assert set(out.query_id) == {i for i in ids if i % 100 == 0} and hits / total >= 0.9


def test_cells_shards_and_blocks(spark, monkeypatch):
    """Many small cells, shards and query blocks give the same neighbours."""
    for name, n in (("ROWS_PER_CELL", 40), ("ROWS_PER_SHARD", 15), ("QUERIES_PER_BLOCK", 3)):
        monkeypatch.setattr(neighbours, name, n)
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(c, 1, (150, 12)) for c in (0, 4, 9)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    out = neighbours.search(df, F.col("id") % 10 == 0, k=5).toPandas()
    hits = sum(len(set(brute(vectors, np.arange(450), q, 5)[0]) & set(p.vec_id)) for q, p in out.groupby("query_id"))
    assert len(out) == 45 * 5 and hits / 225 >= 0.9


def test_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (7, [2.0, 0.0]), (6, [0.0, 0.0]), (8, None),
            (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, []), (13, [1.0, 2.0, 3.0]), (200, [0.0, 0.0]), (300, None),
            (None, [1.0, 1.0]), (7, [2.0, 0.0]), (400, [9.0, 9.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, v int")
    out = neighbours.search(df, F.col("id") % 100 == 0, k=4).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == 100] == [
        (100, 1, 3, 0.0), (100, 2, 4, 0.0), (100, 3, 5, 0.0), (100, 4, 7, 1.0)]
    assert {r["query_id"] for r in out} == {100, 400}
    assert [r["vec_id"] for r in out if r["query_id"] == 400][0] == 7
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


def test_large_group_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [float(i), 1.0, 0.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = neighbours.search(df, F.col("id") % 100 == 0, k=3).collect()
    got = {q: [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 100, 1000)}
    assert got == {0: [1, 2, 3], 100: [0, 1, 2], 1000: [1001, 1002, 1003]} or got[1000][0] == 1001


def test_quantile():
    assert neighbours.chi_square_quantile(0.99, 8) == pytest.approx(20.0902, abs=1e-3)
    assert neighbours.chi_square_quantile(0.5, 2) == pytest.approx(2 * np.log(2), abs=1e-6)


def test_tree_gives_leaves_in_order():
    points = np.random.default_rng(1).normal(size=(1000, 4))
    tree, q = neighbours.KdTree(points), np.zeros(4)
    seen, last = [], 0.0
    for far, block in tree.blocks(q):
        assert far >= last and ((points[block] ** 2).sum(1) >= far - 1e-12).all()
        last = far
        seen.extend(block)
    assert sorted(seen) == list(range(1000))
