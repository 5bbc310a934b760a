"""Exact search against brute force over all rows."""

import math

import numpy as np

from paddock.llm import kdtree_search as kd
from paddock.llm.queries import op10_kdtree_search

from ..conftest import SF_SMALL
from pyspark.sql import functions as F


def brute(rows, k=10, every=100):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        scores = sorted((-sum(x * y for x, y in zip(a, v, strict=True)), i) for i, v in ok if i != q and len(v) == len(a))
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(want)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert got(op10_kdtree_search(spark, SF_SMALL)) == brute(rows)


def test_many_shards_blocks_ties_and_a_common_vector(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [0.5, -0.25, 0.125] if i % 3 == 0 else rng.integers(-3, 4, 3).astype(float).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for shard_rows, block_rows in ((50, 3), (600, 1)):
        assert got(kd.top_k(df, F.col("vec_id") % 10 == 0, shard_rows=shard_rows, block_rows=block_rows)) == brute(rows, every=10)


def test_pruning_leaves_out_most_rows_of_clustered_data():
    rng = np.random.default_rng(1)
    rows = (rng.normal(0, 1000, (20, 4))[rng.integers(0, 20, 4000)] + rng.normal(0, 5, (4000, 4))).astype(np.int64)
    tree, seen = kd.KdTree(np.arange(4000), rows), []
    q = rows[:1]
    ids, scores = next(tree.search(q, np.array([-1]), np.array([kd.LOWEST]), 10))
    want = rows @ q[0]
    assert sorted(scores)[::-1] == sorted(want)[::-1][:10]
    reach = np.maximum(q, 0) @ tree.hi.T + np.minimum(q, 0) @ tree.lo.T
    assert (reach[0][tree.left < 0] >= min(scores)).mean() < 0.5


def test_large_integers_stay_exact():
    rows = np.array([[1 << 40, 3], [1 << 40, 4], [5, 5]], np.int64)
    ids, scores = next(kd.KdTree(np.arange(3), rows).search(np.array([[1 << 20, 1]]), np.array([9]), np.array([kd.LOWEST]), 2))
    assert dict(zip(ids, scores, strict=True)) == {0: (1 << 60) + 3, 1: (1 << 60) + 4}


def test_nulls_non_finite_repeated_rows_lengths_and_clashing_columns(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0, None]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, [-0.0004, 2.0]), (100, [3.0]), (8, [1.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, shard int, rank int")
    assert got(kd.top_k(df, F.col("vec_id") % 100 == 0)) == brute(rows)
    assert got(kd.top_k(df.limit(0), F.col("vec_id") % 100 == 0)) == []


def clustered(n, clusters, dim=6):
    rng = np.random.default_rng(n)
    centres = np.random.default_rng(1).normal(0, 1, (64, dim))[:clusters]
    return (centres[rng.integers(0, clusters, n)] + rng.normal(0, 0.01, (n, dim))).tolist()


def test_queries_go_only_where_their_scores_can_be(spark, monkeypatch):
    """Clustered vectors: (query, leaf) pairs are a fraction of all, and grow less than shards times queries."""
    sent, real = [], kd.reachable

    def counted(queries, boxes):
        out = real(queries, boxes)
        sent.append((out.count(), queries.count() * len(boxes.value[6][0])))
        return out

    monkeypatch.setattr(kd, "reachable", counted)
    for n in (1000, 4000):
        rows = list(enumerate(clustered(n, 40)))
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
        assert got(kd.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=25, leaf_rows=8)) == brute(rows, every=50)
    (small, all_small), (large, all_large) = sent
    assert small < 0.5 * all_small and large < 0.25 * all_large
    assert large / small < 0.7 * all_large / all_small


def test_a_vector_that_most_rows_hold_makes_many_small_shards(spark, monkeypatch):
    sizes, real = [], kd.build_trees

    def seen(vectors, leaf):
        sizes.extend(r["count"] for r in vectors.groupBy("dim", "leaf", "shard").count().collect())
        return real(vectors, leaf)

    monkeypatch.setattr(kd, "build_trees", seen)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i % 7), 0.0, float(i % 11)]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert got(kd.top_k(df, F.col("vec_id") % 90 == 0, shard_rows=40)) == brute(rows, every=90)
    assert max(sizes) <= 90 and sum(sizes) == 900


def test_dealing_splits_at_medians():
    rows = np.random.default_rng(2).integers(-1000, 1000, (4096, 3))
    dealer = kd.Dealer(rows, 16)
    assert dealer.leaves == 16 and np.bincount(dealer.leaf_of(rows)).min() > 150
    assert kd.Dealer(np.ones((50, 3), np.int64), 16).leaves == 1 and kd.Dealer(np.empty((0, 3), np.int64), 4).leaves == 1
