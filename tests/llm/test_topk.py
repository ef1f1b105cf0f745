"""Exact top-k against sorting all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchledger.llm import topk


def brute(vectors, queries, k):
    rows = []
    for q in queries:
        scores = []
        for i, v in vectors.items():
            n = max(len(v), len(vectors[q]))
            pad = lambda x: np.pad(np.array(x, float), (0, n - len(x)))
            if i != q:
                scores.append((-float(pad(v) @ pad(vectors[q])), i))
        rows += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows)


def search(spark, rows, k=5, every=3, **options):
    df = spark.createDataFrame(rows, "id long, v array<double>")
    ready = topk.finite_vectors(df, "id", "v", lambda x: x)
    found = topk.top_k(ready, F.col("id") % every == 0, k, **options)
    return sorted(tuple(r) for r in found.collect())


def random_rows(count, width=8, seed=0):
    random = np.random.default_rng(seed)
    return {i: random.integers(-9, 10, width).astype(float).tolist() for i in range(count)}


@pytest.mark.parametrize("shard_rows, block_rows, leaf_rows", [(1000, 1000, 16), (40, 20, 4), (7, 5, 1)])
@pytest.mark.parametrize("pivots", [1, 9, 256])
def test_matches_brute_force(spark, shard_rows, block_rows, leaf_rows, pivots):
    vectors = random_rows(150)
    got = search(
        spark, list(vectors.items()), shard_rows=shard_rows, block_rows=block_rows,
        leaf_rows=leaf_rows, pivots=pivots,
    )
    assert got == brute(vectors, [i for i in vectors if i % 3 == 0], 5)


def test_ties_and_a_very_common_vector(spark):
    vectors = random_rows(60) | {i: [1.0] * 8 for i in range(60, 160)}
    got = search(spark, list(vectors.items()), shard_rows=30, block_rows=16, leaf_rows=8)
    assert got == brute(vectors, [i for i in vectors if i % 3 == 0], 5)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [3.0]), (2, [0.0, 1.0]), (3, []), (4, None), (5, [None, 1.0]),
            (6, [nan, 1.0]), (9, [inf]), (12, [-inf]), (None, [5.0, 5.0]), (2, [9.0, 9.0]), (0, [1.0, 2.0])]
    vectors = {0: [1.0, 2.0], 1: [3.0], 2: [0.0, 1.0], 3: []}
    assert search(spark, rows) == brute(vectors, [0, 3], 5)


def test_few_and_no_candidates(spark):
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(1, [1.0])]) == []
    assert search(spark, []) == []
    assert search(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 2.0)]


def clustered_rows(clusters, each, seed=1):
    random = np.random.default_rng(seed)
    centres = random.normal(0, 50, (clusters, 6))
    return np.concatenate([c + random.normal(0, 1, (each, 6)) for c in centres])


def test_nodes_are_taken_by_bound_and_bounds_hold():
    rows = clustered_rows(20, 100)
    tree = topk.BallTree(rows, np.arange(2000), 25)
    query = rows[:3]
    bounds = tree.bounds(query)
    for node, (start, end) in enumerate(tree.slices):
        assert ((query @ tree.rows[start:end].T).max(axis=1) <= bounds[:, node]).all()
        for child in tree.children[node]:
            assert child < 0 or (child > node and (bounds[:, child] <= bounds[:, node]).all())
    kth = np.sort(rows @ query[0])[-5]
    leaves = np.array([left < 0 for left, _ in tree.children])
    assert 0 < (leaves & (bounds[0] >= kth)).sum() < len(tree.radii) / 8


def test_values_beyond_a_double_lose_nothing():
    rows = np.array([[1e200, 1.0], [1e200, 2.0], [3.0, 4.0], [-1e200, 5.0]])
    tree = topk.BallTree(rows, np.arange(4), 1)
    best = topk.search_shard(tree, np.array([[0.0, 1.0]]), np.array([9]), np.array([-np.inf]), 2)
    assert best.id.tolist() == [3, 2]


def test_moved_rows_are_the_vectors_and_the_kept_pairs(spark, scratch):
    points = clustered_rows(24, 60)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    index = topk.Search(df, 5, scratch, shard_rows=30, pivots=64)
    queries = df.where("id % 10 = 0")
    home = scratch.stage(index.at_home(queries), "home")
    first = scratch.stage(index.search(home), "first")
    pairs = scratch.stage(index.elsewhere(home, first), "pairs")
    shards = int(index.cells.first[-1])
    assert index.shards.count() == len(points)
    assert home.count() == queries.count()
    # Most shards cannot reach the kth score; each pair is there once.
    assert pairs.count() == pairs.select("id", "shard").distinct().count()
    assert pairs.count() < queries.count() * shards / 4
    # Every vector enters a search once, however many queries there are.
    plan = index.search(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_a_cell_of_most_rows_is_split(spark, scratch):
    rows = [(i, [1.0, 1.0]) for i in range(400)] + [(400 + i, [float(i), -1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    index = topk.Search(df, 5, scratch, shard_rows=50)
    sizes = [r["count"] for r in index.shards.groupBy("shard").count().collect()]
    assert sum(sizes) == 420 and max(sizes) < 100
