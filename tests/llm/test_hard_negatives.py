"""Hard negatives against brute force, and the pruning's candidate sets against all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackside.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, key int, anchor int"


def brute(rows, positives=5, negatives=3, low=50, high=95, scale=256):
    """Every pair's score; ``rows`` of (id, vector, label)."""
    live = [(i, [math.floor(scale * float(x)) for x in v], y) for i, v, y in rows
            if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, q, label in live:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, y) for i, v, y in live if i != a)
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and -low * p <= -100 * s[0] <= -high * p]
            out += [(a, i, r, n, -p, -s) for r, (s, n, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "s", "r", 1, 2)
                                for i, v, y in rows], SCHEMA)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 50 == 0, **how).collect())


def float32(x):
    return [float(v) for v in np.asarray(x, np.float32)]


def clustered(n, seed, dims=8):
    """Vectors around a few centres, of lengths from 0.1 to 10."""
    g = np.random.default_rng(seed)
    centre = g.normal(size=(4, dims))
    v = centre[g.integers(0, 4, n)] + 0.2 * g.normal(size=(n, dims))
    v *= (10.0 ** g.uniform(-1, 1, n))[:, None]
    return [(i, float32(v[i]), int(g.integers(0, 3))) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "LEAST_ROWS", 8)
    rows = clustered(700, 1)
    assert run(spark, rows) == brute(rows)


def test_many_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_BYTES", 200)
    rows = clustered(300, 2)
    assert run(spark, rows) == brute(rows)


def test_other_counts_and_ranges(spark):
    rows = clustered(200, 3)
    how = dict(positives=2, negatives=7, low=10, high=100)
    assert run(spark, rows, **how) == brute(rows, **how)


def test_a_third_of_equal_vectors_and_ties(spark):
    g = np.random.default_rng(4)
    same = float32(g.normal(size=6))
    rows = [(i, same if i % 3 == 0 else float32(g.integers(-1, 2, 6)), 0 if i % 2 else i % 5) for i in range(400)]
    assert run(spark, rows) == brute(rows)


def test_rows_that_take_no_part_and_odd_shapes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2, 3], 1), (50, [1, 2], 1), (100, [], 1), (150, [0, 0, 0], 2), (200, None, 1), (250, [1, None], 1),
            (300, [1, nan], 1), (350, [inf, 1], 1), (400, [1, -inf], 2), (450, [1, 2], None), (None, [1, 2], 1),
            (1, [1, 1, 1], 1), (2, [0.7, 1.4, 2], 2), (3, [0.5, 1, 1.2], 2), (4, [-1, -2, -3], 1), (5, [-1, -2, -2], 2),
            (500, [-3, 1], 7), (-50, [1, 1, 2], 2)]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_count_as_often_as_they_occur(spark):
    rows = [(0, [1, 1], 1), (0, [1, 1], 1), (1, [1, 1], 1), (1, [1, 1], 1), (2, [0.6, 0.6], 2), (2, [0.6, 0.6], 2)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_no_anchor(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_columns_of_the_result(spark):
    df = spark.createDataFrame([(0, [1.0], 1, "s", "r", 1, 2)], SCHEMA)
    assert H.mine(df, F.col("vec_id") % 50 == 0).dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint")]


def test_vectors_without_exact_scores_end_the_run(spark):
    with pytest.raises(Exception, match="too long for exact scores"):
        run(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)])


def test_pruning_keeps_every_row_that_can_score(spark):
    g = np.random.default_rng(5)
    rows = np.floor(256 * g.normal(size=(500, 6)) * (1 + 0.1 * g.random((500, 1))))
    q = np.floor(256 * g.normal(size=(40, 6)))
    anchors = H.Anchors(np.arange(40), np.arange(40), ["a"] * 40, q)
    bucket = H.Bucket(np.arange(500), np.zeros(500, np.int64), rows)
    scores = q @ bucket.rows.T
    pruned = 0
    for share in (-0.5, 0, 0.3, 0.8, 0.95, 0.999):
        least = share * anchors.length * bucket.top
        seen = np.zeros(scores.shape, bool)
        for which, cols in H.feasible(bucket, anchors, np.arange(40), least):
            seen[np.ix_(which, np.arange(500) if cols is None else cols)] = True
            pruned += cols is not None
        assert seen[scores >= least[:, None]].all()
        if share >= 0.95:
            assert seen.mean() < 0.2
    assert pruned > 50
