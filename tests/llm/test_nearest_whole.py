"""Nearest neighbours where fixed probes alone leave candidates out."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import ann


def brute(x, asks, k):
    out = {}
    for q in asks:
        scores = x @ x[q]
        out[q] = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-scores[i], i))[:k]
    return out


def found(spark, x, condition, k=ann.K, **options):
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(ann.search(data, condition, k, **options).collect()):
        got.setdefault(r.query_id, []).append(r.vec_id)
    return got


def unit(n, dim, seed):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("n", [15, 21])
def test_few_vectors_are_all_found(spark, n):
    x = unit(n, 64, n)
    assert found(spark, x, F.col("vec_id") >= 0) == brute(x, range(n), 20)


@pytest.mark.parametrize("norms", ["outlier", "lognormal"])
def test_uneven_norms(spark, norms):
    x = unit(2_000, 64, 5)
    if norms == "outlier":
        x[7] *= 100
    else:
        x *= np.random.default_rng(6).lognormal(sigma=1.0, size=(2_000, 1))
    want = brute(x, range(0, 2_000, 20), 20)
    got = found(spark, x, F.col("vec_id") % 20 == 0)
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(want, 20)
    assert sum(len({*want[q]} & {*got[q]}) for q in want) >= 0.95 * 20 * len(want)


def test_queries_that_meet_too_few_are_compared_with_all(spark):
    x = 0.01 * unit(600, 16, 9)
    x[:, 0] += 1
    x[::20] *= -1  # a tight group, and the queries at its far side
    want = brute(x, range(0, 600, 20), 40)
    got = found(spark, x, F.col("vec_id") % 20 == 0, k=40, index=ann.Index(tables=1, probes=1), block=64)
    assert got == want


def test_norms_beyond_doubles(spark):
    x = np.array([[1.5e308, 1.5e308], [1.5e308, -1.5e308], [5e-324, 0.0], [1.0, 2.0]])
    assert {q: sorted(v) for q, v in found(spark, x, F.col("vec_id") == 2).items()} == {2: [0, 1, 3]}
    assert ann._norm(x[0])[0] == math.inf and ann._norm(x[2])[1] == -1074


def test_ties_at_the_cut_go_to_smaller_ids(spark):
    signs = np.array(list(itertools.product([-1.0, 1.0], repeat=8)))
    x = signs[np.random.default_rng(3).permutation(256)]
    want = brute(x, range(0, 256, 4), 20)
    for block in (8_192, 64):
        assert found(spark, x, F.col("vec_id") % 4 == 0, block=block) == want


def _chosen(spark, x):
    """The setting chosen for these vectors, and the part of them that a query visits with it."""
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    seen = []
    choose = ann.choose
    ann.choose = lambda *a, **k: seen.append(choose(*a, **k)) or seen[0]
    try:
        got = {}
        for r in ann.search(data, F.col("vec_id") % 20 == 0).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
    finally:
        ann.choose = choose
    index = seen[0]
    want = brute(x, range(0, len(x), 20), 20)
    recall = sum(len({*want[q]} & got[q]) for q in want) / (20 * len(want))
    if index is None:
        return None, 1.0, recall
    names, seen = ann.buckets(x, np.linalg.norm(x, axis=1).max(), index), ann.visits(x[::20], index)
    share = np.mean([np.any([np.isin(names[:, t], v[:, t]) for t in range(index.tables)], axis=0).mean() for v in seen])
    return index, share, recall


def test_clusters_are_searched_by_few_buckets(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(100, 32))
    x = centres[rng.integers(0, 100, 6_000)] + 0.1 * rng.normal(size=(6_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index, share, recall = _chosen(spark, x)
    assert index is not None and share < 0.05 and recall >= 0.95


def test_random_vectors_keep_their_recall(spark):
    _, share, recall = _chosen(spark, unit(3_000, 48, 2))
    assert recall >= 0.95
