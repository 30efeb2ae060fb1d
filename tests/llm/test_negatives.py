"""Hard negatives against all products."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row long, name string, need double"


def brute(rows):
    kept, seen = [], set()
    for vec, v, label in rows:
        if None in (vec, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec % 7 == 0 else label
        row = (vec, tuple(math.floor(256 * x) for x in v), label)
        if row not in seen:
            seen.add(row)
            kept.append(row)
    out = []
    for a, x, label in kept:
        if a % 50:
            continue
        others = [(-sum(p * q for p, q in zip(x, y)), b, other) for b, y, other in kept if len(x) == len(y)]
        for score, p, _ in sorted(o for o in others if o[2] == label and o[1] != a)[:5]:
            fits = sorted(o for o in others if o[2] != label and -50 * score <= -100 * o[0] <= -95 * score)
            out += [(a, p, k + 1, b, -score, -s) for k, (s, b, _) in enumerate(fits[:3])]
    return sorted(out)


def check(spark, rows):
    got = negatives.mine(spark.createDataFrame([(*r, 1, "n", 0.5) for r in rows], SCHEMA))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def some(seed, n, dimension, clusters, spread, longest=3.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dimension))
    mine = rng.integers(0, clusters, n)
    values = (centres[mine] + spread * rng.normal(size=(n, dimension))) * rng.uniform(0.1, longest, (n, 1))
    ids = rng.permutation(5 * n)[:n]
    ids[: n // 10] = np.arange(n // 10) * 50
    ids = list(dict.fromkeys(ids.tolist()))
    return [(k, [float(x) for x in v], int(c) % 10) for k, v, c in zip(ids, values, mine)]


@pytest.mark.parametrize(("block", "dimension", "clusters", "spread"), [(2048, 8, 30, 0.3), (16, 8, 12, 0.3), (10, 3, 20, 1.0), (25, 16, 4, 0.05)])
def test_equals_all_products(spark, monkeypatch, block, dimension, clusters, spread):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", 5)
    check(spark, some(block, 300, dimension, clusters, spread))


def test_a_hot_label_and_copies(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 20)
    rows = some(1, 150, 6, 10, 0.3)
    rows += [(10_000 + k, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0], 1) for k in range(80)]
    rows += [(20_000 + k, [0.5, 1.5, 2.0, 0.0, 0.0, 1.0], k % 9) for k in range(60)]
    check(spark, rows + rows[:40])


def test_many_labels_share_slots(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 30)
    check(spark, [(k, v, 100 + k % 61) for k, v, _ in some(8, 250, 5, 9, 0.2)])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    check(spark, [
        (0, [1.0, 2.0], 1), (50, [1.0, 2.0], 2), (1, [2.0, 1.0], 2), (2, None, 2), (3, [1.0, None], 2), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2),
        (6, [1.0, 2.0], None), (None, [1.0, 2.0], 2), (8, [0.0, 0.0], 2), (9, [0.0, 0.0], 1), (100, [0.0, 0.0], 1), (10, [1.0], 2), (11, [-1.0, -2.0], 2),
        (12, [0.7, 1.3], 1), (12, [0.7, 1.3], 1), (12, [0.6, 1.5], 1), (50, [0.9, 1.0], 3), (13, [], 2), (150, [], 2), (15, [], 2), (16, [], 1), (17, [1.0, 1.0], 2),
        (200, [1e6, 1e6], 4), (201, [1e7, 1e6], 4), (202, [1e6, 5e6], 5), (-50, [1.0, 1.5], 2), (7, [0.8, 1.9], 0),
    ])
    check(spark, [])
    check(spark, [(1, None, 0), (None, None, None)])


def test_large_components_have_exact_products():
    big = np.array([[1 << 40, 3], [-(1 << 40), 1]], np.int64)
    assert negatives.products(np.array([[1 << 20, 5]], np.int64), big).tolist() == [[(1 << 60) + 15], [5 - (1 << 60)]]
    assert negatives.products(big, big).tolist() == [[(1 << 63) - 1, -(1 << 63)], [-(1 << 63), (1 << 63) - 1]]


def test_coordinates_prune_without_loss():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    values = centres[rng.integers(0, 12, 600)] + 0.05 * rng.normal(size=(600, 6))
    values = (400 * values / negatives.lengths(values)[:, None]).astype(np.int64)  # a bucket of nearly equal lengths
    orders = np.argsort(negatives.Block.units(values), axis=0, kind="stable").T
    block = negatives.Block(np.arange(600), np.arange(600), np.zeros(600, int), values, float(negatives.lengths(values).max()), orders)
    looked = 0
    for vector in values[:50]:
        scores = values @ vector
        least = int(np.sort(scores)[-20])
        found = block.feasible(vector, least)
        looked += 600 if found is None else len(found)
        assert found is None or set(np.flatnonzero(scores >= least)) <= set(found.tolist())
    assert looked < 50 * 200
