"""Near-duplicate embeddings against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import covertree


def brute(rows, cosine):
    """[(vec_id, n_links, component)] of (vec_id, vector), rows in order."""
    sound = [
        d is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for d, v in rows
    ]
    label, links = {d: d for d, _ in rows if d is not None}, [0] * len(rows)

    def find(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, (a, x) in enumerate(rows):
        for j, (b, y) in enumerate(rows):
            if i != j and sound[i] and sound[j] and len(x) == len(y):
                x_, y_ = np.array(x) / np.max(np.abs(x)), np.array(y) / np.max(np.abs(y))
                if x_ @ y_ / np.sqrt((x_ @ x_) * (y_ @ y_)) >= cosine:
                    links[i] += 1
                    low, high = sorted((find(a), find(b)))
                    label[high] = low
    return sorted((d if d is not None else -1, n, find(d) if d is not None else None) for (d, _), n in zip(rows, links))


def check(spark, rows, cosine=0.95):
    got = covertree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine).collect()
    want = brute([r[:2] for r in rows], cosine)
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def clustered(seed, n, dimension, clusters, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dimension))
    vectors = centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dimension))
    return [(int(k), [float(x) for x in v], 0) for k, v in zip(rng.permutation(n), vectors * rng.uniform(0.1, 9, (n, 1)))]


@pytest.mark.parametrize(("block", "dimension", "spread"), [(4096, 8, 0.2), (16, 8, 0.2), (16, 3, 0.1), (30, 16, 0.02)])
def test_equals_brute_force(spark, monkeypatch, block, dimension, spread):
    monkeypatch.setattr(covertree, "BLOCK", block)
    check(spark, clustered(block + dimension, 220, dimension, 9, spread))


def test_a_hot_vector_and_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 25)
    rows = clustered(5, 60, 6, 5, 0.3)
    rows += [(100 + k, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0], 0) for k in range(40)]
    rows += [(200 + k, [1.0, 2.0, 3.0 + k / 100, 0.0, 0.0, 1.0], 0) for k in range(40)]
    check(spark, rows)


def test_every_length_is_compared(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 20)
    rows = clustered(1, 60, 5, 4, 0.1) + [(k + 1000, v, 0) for k, v, _ in clustered(2, 40, 9, 4, 0.1)]
    check(spark, [*rows, (5000, [1.0], 0), (5001, [3.0], 0), (5002, [1.0, 1.0], 0), (5003, [2.0, 2.0], 0)])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    check(spark, [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [0.0, 0.0], 0), (5, [1.0, None], 0), (6, [nan, 1.0], 0),
        (7, [inf, 1.0], 0), (8, [1.0], 0), (9, [], 0), (None, [1.0, 0.0], 0), (10, [1e300, 1e-300], 0), (11, [-1.0, 0.0], 0),
        (12, [1e-300, 1e-302], 0), (2, [0.0, 5.0], 0), (13, [0.0, 1.0], 0),
    ])
    check(spark, [(1, None, 0), (None, None, 0)])
    check(spark, [])


def test_vectors_of_blocks_are_not_dealt_to_pairs_of_them(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 8)
    monkeypatch.setattr(covertree, "PARTNERS", 3)
    rows = [(k, [float(np.float32(x)) for x in v], 0) for k, v, _ in clustered(3, 150, 6, 8, 0.15)]
    rows += [(500, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0], 0), (501, [-0.0, 2.0, -0.0, 0.0, 0.0, 0.0], 0), (502, [-0.0, 1.0, 0.0, 0.0, -0.0, 0.0], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = covertree.near_duplicates(vectors).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute([r[:2] for r in rows], 0.95)
    classes = vectors.selectExpr("vec_id", "1L as copies", "embedding as vector")
    plan = covertree._links(classes, 6, 0.95)._jdf.queryExecution().executedPlan().toString()
    assert "partners" in plan and "vectors" not in plan  # each was shuffled once for every block that its own met
