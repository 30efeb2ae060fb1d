"""Near-duplicate documents and connected components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import minhash
from tidemark.llm.shared import components


def shingle_set(text, size):
    found = (text or "").encode().lower().split()
    return {tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def brute(rows, size, percent):
    """{doc_id: (n_shingles, component)} of (doc_id, text)."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    label = {d: d for d in sets}

    def find(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                a_, b_ = find(a), find(b)
                label[max(a_, b_)] = min(a_, b_)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_copies(seed, groups, copies, length, most):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(most)):
                words[rng.randrange(length)] = f"w{rng.randrange(4000)}"
            out.append(" ".join(words))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(documents, size):
    texts = near_copies(1, 12, 15, 60, 9) + ["Alpha BETA", "alpha beta", "alpha", "", None]
    got = minhash.near_duplicates(documents(texts), size, 80).collect()
    want = brute(list(enumerate(texts)), size, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_spread_group_is_compared_across_blocks(documents, monkeypatch):
    """Members that the smallest doesn't resemble, but that resemble each other, are linked."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    texts = near_copies(2, 2, 60, 70, 16)
    got = minhash.near_duplicates(documents(texts), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(list(enumerate(texts)), 2, 80)


def test_chains_link(documents):
    words = [f"w{k}" for k in range(140)]
    texts = [" ".join(words[k:k + 100]) for k in range(0, 40, 5)]  # each resembles its neighbours
    got = minhash.near_duplicates(documents(texts), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(list(enumerate(texts)), 2, 80)


def test_odd_rows(documents, odd_texts):
    got = minhash.near_duplicates(documents(odd_texts), 2, 80).collect()
    want = brute([(k, t) for k, t in enumerate(odd_texts) if t is not Ellipsis], 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    nulls = [r for r in got if r.doc_id is None]
    assert [(r.n_shingles, r.component_id, r.kept) for r in nulls] == [(0, None, True)]


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, "a b c d e"), (1, "p q r s t"), (2, "a b c d e"), (3, "p q r s t"), (3, "p q r s t")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1)]


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).collect() == []


def test_estimates_are_near_the_similarity(documents):
    texts = near_copies(3, 1, 20, 80, 12)
    sketch = minhash._sketcher(2, minhash.DOCUMENTS)
    rows = documents(texts).select("doc_id", "text").mapInArrow(sketch, minhash._SKETCH).collect()
    bits = {r.doc_id: np.array(r.bits, np.int64).view(np.uint64) for r in rows}
    for a in range(10):
        x, y = shingle_set(texts[a], 2), shingle_set(texts[a + 10], 2)
        d = bits[a] ^ bits[a + 10]
        equal = 200 - int(np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(minhash._LOW)).sum())
        estimate = (equal / 200 - 0.25) / 0.75
        assert abs(estimate - len(x & y) / len(x | y)) < 0.2


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(7, 7), (None, 3)]
    edges += [(300 + k, 301 + k) for k in range(40)]  # a path
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {n: n for e in edges for n in e if n is not None}
    for _ in label:
        for u, v in edges:
            if u is not None:
                label[u] = label[v] = min(label[u], label[v])
    linked = {n for u, v in edges if u is not None and u != v for n in (u, v)}
    assert got == {n: label[n] for n in linked}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
