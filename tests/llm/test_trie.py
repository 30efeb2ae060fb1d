"""The prefix trie against one built of plain dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, ids string, depth int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rebuilt(rows):
    said = {}
    for conv, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        if conv is not None:
            said.setdefault(conv, []).append(((turn is not None, turn or 0), tie, (role, text)))
    said = {c: [t for _, _, t in sorted(ts)] for c, ts in said.items()}
    out = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = said.get(base, [])[:h] + own[h:]
    return out


def brute(rows):
    conversations, members = rebuilt(rows), {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []
    for p, ms in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in ms if len(conversations[c]) == len(p))
        out.append((
            min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(kids.get(p, [])),
            sum(q not in kids for q in below), sum((len(members[q]) - 1) * words(q) for q in below), sha(",".join(map(str, ends))),
        ))
    return out


def by_text(rows):
    return sorted(tuple(map(str, r)) for r in rows)


def check(spark, rows):
    got = trie.prefixes(spark.createDataFrame([(*r, "k", "x", 1) for r in rows], SCHEMA))
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert got.columns == names
    assert by_text(got.collect()) == by_text(brute(rows))


def some_rows(seed, convs, longest=6):
    rng = random.Random(seed)
    texts = ["hello there", "hi", "", "one two  three", "é\x0b日本 x", "a b"]
    return [
        (c, k, rng.choice(["user", "assistant"]) if k else "system", rng.choice(texts[: 2 + k]))
        for c in convs for k in range(rng.randrange(1, longest))
    ]


@pytest.mark.parametrize("shard", [200_000, 40, 7])
def test_equals_plain_dictionaries(spark, monkeypatch, shard):
    monkeypatch.setattr(trie, "SHARD", shard)
    check(spark, some_rows(shard, [*range(0, 130), *range(200_000, 200_030), -3, -41]))


def test_hot_prefixes_copies_and_a_deep_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD", 60)
    monkeypatch.setattr(trie, "ID_BLOCK", 3)
    rows = [(20 * c, k, "user", f"shared {k}") for c in range(40) for k in range(5)]
    rows += [(20 * c, 5, "user", f"own {c % 7}") for c in range(40)]
    rows += [(5000, k, "user", f"deep {k}") for k in range(300)] + [(5020, k, "user", f"deep {k}") for k in range(299)]
    check(spark, rows)


def test_odd_rows(spark):
    long = "word " * 50_000
    check(spark, [
        (None, 0, "user", "nobody's"), (20, None, None, None), (20, 1, "user", "tie"), (20, 1, "user", "eit"), (20, 1, "user", "tie"),
        (21, None, "user", ""), (25, 0, "user", "x"), (46, 0, "user", "no first"), (47, 3, "u", "ser"), (47, 3, "us", "er"), (60, 0, "user", long),
    ])
    check(spark, [])
    check(spark, [(7, 0, "user", "only one, and left out")])


def test_search_trees_are_balanced():
    tree = trie.SearchTree()
    for k in trie.medians(1023):
        assert tree.insert([k, 5], [1, 1]) == tree.insert([k, 5], [1, 1])

    def height(node):
        return 1 + max(height(tree.lo[node]), height(tree.hi[node])) if node else 0

    assert height(tree.eq[0]) == 10 and len(tree.ids) == 1 + 2 * 1023
    assert sorted(trie.medians(37)) == list(range(37))


def test_lists_of_members_pass_in_order(spark):
    rows = spark.range(300).select(F.col("id").alias("conv_id"), F.array(F.col("id") % 2).alias("ids"), F.array(F.lit(3)).alias("words"))
    got = {r.depth: r for r in trie.trie(rows.select("conv_id", "ids", F.col("words").cast("array<long>").alias("words"))).where("conv_id = 0").collect()}
    assert got[1].ends_sha256 == sha(",".join(str(k) for k in range(0, 300, 2))) and got[0].n_convs == 300
    assert got[0].saved_tokens == 2 * 149 * 3
