"""Repeated byte strings and repeated paragraphs against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.test_near_documents import shingle_set
from tidemark.llm import paragraphs, passages, queries, suffixes


def brute_bytes(rows, length):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)}, rows in the order of their ids."""
    seen, out = {}, {}
    for d, t in rows:
        body = (t or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for p in range(len(body) - length + 1):
            s = body[p:p + length]
            if seen.setdefault(s, (d, p)) != (d, p):
                gone[p:p + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out[d] = (len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def shared_passages(seed, n, alphabet=6):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdefgh ijé"[:alphabet + 5]) for _ in range(rng.randrange(5, 200))) for _ in range(5)]
    fresh = lambda: "".join(chr(97 + rng.randrange(26)) for _ in range(rng.randrange(0, 90)))
    return ["".join(rng.choice([fresh(), rng.choice(passages), rng.choice(passages)[rng.randrange(5):]]) for _ in range(rng.randrange(6))) for _ in range(n)]


def digests(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize(("length", "block"), [(100, 2048), (30, 2048), (30, 2)])
def test_bytes_equal_brute_force(documents, monkeypatch, length, block):
    monkeypatch.setattr(suffixes, "BLOCK", block)  # a block of two deals most grams over several tasks
    texts = shared_passages(length + block, 60) + ["ab" * 200, "z" * 300, "z" * 120]
    assert digests(suffixes.digest(documents(texts), length)) == brute_bytes(enumerate(texts), length)


def test_odd_texts_bytes(documents, odd_texts):
    got = digests(suffixes.digest(documents(odd_texts)))
    empty = hashlib.sha256(b"").hexdigest()
    assert got.pop(None) == (0, 0, 0, empty)
    assert got == brute_bytes([(k, t) for k, t in enumerate(odd_texts) if t is not Ellipsis], 100)
    assert suffixes.digest(documents([])).collect() == []


def test_rows_of_one_id_are_no_repeats(spark):
    text = "".join(chr(97 + k * 7 % 26) for k in range(150))
    rows = [(1, text), (1, text), (2, text), (None, text)]
    got = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = next(iter(brute_bytes([(1, text)], 100).values()))[1]
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, gone), (1, gone), (2, 150)]
    assert [bytes(r.kept) for r in got if r.doc_id == 2] == [b""]


def test_suffix_order_and_collisions(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    at = rng.permutation(350)[:90]
    segment = np.sort(rng.integers(0, 4, 90))
    order = suffixes.Suffixes(data, 20).merge_sort(at, segment)
    for s in range(4):
        texts = [data[p:p + 20].tobytes() for p in at[order][segment == s]]
        assert texts == sorted(texts)
    # hashes that always agree: the bytes decide
    monkeypatch.setattr(suffixes.Prefixes, "of", lambda self, start, end: np.zeros(len(start), np.uint64))
    group = np.zeros(90, np.int64)
    classes = suffixes.repeats(group, group, at, data, 20)
    texts = [data[p:p + 20].tobytes() for p in at]
    assert all((classes[i] == classes[j]) == (texts[i] == texts[j]) for i in range(90) for j in range(90))


def brute_paragraphs(rows, size, percent, least):
    """{doc_id: text left}."""
    lines = []
    for d, t in rows:
        lo = 0
        for line in (t or "").encode().split(b"\n"):
            hi = min(lo + len(line) + 1, len((t or "").encode()))
            if len(line.split()) >= least:
                lines.append((d, lo, hi, shingle_set(line.decode(), size), tuple(line.lower().split())))
            lo = hi
    label = list(range(len(lines)))
    for i, a in enumerate(lines):
        for j in range(i):
            both = len(a[3] & lines[j][3])
            if 100 * both >= percent * (len(a[3]) + len(lines[j][3]) - both):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    out = {d: (t or "").encode() for d, t in rows}
    for k in reversed(range(len(lines))):
        if label[k] != k:
            d, lo, hi = lines[k][:3]
            out[d] = out[d][:lo] + out[d][hi:]
    return {d: b.decode() for d, b in out.items()}


def paragraph_texts(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(900)}" for _ in range(rng.randrange(3, 60))] for _ in range(12)]

    def line():
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(900)}"
        return " ".join(words)

    return ["\n".join(line() for _ in range(rng.randrange(5))) + rng.choice(["", "\n"]) for _ in range(40)]


def test_paragraphs_equal_brute_force(documents):
    texts = paragraph_texts(1)
    got = {r.doc_id: r.kept for r in paragraphs.without_repeats(documents(texts), least=5).collect()}
    assert got == brute_paragraphs(list(enumerate(texts)), 5, 80, 5)


def test_odd_texts_paragraphs(documents, odd_texts):
    got = {r.doc_id: r.kept for r in paragraphs.without_repeats(documents(odd_texts), least=5).collect()}
    assert got.pop(None) == ""
    assert got == brute_paragraphs([(k, t) for k, t in enumerate(odd_texts) if t is not Ellipsis], 5, 80, 5)
    assert paragraphs.digest(documents([])).collect() == []


def test_short_lines_take_part(documents, odd_texts, spark, tmp_path):
    """Lines of one to four words go as their copies do, also through the query."""
    texts = paragraph_texts(2) + ["All rights reserved.\nx", "b\nall  Rights reserved.\n\nall rights", "日本語の行です。\nb b\n", "日本語の行です。\nb b b b b b\nb b b b b"] + odd_texts[4:]
    got = {r.doc_id: r.kept for r in paragraphs.without_repeats(documents(texts), least=1).collect()}
    assert got == brute_paragraphs(list(enumerate(texts)), 5, 80, 1)
    assert got[41] == "b\n\nall rights" and got[43] == "b b b b b b\n"
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.kept_sha256 for r in queries.op7_substring_dedup(spark, str(tmp_path)).collect()}
    assert found == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in got.items()}


def brute_passages(rows, length):
    """{doc_id: (n_passages, passage_bytes)}, and the bytes that go."""
    texts = [(d, (t or "").encode()) for d, t in rows if d is not None]
    spots = [(d, b, [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)]) for d, b in texts]
    first, out = {}, {}
    for d, b, w in spots:
        for k in range(len(w) - length + 1):
            run = tuple(b[lo:hi].lower() for lo, hi in w[k:k + length])
            first[run] = min(d, first.get(run, d))
    for d, b, w in spots:
        gone = np.zeros(len(w) + 1, bool)
        for k in range(len(w) - length + 1):
            if first[tuple(b[lo:hi].lower() for lo, hi in w[k:k + length])] < d:
                gone[k:k + length] = True
        starts = [k for k in range(len(w)) if gone[k] and not (k and gone[k - 1])]
        ends = [k for k in range(len(w)) if gone[k] and not gone[k + 1]]
        out.setdefault(d, []).append((len(starts), sum(w[e][1] - w[s][0] for s, e in zip(starts, ends))))
    return out


@pytest.mark.parametrize(("length", "gram"), [(50, 8), (12, 8), (6, 8), (12, 2)])
def test_passages_inside_lines(documents, monkeypatch, length, gram, odd_texts):
    """A passage that other documents have goes wherever it begins, and nothing is a passage that none has."""
    monkeypatch.setattr(passages, "GRAM", gram)
    rng = random.Random(length + gram)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = [fresh(rng.randrange(length - 2, 3 * length)) for _ in range(6)] + [["und"] * 3 * length, ["a", "B", "c"] * length]
    texts = []
    for _ in range(40):
        parts = [fresh(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(shared)
            parts += [passage[rng.randrange(3):len(passage) - rng.randrange(3)], fresh(rng.randrange(0, 90))]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n", "  "]) for w in sum(parts, [])).title() if rng.random() < 0.2 else " ".join(sum(parts, [])))
    texts += odd_texts
    got = {}
    for r in paragraphs.without_repeats(documents(texts), length=length).collect():
        if r.doc_id is not None:
            got.setdefault(r.doc_id, []).append((r.n_passages, r.passage_bytes))
            if r.n_passages:
                assert r.bytes_removed >= r.passage_bytes
    assert got == brute_passages([(k, t) for k, t in enumerate(texts) if t is not Ellipsis], length)
    assert sum(n for x in got.values() for n, _ in x) > 10


def test_passage_in_a_long_line_goes(documents, spark):
    """Too little of a line for it to be a near copy: before, the whole line stayed."""
    rng = random.Random(3)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, a, b, c = fresh(60), fresh(200), fresh(150), fresh(150)
    texts = [" ".join(a + passage + fresh(9)), " ".join(b + passage + c), " ".join(fresh(300))]
    got = {r.doc_id: r for r in paragraphs.without_repeats(documents(texts)).collect()}
    assert got[1].kept.split() == b + c and got[0].kept == texts[0] and got[2].kept == texts[2]
    assert (got[1].n_passages, got[1].n_removed, got[1].bytes_removed) == (1, 0, len(" ".join(passage)))
    # rows of one id are one document, each with its own text
    rows = [(5, texts[1]), (5, "x " + texts[1]), (4, texts[0])]
    kept = paragraphs.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.kept.split()[0] for r in kept if r.doc_id == 5) == sorted([b[0], "x"])
    assert all([w for w in r.kept.split() if w != "x"] == b + c for r in kept if r.doc_id == 5)


def test_bands_are_tuned():
    for recall in (0.9, 0.999, 0.9999):
        scheme = paragraphs.tuned(80, recall)
        assert scheme.missed(0.8) <= 1 - recall < scheme._replace(bands=scheme.bands - 1).missed(0.8)
