"""Encoding, decoding and sampling of pieces."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tidemark.llm import pieces

MODEL = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def run(texts, k=2, seed=5, ids=None, kept=pieces.KEPT):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)) if ids is None else ids, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"]
    )
    encode = pieces._encoder(pieces._model(pieces.MODEL), k, seed, kept)
    return [(p.ids[a:b], drawn) for p in encode([batch]) for a, b, drawn in zip(p.cut[:-1], p.cut[1:], p.drawn)]


def segmentations(text):
    """{ids: log weight} of every way to cut a text into pieces."""
    vocabulary = pieces.Vocabulary(pieces._model(pieces.MODEL))
    weight = dict(zip(vocabulary.ids.tolist(), vocabulary.weight))
    names = {MODEL.id_to_piece(i).replace("▁", " "): i for i in weight}
    out = {}

    def go(rest, ids, total):
        if not rest:
            out[tuple(ids)] = total
        for n in range(1, len(rest) + 1):
            if rest[:n] in names:
                go(rest[n:], [*ids, names[rest[:n]]], total + weight[names[rest[:n]]])

    go(" " + text, [], 0.0)
    return out


def test_equals_the_model_and_round_trips(spark, documents, odd_texts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = docs.unionAll(documents(odd_texts, 10_000).select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in rows.collect()}
    for r in pieces.encoded(rows).collect():
        text = texts[r.doc_id] or ""
        assert r.ids == MODEL.encode(text)
        assert r.exact == ("▁" not in text)
        plain = text.replace("▁", " ")
        assert r.decoded == plain
        assert 1 <= len(r.samples) <= 2
        assert len({tuple(s.ids) for s in r.samples}) == len(r.samples)
        for s in r.samples:
            assert MODEL.decode(s.ids) == plain and s.n_tokens == len(s.ids) and 0 <= s.inclusion <= 1
        assert [s.value for s in r.samples] == sorted((s.value for s in r.samples), reverse=True)


def test_decoding(spark):
    rows = [(1, MODEL.encode("Hello there,  friend\n")), (2, []), (3, None)]
    got = pieces.decoded(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()
    assert [(r.doc_id, r.text) for r in got] == [(1, "Hello there,  friend\n"), (2, ""), (3, None)]


@pytest.mark.parametrize("text", ["the", "in it"])
def test_draws_are_without_replacement(text):
    """First and second draws occur as often as drawing by probability without putting back says."""
    n = 6000
    weights = segmentations(text)
    total = math.log(sum(math.exp(w) for w in weights.values()))
    prob = {s: math.exp(w - total) for s, w in weights.items()}
    firsts, seconds = Counter(), Counter()
    for _, drawn in run([text] * n):
        one, two = (tuple(e.tolist()) for e, *_ in drawn)
        assert one != two
        firsts[one] += 1
        seconds[one, two] += 1
        assert drawn[0][1] == pytest.approx(math.log(prob[one]), abs=1e-4)
    for s, p in prob.items():
        assert abs(firsts[s] / n - p) < 5 * math.sqrt(p / n) + 2e-3
    for (a, b), c in seconds.items():
        p = prob[a] * prob[b] / (1 - prob[a])
        assert abs(c / n - p) < 5 * math.sqrt(p / n) + 2e-3


def test_inclusion_scores_weigh_draws():
    """The sum of 1 / inclusion over draws estimates the number of segmentations times their weight: 1 for weights."""
    text = "the"
    weights = segmentations(text)
    total = math.log(sum(math.exp(w) for w in weights.values()))
    estimate = np.mean([
        sum(math.exp(p) / max(q, 1e-12) for _, p, _, q in drawn) for _, drawn in run([text] * 4000, k=2)
    ])
    assert estimate == pytest.approx(1.0, abs=0.05) and total < 0


def test_all_of_few_segmentations():
    weights = segmentations("a")
    (_, drawn), = run(["a"], k=40)
    assert {tuple(e.tolist()) for e, *_ in drawn} <= set(weights)
    assert len(drawn) == len(weights) and all(q == 1.0 for *_, q in drawn)


def test_samples_follow_the_row_key_alone():
    texts = ["one fine day in the woods", "another text", "one fine day in the woods", "x" * 40]
    a, b = run(texts), run(list(reversed(texts)), ids=[3, 2, 1, 0])
    plain = lambda found: [(c.tolist(), [(e.tolist(), p, v, q) for e, p, v, q in d]) for c, d in found]
    assert plain(a) == list(reversed(plain(b)))
    assert plain(a)[0][1] != plain(a)[2][1]  # another key
    assert plain(run(texts, seed=6))[0][1] != plain(a)[0][1]


def test_forgotten_lattices_change_nothing(monkeypatch):
    texts = [f"word{k} and some more of it {k * 7919}" for k in range(300)]
    whole = run(texts)
    monkeypatch.setattr(pieces, "slices", lambda column, limit: __import__("tidemark.llm.text").llm.text.slices(column, 500))
    for (a, x), (b, y) in zip(whole, run(texts, kept=350)):
        assert a.tolist() == b.tolist()
        assert [(e.tolist(), p, v, q) for e, p, v, q in x] == [(e.tolist(), p, v, q) for e, p, v, q in y]


def test_lattices_stay_within_their_bytes():
    vocabulary = pieces.Vocabulary(pieces._model(pieces.MODEL))
    lattices, most, kept = pieces.Lattices(vocabulary, 4 << 20), 0, 4 << 20
    for k in range(40):
        texts = pa.array([f"unseen{k * 997 + i:x}word other{i * 7919 + k:x}" for i in range(800)])
        for _, data, offsets in pieces.slices(texts, 1 << 20):
            spaced, _, start, end = pieces._chunks(data, offsets, vocabulary.lines)
            hashes = pieces.mix(pieces.Prefixes(spaced).of(start, end) + (end - start).astype(np.uint64))
            lattices.slots(spaced, start, end, hashes)
        held = (lattices.edge, lattices.length, lattices.piece, lattices.log_prob, lattices.total, lattices.ids, lattices.first)
        most = max(most, sum(x.nbytes for x in held))
    assert 0 < most < 2 * kept  # a slice is added before it is looked at again


def test_ids_without_the_text_again(documents):
    docs = documents(["one two", None, ""])
    with_text, without = pieces.encoded(docs), pieces.encoded(docs, text=False)
    assert without.columns == [c for c in with_text.columns if c != "decoded"]
    assert without.collect() == with_text.drop("decoded").collect()


def test_empty_table(documents):
    assert pieces.encoded(documents([])).collect() == [] and pieces.digest(documents([])).collect() == []
