"""The corpus pipeline, stage by stage."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest
import sentencepiece

import corpus_pipeline
from tests.llm.test_near_documents import brute
from tidemark.llm import pieces


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """[(name, rows before, rows after)] over the documents of the smallest tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        out.append((name, docs, after))
        docs = after
    return out


def test_all_but_the_last_keep_the_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables have too few labels to learn from
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    after = corpus_pipeline.reject_toxic(spark, before, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id").collect()
    assert len(gone) > 20 and sum(r.toxic for r in gone) >= 0.9 * len(gone)
    assert sorted(after.collect()) == sorted(before.join(after.select("doc_id"), "doc_id", "left_semi").select(before.columns).collect())


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    group = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c in group.values()})


def test_texts_that_share_an_id_are_documents_of_their_own(spark, sf_dir):
    copy, other = "one two three four five six seven", "quite another text that has nothing to do with it"
    rows = [(1, copy, "a"), (1, other, "b"), (1, copy, "c"), (2, copy, "d"), (3, other + " ok", "e"), (None, copy, "f"), (4, None, "g"), (4, "", "h")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string")
        got = {tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()}
        assert got == {(1, copy, "a"), (1, other, "b"), (None, copy, "f"), (4, None, "g"), (4, "", "h")}


def test_personal_data_goes(stages):
    from tidemark.llm import pii

    _, before, after = stages[2]
    assert before.count() == after.count()
    found = {r.doc_id: r.spans for r in pii.find(before).collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert any(found.values())
    for r in after.collect():
        assert (r.text == texts[r.doc_id]) == (not found[r.doc_id])
        assert r.n_chars == len(r.text) or not found[r.doc_id]


def test_the_mix_takes_its_share(stages):
    _, before, after = stages[3]
    size = lambda df: sum(len(r.text.encode().split()) for r in df.select("text").collect() if r.text)
    assert size(after) == pytest.approx(1.5 * size(before), rel=0.05)
    assert max(r["count"] for r in after.groupBy("doc_id").count().collect()) <= 2


def test_pieces_are_the_models(stages):
    _, before, after = stages[4]
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = sorted((r.doc_id, model.encode(r.text)) for r in before.collect())
    assert sorted((r.doc_id, r.ids) for r in after.collect()) == want
    assert all(r.round_trip and len(r.samples) == 2 for r in after.collect())


def test_odd_rows(spark, sf_dir, documents, odd_texts):
    for texts in (odd_texts, []):
        docs = documents(texts)
        for name, stage in corpus_pipeline.STAGES:
            after = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
            if name != "encode":
                assert after.columns == docs.columns
            if name == "drop_near_copies" and texts:
                kept = after.collect()
                assert sum(r.doc_id is None for r in kept) == 1
                assert {0, 1, 2} <= {r.doc_id for r in kept}  # without words: linked with nothing
            docs = after
        docs.collect()


def test_little_memory_encodes_the_same():
    """The bounds of the pipeline's workers change no row, and hold."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["über", "日本", "x", "42\n"]) + str(rng.randrange(10**6)) for _ in range(rng.randrange(60))) for _ in range(1600)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    def rows(**bounds):
        encode = pieces._encoder(pieces._model(pieces.MODEL), 2, 5, **bounds)
        return [r for b in pieces._whole(encode, False)([batch]) for r in b.to_pylist()]

    def peak(**bounds):
        tracemalloc.start()
        for _ in pieces._encoder(pieces._model(pieces.MODEL), 2, 5, **bounds)([batch]):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert rows(**corpus_pipeline.LITTLE) == rows(kept=1 << 16, at_once=1 << 12, bits=8) == rows()
    assert peak(**corpus_pipeline.LITTLE) < 100 << 20 < peak(kept=pieces.KEPT // 3, at_once=pieces.AT_ONCE // 4)
