from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "component long, key string, spans string, u long, size int, row string, kept boolean, score double"
)


def rows_of(texts, start=0):
    """Rows of documents with further columns whose names operators use themselves."""
    return [
        (None if t is Ellipsis else start + k, None if t is Ellipsis else t, "en", f"s{k % 3}" if k % 4 else None,
         None, k, "k", "x", 1, 2, "r", True, 0.5)
        for k, t in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def documents(spark):
    def make(texts, start=0):
        return spark.createDataFrame(rows_of(texts, start), SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, repeated, tied and very long texts; Ellipsis stands for a row of nulls."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "über", "日本", "x", "42"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    para = "the quick brown fox jumps over the lazy dog again and again until the cows come home tonight"
    return [
        None, "", "   \n\t ", Ellipsis, "a", "a", "one two three four five six seven eight nine ten", para, para, para + " ok",
        long, "x" * 50_000, "1 " * 5_000, f"{para}\n{para}\n", "\n\n\n", "▁ mark▁", "🙂" * 300, "mail me@ex.org.. 1.2.3.4 +1 234 567 8901",
    ]
