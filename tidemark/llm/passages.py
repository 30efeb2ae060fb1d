"""Passages that stand in several documents, wherever they begin: every run of so many words.

Each run of ``length`` words (a window) is filed under the smallest hash of the runs of ``GRAM`` words in it, which
is the same wherever it stands.  Neighbouring windows mostly have the same one and make a stretch.  Only stretches
of keys that several documents have are looked at.  Equal ones are one row of the table of stretches, and where a key
has different ones, the windows of one of each are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored
from tidemark.llm.text import lists, mix, polynomial, slices, words

#: Words of a run that a window is filed under.
GRAM = 8
_STRETCHES = "doc_id long, print long, key long, whole long, at long, n long, windows array<long>"


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int):
    """(windows, row, key, first window, windows of it) of the stretches of every row; windows by their first word."""
    found = words(data, offsets)
    n = len(found.hash) - length + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none.view(np.uint64), none, none.view(np.uint64), none, none, none
    gram = min(GRAM, length)
    low, width, wanted = mix(polynomial(found.hash, gram)), 1, length - gram + 1
    while 2 * width <= wanted:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    low = np.minimum(low[:n], low[wanted - width:])
    whole = found.row[:n] == found.row[length - 1:]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (found.row[1:n] != found.row[:n - 1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    ends = np.append(np.flatnonzero(new | ~whole), n)
    size = ends[np.searchsorted(ends, first, "right")] - first
    begin = np.searchsorted(found.row, np.arange(len(offsets) - 1))
    row = found.row[first]
    return mix(polynomial(found.hash, length)), row, low[first], first, size, begin[row]


def _keys(length: int):
    """(doc_id, text) to the keys of its stretches."""

    def keys(batches):
        for batch in batches:
            for first, data, offsets in slices(batch.column(1)):
                _, row, key, *_ = _stretches(data, offsets, length)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + row)), pa.array(key.view(np.int64))], names=["doc_id", "key"])

    return keys


def _looked_at(length: int):
    """(doc_id, text, print, keys) to ``_STRETCHES`` of these keys; ``at`` counts the words before."""

    def look(batches):
        for batch in batches:
            for first, data, offsets in slices(batch.column(1)):
                windows, row, key, start, size, begin = _stretches(data, offsets, length)
                asked = batch.column(3).slice(first, len(offsets) - 1)
                of = np.repeat(np.arange(len(asked), dtype=np.uint64), [len(x) for x in asked])
                asked = np.array(asked.flatten()).view(np.uint64)
                # what is taken besides does no harm
                some = np.isin(mix(key + mix(row.astype(np.uint64))), mix(asked + mix(of)))
                row, key, start, size, begin = row[some], key[some], start[some], size[some], begin[some]
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                held = windows[np.repeat(start, size) + step]
                print_ = np.add.reduceat(mix(held + mix(step.astype(np.uint64))), np.cumsum(size) - size) if len(size) else held
                at = pa.array(first + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array(key.view(np.int64)), pa.array(print_.view(np.int64)),
                     pa.array(start - begin), pa.array(size), lists(held.view(np.int64), size, pa.int64())],
                    names=[field.split()[0] for field in _STRETCHES.split(", ")],
                )

    return look


def elsewhere(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, print, passages): by document (``print`` is its text's xxhash64), runs of words that stand in one of smaller id too.

    A passage is (at, n, which): after ``at`` words, ``n`` windows of ``length`` words, of which those numbered ``which`` (null: all).
    ``docs`` has doc_id and text, neither null.  Words are compared with A-Z in lower case, by 64-bit hashes of
    themselves and of the runs they are filed under.
    """
    pairs = stored(docs.select("doc_id", "text").mapInArrow(_keys(length), "doc_id long, key long"), "keys")
    several = pairs.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high")
    several = stored(several.select("key"), "several")
    wanted = stored(pairs.join(several, "key").groupBy("doc_id").agg(F.collect_set("key").alias("keys")), "wanted")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("print")).join(wanted, "doc_id")
    found = stored(texts.select("doc_id", "text", "print", "keys").mapInArrow(_looked_at(length), _STRETCHES), "stretches")

    classes = found.groupBy("key", "whole").agg(F.min(F.struct("doc_id", "windows")).alias("f"))
    classes = stored(classes.select("key", "whole", F.col("f.doc_id").alias("first"), "f.windows"), "classes")
    unlike = stored(classes.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "unlike")
    windows = classes.join(unlike, "key").select("key", "whole", "first", F.posexplode("windows").alias("place", "window"))
    windows = stored(windows, "windows")
    earliest = stored(windows.groupBy("key", "window").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low < high"), "earliest")
    shared = windows.join(earliest, ["key", "window"]).where("low < first")
    shared = stored(shared.groupBy("key", "whole").agg(F.collect_set("place").alias("which")), "shared")
    fates = stored(classes.select("key", "whole", "first").join(shared, ["key", "whole"], "left"), "fates")
    gone = found.drop("windows").join(fates, ["key", "whole"]).where("doc_id > first or which is not null")
    which = F.when(F.col("doc_id") == F.col("first"), F.col("which"))
    gone = gone.select("doc_id", "print", F.struct("at", "n", which.alias("which")).alias("p"))
    return gone.groupBy("doc_id", "print").agg(F.collect_set("p").alias("passages"))


def byte_runs(body: bytes, passages: list, length: int) -> list[tuple[int, int]]:
    """The bytes of what ``elsewhere`` found in a text, as maximal runs from a word's start to a word's end."""
    if not passages:
        return []
    found = words(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
    gone = np.zeros(len(found.hash) + 1, np.int64)
    for p in passages:
        at = p["at"] + (np.arange(p["n"]) if p["which"] is None else np.array(p["which"]))
        np.add.at(gone, at, 1)
        np.add.at(gone, at + length, -1)
    covered = np.concatenate([[False], np.cumsum(gone) > 0])
    first, end = np.flatnonzero(covered[1:] & ~covered[:-1]), np.flatnonzero(~covered[1:] & covered[:-1])
    return list(zip(found.start[first].tolist(), found.end[end - 1].tolist()))
