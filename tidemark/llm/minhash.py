"""Near-duplicate documents by b-bit MinHash.

Every document's word shingles give a number of minima.  Bands of minima propose candidates; of
each minimum only the two lowest bits are kept, packed into 64-bit words, and two signatures are
compared by counting the bits in which they differ, corrected for the matches that chance makes.
Candidates whose estimate is not clearly too low are confirmed on the full sets of shingles.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import components, smallest, stored
from tidemark.llm.text import band_keys, distinct, lists, minima, mix, shingles, slices, words

BITS = 2
#: Candidates go on unless their estimate is five standard deviations below the threshold.
DEVIATIONS = 5
#: Members of a bucket that are compared with each other in one task.
BLOCK = 1024
SEED = 8
_LOW = 0x5555555555555555


class Scheme(NamedTuple):
    """``bands`` of ``rows`` minima propose candidates; ``total`` minima are kept as two bits each."""

    bands: int
    rows: int
    total: int

    @property
    def words(self) -> int:
        return math.ceil(self.total * BITS / 64)

    def missed(self, similarity: float) -> float:
        """The chance that a pair of this similarity shares no band."""
        return (1 - similarity**self.rows) ** self.bands

    def lowest(self, percent: int) -> int:
        """The fewest equal two-bit values, of all, at which a pair is still looked at."""
        chance = 0.5**BITS
        match = percent / 100 * (1 - chance) + chance
        return math.floor(self.total * match - DEVIATIONS * math.sqrt(self.total * match * (1 - match)))


#: Misses 1 pair of 8 million at a similarity of 0.8.
DOCUMENTS = Scheme(40, 5, 200)

_SKETCH = "doc_id long, n_shingles long, s1 long, s2 long, bits array<long>, keys array<long>"


def packed(lows: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The lowest two bits of every minimum (after mixing), 32 to a signed 64-bit word."""
    low = mix(lows) & np.uint64(3)
    low = np.pad(low, ((0, 0), (0, scheme.words * 32 - low.shape[1])))
    shift = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low.reshape(len(low), scheme.words, 32) << shift, axis=2).view(np.int64)


def _sketcher(size: int, scheme: Scheme):
    def sketch(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in slices(batch.column(1)):
                n = len(offsets) - 1
                rows, hashes = distinct(*shingles(words(data, offsets), n, size))
                count = np.bincount(rows, minlength=n)
                full = np.flatnonzero(count)
                starts = (np.cumsum(count) - count)[full]
                sums = np.zeros((2, n), np.int64)
                lows = np.empty((0, scheme.total), np.uint64)
                if len(full):
                    sums[0, full] = np.add.reduceat(mix(hashes), starts).view(np.int64)
                    sums[1, full] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts).view(np.int64)
                    lows = minima(hashes, starts, scheme.total, SEED)
                has = (count > 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, n),
                        pa.array(count.astype(np.int64)),
                        pa.array(sums[0]),
                        pa.array(sums[1]),
                        lists(packed(lows, scheme).ravel(), has * scheme.words, pa.int64()),
                        lists(band_keys(lows, scheme.bands, scheme.rows).ravel(), has * scheme.bands, pa.int64()),
                    ],
                    names=["doc_id", "n_shingles", "s1", "s2", "bits", "keys"],
                )

    return sketch


def equal_values(left: str, right: str, scheme: Scheme):
    """Equal two-bit values of two packed signatures, by counting the bits that differ."""
    differ = F.zip_with(left, right, lambda x, y: x.bitwiseXOR(y))
    counts = F.transform(differ, lambda d: F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(_LOW))))
    unequal = F.aggregate(counts, F.lit(0), lambda total, c: total + c)
    return F.lit(scheme.total) - unequal


def similarity(left: str, right: str, scheme: Scheme = DOCUMENTS):
    """The collision-corrected estimate of the Jaccard similarity of two packed signatures."""
    chance = 0.5**BITS
    return (equal_values(left, right, scheme) / F.lit(float(scheme.total)) - chance) / (1 - chance)


def _confirmer(size: int, percent: int):
    def shingle_set(text):
        found = text.encode().lower().split()
        return {tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()

    def confirm(batches):
        last, held = None, set()
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            columns = [batch.column(k).to_pylist() for k in range(2, 4)]
            for k, (one, other) in enumerate(zip(*columns)):
                if one != last:
                    last, held = one, shingle_set(one)
                sets = shingle_set(other)
                both = len(held & sets)
                keep[k] = both and 100 * both >= percent * (len(held) + len(sets) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return confirm


def confirmed(pairs: DataFrame, text: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose ``text`` (doc_id, text) has similar full shingle sets.

    The texts meet in two joins from one shuffle of them, in which Spark can split a hot key.
    """
    with_b = pairs.join(text, F.col("b") == F.col("doc_id")).select("a", "b", F.col("text").alias("text_b"))
    both = with_b.join(text, F.col("a") == F.col("doc_id")).select("a", "b", "text", "text_b")
    return both.mapInArrow(_confirmer(size, percent), "a long, b long")


def _alike(scheme: Scheme, lowest: int):
    """(u, v): components of a bucket's blocks that hold a pair whose estimate is high enough, chained."""

    def compare(table):
        side, group = np.array(table.column("side")), np.array(table.column("component"))
        bits = np.array(table.column("bits").combine_chunks().flatten()).reshape(-1, scheme.words).view(np.uint64)
        left, right = np.flatnonzero(side < 2), np.flatnonzero(side > 0)
        names, group = np.unique(group, return_inverse=True)
        found = [np.zeros((0, 2), np.int64)]
        for at in range(0, len(left), 64):
            some = left[at:at + 64]
            x = bits[some][:, None, :] ^ bits[right][None, :, :]
            unequal = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_LOW)).sum(axis=2, dtype=np.int32)
            i, j = np.nonzero((scheme.total - unequal >= lowest) & (group[some][:, None] != group[right][None, :]))
            found.append(np.unique(np.stack([group[some[i]], group[right[j]]], 1), axis=0))
        label = smallest(np.concatenate(found), len(names))
        chained = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"u": names[chained], "v": names[label[chained]]})

    return compare


def _set_maker(size: int):
    """(doc_id, text) to (doc_id, the hashes of its shingles)."""

    def make(batches):
        for batch in batches:
            for first, data, offsets in slices(batch.column(1)):
                n = len(offsets) - 1
                rows, hashes = distinct(*shingles(words(data, offsets), n, size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), lists(hashes.view(np.int64), np.bincount(rows, minlength=n), pa.int64())],
                    names=["doc_id", "shingles"],
                )

    return make


def _across(percent: int):
    """Links between components of two blocks, by exact counts of shared shingles; enough of them to join what links."""

    def compare(table):
        side, node = np.array(table.column("side")), np.array(table.column("doc_id"))
        names, group = np.unique(np.array(table.column("component")), return_inverse=True)
        column = table.column("shingles").combine_chunks()
        ends = np.array(column.offsets).astype(np.int64)
        held = np.array(column.values)
        size = np.diff(ends)
        main = np.bincount(group).argmax()  # most are of one component, and need no comparing among themselves
        left, right = np.flatnonzero(side < 2), np.flatnonzero(side > 0)
        found = []
        for ones, others in ((left[group[left] != main], right), (right[group[right] != main], left[group[left] == main])):
            if not len(ones) or not len(others):
                continue
            owner = np.repeat(np.arange(len(others)), size[others])
            values = np.concatenate([held[ends[k]:ends[k + 1]] for k in others])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for k in ones:
                mine = held[ends[k]:ends[k + 1]]
                lo, hi = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
                run = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange(int((hi - lo).sum()))
                both = np.bincount(owner[run], minlength=len(others))
                hit = (100 * both >= percent * (size[k] + size[others] - both)) & (group[others] != group[k])
                _, some = np.unique(group[others[hit]], return_index=True)  # one link to each component
                found += [(node[k], node[j]) for j in others[hit][some]]
        found = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"u": found[:, 0], "v": found[:, 1]})

    return compare


def _in_blocks(rows: DataFrame, by: str, *columns: str) -> DataFrame:
    """``rows`` dealt to pairs of blocks (by, x, y) of bounded size; ``side`` is 0 or 2 in different blocks, 1 in one."""
    sizes = rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(stored(sizes, "blocks"), by)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        by, F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        F.expr("case when block = other then 1 when block < other then 0 else 2 end").alias("side"), *columns,
    )


def links(reps: DataFrame, scheme: Scheme, size: int, percent: int, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (u, v) that connect every two similar ones of ``reps`` (doc_id, n_shingles, bits, keys).

    A bucket's documents are first compared with its smallest one, which joins most of them.  Where a
    bucket still holds several components, those with a pair of high enough estimate form a cluster, and
    only in clusters are documents of different components compared, on their full sets and in blocks.
    ``texts_of`` gives the texts (doc_id, text) of at least the documents (doc_id) asked for.
    """
    lowest = scheme.lowest(percent)
    banded = reps.select("doc_id", F.explode("keys").alias("key"))
    pivots = banded.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count(F.lit(1)).alias("members"))
    pivots = stored(pivots.where("members > 1"), "pivots")
    members = stored(banded.join(pivots, "key"), "buckets")
    signed = reps.select("doc_id", "n_shingles", "bits")
    pairs = members.where("pivot <> doc_id").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    pairs = pairs.join(signed.toDF("b", "n_b", "bits_b"), "b").join(signed.toDF("a", "n_a", "bits_a"), "a")
    fits = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    pairs = stored(pairs.where(fits & (equal_values("bits_a", "bits_b", scheme) >= lowest)).select("a", "b"), "candidates")
    asked = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    found = stored(confirmed(pairs, texts_of(asked), size, percent).toDF("u", "v").distinct(), "links")

    group = components(found).withColumnRenamed("node", "doc_id")
    named = members.where("members > 2").select("key", "doc_id").join(group, "doc_id", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "doc_id")), "named")
    open_ = named.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    named = named.join(stored(open_.where("least <> most").select("key"), "open"), "key")
    named = stored(named.join(signed.select("doc_id", "bits"), "doc_id"), "named")
    alike = _in_blocks(named, "key", "component", "bits").groupBy("key", "x", "y")
    cluster = components(alike.applyInArrow(_alike(scheme, lowest), "u long, v long"))
    cluster = cluster.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    asked = named.select("doc_id", "component").distinct().join(cluster, "component")
    asked = stored(asked, "asked")
    if asked.isEmpty():  # spares a shuffle of the texts
        return found
    sets = texts_of(asked.select("doc_id")).join(asked, "doc_id").select("doc_id", "text")
    sets = sets.mapInArrow(_set_maker(size), "doc_id long, shingles array<long>")
    blocks = _in_blocks(stored(asked.join(sets, "doc_id"), "sets"), "cluster", "doc_id", "component", "shingles")
    more = blocks.groupBy("cluster", "x", "y").applyInArrow(_across(percent), "u long, v long")
    return found.union(stored(more, "links"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    Words are ``[^ \\t-\\r]+`` with A-Z in lower case; a document's set is its distinct ``size``-word
    shingles, or its whole sequence of words where it has fewer.  Two documents link when 100 times
    their intersection is at least ``percent`` times their union.

    * Null, empty or blank text: an empty set, linked with nothing, kept.
    * Null doc_id: ``n_shingles`` is counted, it links with nothing, component null, kept.
    * Rows that repeat a doc_id are one document; it links if any of its texts does.
    * Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stored(docs.mapInArrow(_sketcher(size, DOCUMENTS), _SKETCH), "sketch")
    known = sketch.where("doc_id is not null and n_shingles > 0")
    alike = ["n_shingles", "s1", "s2"]
    classes = known.groupBy(*alike).agg(
        F.min(F.struct("doc_id", "bits", "keys")).alias("rep"), F.count(F.lit(1)).alias("copies")
    ).select(*alike, "rep.*", "copies")
    classes = stored(classes, "classes")
    text = docs.where("text is not null")
    found = links(classes, DOCUMENTS, size, percent, lambda _: text)
    # rows of one doc_id with different texts, and copies, connect through their classes
    same = known.join(classes.where("copies > 1").select(*alike, F.col("doc_id").alias("rep")), alike)
    same = same.select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    group = components(found.union(same))
    out = sketch.select("doc_id", "n_shingles").join(group.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)
), pair AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT reach.u, pair.v FROM reach JOIN pair ON pair.u = reach.v
), least AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""
