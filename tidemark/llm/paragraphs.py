"""Repeated paragraphs across a corpus: MinHash bands propose pairs, exact Jaccard confirms them,
components of confirmed pairs keep their earliest paragraph.  Runs of words that other documents have go
too, wherever in lines they begin (``passages``).

A paragraph is a line.  The bands are tuned to a recall: few rows to a band, as paragraphs that have
nothing in common share no shingle of five words, and as many bands as the recall needs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import passages
from tidemark.llm.minhash import SEED, Scheme, links, packed
from tidemark.llm.shared import components, stored
from tidemark.llm.text import band_keys, distinct, lists, minima, mix, shingles, slices, words

#: Minima kept of a paragraph, as two bits each.
TOTAL = 96
_SKETCH = ("doc_id long, lo long, hi long, n_shingles long, s1 long, s2 long, "
           "bits array<long>, keys array<long>")


def tuned(percent: int, recall: float, rows: int = 2) -> Scheme:
    """The fewest bands of ``rows`` minima that propose a pair at the threshold with this probability."""
    bands = math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows))
    return Scheme(bands, rows, max(TOTAL, bands * rows))


def _lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of every line of every row (a line ends with its newline)."""
    return np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))


def _sketcher(size: int, least: int, scheme: Scheme):
    def sketch(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in slices(batch.column(1)):
                cuts = _lines(data, offsets)
                n = len(cuts) - 1
                if n < 1:
                    continue
                found = words(data, cuts)
                count = np.bincount(found.row, minlength=n)
                long = np.flatnonzero(count >= least)
                if not len(long):
                    continue
                begin = np.cumsum(count) - count
                # the whole sequence of words, twice hashed, tells copies
                place = np.arange(len(found.hash), dtype=np.uint64) - begin[found.row].astype(np.uint64)
                s1 = np.add.reduceat(mix(found.hash + mix(place)), begin[count > 0])
                s2 = np.add.reduceat(mix(found.hash ^ mix(place + np.uint64(1 << 40))), begin[count > 0])
                number = np.cumsum(count > 0) - 1
                rows, hashes = distinct(*shingles(found, n, size))
                keep = count[rows] >= least
                rows, hashes = rows[keep], hashes[keep]
                sets = np.bincount(rows, minlength=n)[long]
                # a line of fewer words than a shingle is like its copies only, which s1 and s2 tell: no bands
                full = count[long] >= size
                wide = count[rows] >= size
                of = sets[full]
                lows = np.empty((0, scheme.total), np.uint64)
                if full.any():
                    lows = minima(hashes[wide], np.cumsum(of) - of, scheme.total, SEED + 1)
                row = np.searchsorted(offsets, cuts[long], "right") - 1
                each = full.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(first + row)),
                        pa.array(cuts[long] - offsets[row]),
                        pa.array(cuts[long + 1] - offsets[row]),
                        pa.array(sets.astype(np.int64)),
                        pa.array(s1[number[long]].view(np.int64)),
                        pa.array(s2[number[long]].view(np.int64)),
                        lists(packed(lows, scheme).ravel(), each * scheme.words, pa.int64()),
                        lists(band_keys(lows, scheme.bands, scheme.rows).ravel(), each * scheme.bands, pa.int64()),
                    ],
                    names=["doc_id", "lo", "hi", "n_shingles", "s1", "s2", "bits", "keys"],
                )

    return sketch


def _cut_out(batches):
    """(doc_id, text, wanted) to (pid, paragraph)."""
    for batch in batches:
        ids, texts = [], []
        wanted = batch.column(2)
        for k in np.flatnonzero(np.array(wanted.is_valid(), bool)):
            body = (batch.column(1)[k].as_py() or "").encode()
            for want in wanted[k].as_py():
                ids.append(want["pid"])
                texts.append(body[want["lo"]:want["hi"]].decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def _joined(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of bytes without what they have in common."""
    out = []
    for a, b in sorted(parts):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _keeper(length: int):
    def kept(batches):
        """(doc_id, text, cut, passages) to the text left of each document, and what went."""
        for batch in batches:
            ids, texts, cuts, runs = (batch.column(k) for k in range(4))
            kept, gone, spans, lines, count, short, passage, inside = [], [], [], [], [], [], [], []
            for text, cut, run in zip(texts, cuts, runs):
                body = (text.as_py() or "").encode()
                found = [c for c in cut.as_py() or () if c["hi"] <= len(body)]
                passage.append(passages.byte_runs(body, run.as_py(), length))
                parts = _joined([*((c["lo"], c["hi"]) for c in found), *passage[-1]])
                lines.append(len(found))
                short.append(sum(c["short"] for c in found))
                ends, starts = [0, *(hi for _, hi in parts)], [*(lo for lo, _ in parts), len(body)]
                kept.append(b"".join(body[a:b] for a, b in zip(ends, starts)).decode("utf-8", "ignore"))
                gone.append(sum(b - a for a, b in parts))
                inside.append(sum(b - a for a, b in passage[-1]))
                spans.append([{"lo": a, "hi": b} for a, b in parts])
                count.append(body.count(b"\n") + (len(body) > 0 and not body.endswith(b"\n")))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(count, pa.int64()), pa.array([n - few for n, few in zip(lines, short)], pa.int64()),
                 pa.array(short, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(x) for x in passage], pa.int64()), pa.array(inside, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))],
                names=[*_NAMES, "kept", "spans"],
            )

    return kept


_COUNTS = "doc_id long, n_paragraphs long, n_removed long, n_short_removed long, bytes_removed long, n_passages long, passage_bytes long"
_NAMES = [field.split()[0] for field in _COUNTS.split(", ")]
KEPT = f"{_COUNTS}, kept string, spans array<struct<lo: long, hi: long>>"
DIGEST = f"{_COUNTS}, kept_sha256 string"


def _digest(length: int):
    def digest(batches):
        for batch in _keeper(length)(batches):
            digests = [hashlib.sha256(x.as_py().encode()).hexdigest() for x in batch.column("kept")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in _NAMES), pa.array(digests, pa.string())], names=[*_NAMES, "kept_sha256"])

    return digest


def removals(docs: DataFrame, size: int = 5, percent: int = 80, least: int = 1, recall: float = 0.9999, length: int = 50) -> DataFrame:
    """(doc_id, text, cut, passages): every row with the byte ranges of its repeated paragraphs, whether they are short, and its passages."""
    scheme = tuned(percent, recall)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = docs.where("doc_id is not null and text is not null").mapInArrow(_sketcher(size, least, scheme), _SKETCH)
    sketch = stored(sketch, "paragraphs")
    classes = sketch.groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "lo", "hi", "n_shingles", "bits", "keys")).alias("f"), F.count(F.lit(1)).alias("copies")
    )
    first = F.struct(F.col("f.doc_id").alias("doc"), F.col("f.lo").alias("lo"), F.col("f.hi").alias("hi")).alias("first")
    classes = stored(  # written once, so the numbers stay
        classes.select(
            F.monotonically_increasing_id().alias("doc_id"), "s1", "s2", "copies", first, "f.n_shingles", "f.bits", "f.keys"
        ),
        "classes",
    )

    def texts_of(asked: DataFrame) -> DataFrame:
        wanted = classes.join(asked, "doc_id").groupBy("first.doc").agg(
            F.collect_list(F.struct(F.col("doc_id").alias("pid"), F.col("first.lo").alias("lo"), F.col("first.hi").alias("hi"))).alias("wanted")
        ).withColumnRenamed("doc", "doc_id")
        texts = docs.join(wanted, "doc_id", "left").select("doc_id", "text", "wanted")
        return stored(texts.mapInArrow(_cut_out, "doc_id long, text string"), "cut_out")

    group = components(links(classes, scheme, size, percent, texts_of))
    # one row for each class that holds more than its first paragraph, or is linked to another class
    named = classes.join(group.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    named = named.where("copies > 1 or component is not null").select(
        "s1", "s2", "first", F.coalesce("component", "doc_id").alias("component")
    )
    named = stored(named, "named")
    keeper = stored(named.groupBy("component").agg(F.min(F.struct("first.doc", "first.lo")).alias("keeper")), "keepers")
    fate = stored(named.join(keeper, "component").select("s1", "s2", "keeper"), "fates")
    short = (F.size("keys") == 0).alias("short")  # too few words for a shingle, so without bands
    gone = sketch.select("doc_id", "lo", "hi", short, "s1", "s2").join(fate, ["s1", "s2"])
    gone = gone.where("doc_id <> keeper.doc or lo <> keeper.lo")
    cut = gone.groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi", "short")).alias("cut"))
    runs = passages.elsewhere(docs.where("doc_id is not null and text is not null"), length)
    cut = cut.join(runs.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("print", "passages"))).alias("runs")), "doc_id", "full_outer")
    rows = docs.join(stored(cut, "cuts"), "doc_id", "left")
    return rows.select("doc_id", "text", "cut", F.col("runs")[F.xxhash64("text")].alias("passages"))


def without_repeats(docs: DataFrame, size: int = 5, percent: int = 80, least: int = 1, recall: float = 0.9999, length: int = 50) -> DataFrame:
    """``KEPT`` for every row of ``docs`` (doc_id, text, ...): its text without repeated paragraphs.

    Paragraphs (lines) of at least ``least`` words (one or more) take part; with ``least`` of 1 all that
    have words.  Two of them link when the Jaccard similarity of their sets of ``size``-word shingles (A-Z
    in lower case; the whole sequence of words where a line has fewer) reaches ``percent``; of each
    component the paragraph that stands first (smallest doc_id, then place) stays, the others go with
    their newline.  ``n_removed`` counts those of at least ``size`` words, ``n_short_removed`` the others, which
    are mostly stock lines.

    Each run of ``length`` words that also stands in a document of smaller id goes as well, across lines too, up
    to the end of its last word (A-Z in lower case, space is not compared).  ``n_passages`` counts the longest such runs, ``passage_bytes`` their
    bytes, whether their lines went as paragraphs or not; ``bytes_removed`` is all that went.  Both ways judge texts as they came.

    * Shorter paragraphs, empty lines, null or empty text: left alone.
    * Null doc_id: left alone, and nothing repeats it.
    * Rows that repeat a doc_id are one document: a paragraph at the same place in both is no repeat.
    * Other columns are ignored; an empty table gives no rows.
    """
    return removals(docs, size, percent, least, recall, length).mapInArrow(_keeper(length), KEPT)


def digest(docs: DataFrame, length: int = 50, **parameters) -> DataFrame:
    """``without_repeats`` with the SHA-256 of the text left in place of it."""
    return removals(docs, length=length, **parameters).mapInArrow(_digest(length), DIGEST)
