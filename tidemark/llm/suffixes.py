"""Repeated byte strings across a corpus, by a sparse suffix sort with hashed comparisons.

Sorting a suffix for every byte would move the corpus a hundred times over.  So each 100-byte window
names an anchor, the 24-byte gram of the smallest hash within it: equal windows name equal grams at
equal places, and neighbouring windows mostly share theirs.  A *run* is the stretch of windows with
one anchor.  Then

1. grams seen once anywhere are dropped, with their windows: nothing equals those;
2. runs of equal gram and equal bytes (a class) are repeats of the earliest of them, whole;
3. the earliest runs of a gram with several classes bring their bytes together, and there the suffixes
   that begin at their windows are merge-sorted.  Two suffixes are compared by the longest common
   extension found by binary search over prefix polynomial hashes; neighbours that agree for 100 bytes
   are verified byte by byte, and a group with a hash collision is sorted by its bytes instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import stored
from tidemark.llm.text import Prefixes, mix, slices
from tidemark.operators.joins import join_aggregated

LENGTH = 100
GRAM = 24
#: Classes of one gram that are sorted together.  A gram with more is told apart by the bytes next to it, and
#: what then still has more is dealt over several tasks.
BLOCK = 2048
#: Bytes looked at together, so that what is derived from them stays in the processor's caches.
NEAR = 1 << 18
_HIGH = np.uint64(0xFFFFFFFF00000000)
_RUN = "gram long, ctx long, doc_id long, span long"
_CONTEXT = "gram long, near long, doc_id long, lo long, off int, body binary"
_FOUND = "doc_id long, lo long, n long, f1 long, f2 long"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, span = values, 1
    while span * 2 <= width:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span:]) if span < width else out


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(row, gram, context, first window, windows, anchor's place in the first) of every run of every row."""
    gram = min(GRAM, length)
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    prefixes = Prefixes(data)
    hashes = mix(prefixes.all(gram))
    lowest = _sliding_min((hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)  # leftmost of equals
    anchor = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    valid = np.ones(len(data), bool)
    for end, begin in zip(offsets[1:], offsets[:-1]):  # a window ends within its row
        valid[max(begin, end - length + 1):end] = False
    valid = valid[: len(anchor)]
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    ends = np.ones(len(valid), bool)
    ends[:-1] = fresh[1:] | ~valid[1:]
    lo, last = np.flatnonzero(fresh), np.flatnonzero(ends & valid)
    n, off = last - lo + 1, anchor[lo] - lo
    context = mix(prefixes.of(lo, last + length) + (off * 65536 + n).astype(np.uint64))
    row = np.searchsorted(offsets, lo, "right") - 1
    return row, hashes[anchor[lo]].view(np.int64), context.view(np.int64), lo - offsets[row], n, off


def _runs(length: int):
    def emit(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in slices(batch.column(1), NEAR):
                row, gram, context, lo, n, off = runs_of(data, offsets, length)
                span = (lo << 24) | (n << 12) | off
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(context), ids.take(pa.array(first + row)), pa.array(span)],
                    names=["gram", "ctx", "doc_id", "span"],
                )

    return emit


def _sides(body: bytes, lo: int, n: int, off: int, length: int):
    """(near, first window, windows) of the two halves of a hot gram's run.

    A window around a gram holds either half of what is left of its bytes before the gram, or as many after
    it.  These bytes tell windows apart, and equal windows lie on the same side with the same bytes.
    """
    size = min(GRAM, length)
    half, at, last = (length - size) // 2, lo + off, lo + n - 1
    cut = min(last, at - half)
    for side, first, end, bytes_ in ((b"<", lo, cut, body[at - half:at]), (b">", max(lo, cut + 1), last, body[at + size:at + size + half])):
        if first <= end:
            near = int.from_bytes(hashlib.blake2b(side + bytes_, digest_size=8).digest(), "big", signed=True)
            yield near or 1, first, end - first + 1


def _contexts(length: int):
    """The bytes around each wanted run, from (doc_id, text, wanted); those of a hot gram by side, ``near`` not 0."""

    def emit(batches):
        for batch in batches:
            ids, texts, wanted = (batch.column(k) for k in range(3))
            rows = {k: [] for k in ("gram", "near", "doc_id", "lo", "off", "body")}
            for k in np.flatnonzero(np.array(wanted.is_valid(), bool)):
                body = (texts[k].as_py() or "").encode()
                for want in wanted[k].as_py():
                    lo, n, off = want["span"] >> 24, want["span"] >> 12 & 0xFFF, want["span"] & 0xFFF
                    if len(body) < lo + n + length - 1:
                        continue  # a row that repeats the doc_id with another text
                    for near, first, count in _sides(body, lo, n, off, length) if want["hot"] else ((0, lo, n),):
                        for name, value in (("gram", want["gram"]), ("near", near), ("doc_id", ids[k].as_py()), ("lo", first),
                                            ("off", lo + off - first), ("body", body[first:first + count + length - 1])):
                            rows[name].append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))

    return emit


class Suffixes:
    """Suffixes of ``data`` compared up to ``length`` bytes by hashed longest common extensions."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.prefixes = data, length, Prefixes(data)

    def extension(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at ``one`` and ``other`` share: binary search over prefix hashes."""
        shared = np.zeros(len(one), np.int64)
        for step in (1 << k for k in reversed(range(self.length.bit_length()))):
            ahead = np.minimum(shared + step, self.length)
            same = self.prefixes.of(one, one + ahead) == self.prefixes.of(other, other + ahead)
            shared = np.where(same & (shared + step <= self.length), shared + step, shared)
        return shared

    def before(self, one: np.ndarray, other: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether ``one`` sorts before ``other``; equals give ``ties``."""
        shared = self.extension(one, other)
        at = np.minimum(shared, self.length - 1)
        return np.where(shared == self.length, ties, self.data[one + at] < self.data[other + at])

    def merge_sort(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """An order of the suffixes at ``at`` that sorts every segment (segments are contiguous).

        All merges of one width run together: an element's place is its own in its half plus the number
        of the other half's elements that sort before it, found by binary search.
        """
        order = np.arange(len(at))
        new = np.concatenate([[True], segment[1:] != segment[:-1]]) if len(at) else np.zeros(0, bool)
        base = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        size = np.diff(np.append(np.flatnonzero(new), len(at)))[np.cumsum(new) - 1]
        width = 1
        while len(at) and width < size.max():
            local = np.arange(len(at)) - base
            pair = local - local % (2 * width)
            right = local % (2 * width) >= width
            lo = base + np.where(right, pair, np.minimum(pair + width, size))
            hi = base + np.where(right, pair + width, np.minimum(pair + 2 * width, size))
            first = lo.copy()
            while len(todo := np.flatnonzero(lo < hi)):
                mid = (lo[todo] + hi[todo]) // 2
                # the left half's equals stay before the right half's
                less = self.before(at[order[mid]], at[order[todo]], right[todo])
                lo[todo] = np.where(less, mid + 1, lo[todo])
                hi[todo] = np.where(less, hi[todo], mid)
            place = base + pair + (local - pair - np.where(right, width, 0)) + (lo - first)
            moved = np.empty_like(order)
            moved[place] = order
            order, width = moved, width * 2
        return order


def repeats(group, rel, at, data, length):
    """Classes of equal suffixes among those of one (group, rel): a number for each suffix.

    A suffix whose first ``length`` bytes no other of its group hashes alike is a class of its own and
    left out of the sort.
    """
    hashes = Prefixes(data).of(at, at + length) + mix(np.asarray(group).astype(np.uint64))
    order = np.argsort(hashes, kind="stable")
    alike = np.zeros(len(at) + 1, bool)
    alike[1:-1] = hashes[order[1:]] == hashes[order[:-1]]
    some = np.sort(order[alike[1:] | alike[:-1]])
    classes = np.arange(len(at)) + len(some)
    classes[some] = _sorted_classes(group[some], rel[some], at[some], data, length)
    return classes


def _sorted_classes(group, rel, at, data, length):
    """``repeats`` by the suffix sort; numbers below that of the suffixes, or collisions far above."""
    key = np.lexsort((at, rel, group))
    segment = np.cumsum(np.concatenate([[True], (np.diff(group[key]) != 0) | (np.diff(rel[key]) != 0)])) if len(key) else key
    suffixes = Suffixes(data, length)
    order = key[suffixes.merge_sort(at[key], segment)]
    segment = segment[: len(order)]  # merging moves nothing across segments
    one, other = at[order[:-1]], at[order[1:]]
    same = (segment[1:] == segment[:-1]) & (suffixes.extension(one, other) == length)
    pairs = np.flatnonzero(same)
    wrong = np.zeros(len(pairs), bool)
    for lo in range(0, len(pairs), 65536):  # verify: the bytes themselves
        some = pairs[lo:lo + 65536]
        wide = np.arange(length)
        wrong[lo:lo + 65536] = (data[one[some][:, None] + wide] != data[other[some][:, None] + wide]).any(axis=1)
    classes = np.empty(len(order), np.int64)
    classes[order] = np.cumsum(np.concatenate([[True], ~same])) - 1 if len(order) else 0
    for bad in np.unique(segment[pairs[wrong]]):  # a collision: this segment by its bytes
        members = order[segment == bad]
        texts = {}
        top = max(classes.max(), 1 << 40) + 1
        for m in members:
            classes[m] = top + texts.setdefault(data[at[m]:at[m] + length].tobytes(), len(texts))
    return classes


GROUP = ("gram", "near", "deal")


def _changes(table: pa.Table) -> np.ndarray:
    """Where a row's group is another than that of the row before."""
    columns = [np.array(table.column(k)) for k in GROUP]
    return np.logical_or.reduce([np.diff(c) != 0 for c in columns])


def _sorted_block(table: pa.Table, length: int):
    """Repeats among whole groups of contexts: flagged windows, and the distinct windows of a group that was dealt."""
    bodies = table.column("body").combine_chunks()
    _, data, offsets = next(slices(bodies, 1 << 40))
    doc, lo, off = (np.array(table.column(k)).astype(np.int64) for k in ("doc_id", "lo", "off"))
    dealt = np.array(table.column("dealt"))
    group = np.cumsum(np.concatenate([[True], _changes(table)]))
    n = np.diff(offsets) - length + 1
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at, start, rel = offsets[owner] + place, lo[owner] + place, place - off[owner]
    classes = repeats(group[owner], rel, at, data, length)
    order = np.lexsort((start, doc[owner], classes))
    ordered = classes[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    earliest = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    flagged = np.zeros(len(order), bool)
    flagged[order] = (doc[owner[order]] != doc[owner[earliest]]) | (start[order] != start[earliest])
    new = flagged.copy()
    new[1:] &= ~flagged[:-1] | (owner[1:] != owner[:-1])
    end = np.ones(len(flagged), bool)
    end[:-1] = ~flagged[1:] | (owner[1:] != owner[:-1])
    new, end = np.flatnonzero(new), np.flatnonzero(end & flagged)
    parts = [(doc[owner[new]], start[new], end - new + 1, None, None)]
    distinct = np.flatnonzero(~flagged & dealt[owner])
    if len(distinct):
        spot = at[distinct]
        f1 = mix(Prefixes(data).of(spot, spot + length))
        f2 = mix(Prefixes(255 - data[::-1]).of(len(data) - spot - length, len(data) - spot))
        parts.append((doc[owner[distinct]], start[distinct], np.ones(len(distinct), np.int64), f1.view(np.int64), f2.view(np.int64)))
    for d, s, k, f1, f2 in parts:
        nulls = pa.nulls(len(d), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(d), pa.array(s), pa.array(k), nulls if f1 is None else pa.array(f1), nulls if f2 is None else pa.array(f2)],
            names=["doc_id", "lo", "n", "f1", "f2"],
        )


def _sorter(length: int):
    """Over batches sorted by GROUP: whole groups at a time, however batches cut them."""

    def sort(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            if not held.num_rows:
                continue
            starts = np.flatnonzero(_changes(held))
            if len(starts):
                cut = int(starts[-1]) + 1  # the last group may go on
                yield from _sorted_block(held.slice(0, cut), length)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from _sorted_block(held, length)

    return sort


def _kept(batches):
    """(doc_id, text, cut) to what is removed and what stays; cut lists (lo, hi) byte ranges."""
    for batch in batches:
        ids, texts, cuts = (batch.column(k) for k in range(3))
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept", "spans")}
        for text, cut in zip(texts, cuts):
            body = (text.as_py() or "").encode()
            spans = []
            for one in sorted((c["lo"], c["hi"]) for c in cut.as_py() or ()):
                if spans and one[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], one[1])
                else:
                    spans.append(list(one))
            ends = [0, *(hi for _, hi in spans)]
            starts = [*(lo for lo, _ in spans), len(body)]
            out["kept"].append(b"".join(body[a:b] for a, b in zip(ends, starts)))
            out["n_bytes"].append(len(body))
            out["n_removed"].append(sum(b - a for a, b in spans))
            out["n_spans"].append(len(spans))
            out["spans"].append([{"lo": a, "hi": b} for a, b in spans])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, t) for v, t in zip(out.values(), kinds))], names=["doc_id", *out])


def _digest(batches):
    for batch in _kept(batches):
        digests = [hashlib.sha256(x.as_py()).hexdigest() for x in batch.column("kept")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(4)), pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


KEPT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, "
        "spans array<struct<lo: long, hi: long>>")
DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text, cut): every row of ``docs`` with the byte ranges that repeat something earlier."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = docs.where("doc_id is not null").mapInArrow(_runs(length), _RUN)
    shared = stored(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram"), "grams")
    runs = stored(runs.join(shared, "gram"), "runs")
    place = F.struct("doc_id", "span")
    classes = stored(runs.groupBy("gram", "ctx").agg(F.min(place).alias("first")), "classes")
    kinds = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = classes.join(stored(kinds, "kinds"), "gram").select(
        "first.doc_id", F.struct("gram", (F.col("kinds") > BLOCK).alias("hot"), F.col("first.span").alias("span")).alias("want")
    )
    wanted = stored(wanted, "wanted").groupBy("doc_id").agg(F.collect_list("want").alias("wanted"))
    # both joins below take the texts from the same shuffle, so neither filters them first
    contexts = docs.join(wanted, "doc_id", "left").select("doc_id", "text", "wanted").mapInArrow(_contexts(length), _CONTEXT)
    contexts = stored(contexts, "contexts")
    hot = contexts.where("near <> 0").groupBy("gram", "near").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).where("blocks > 1")
    dealt = join_aggregated(contexts, hot, ["gram", "near"], "left").select(
        *contexts.columns, F.col("blocks").isNotNull().alias("dealt"),
        F.pmod(F.xxhash64("body"), F.coalesce("blocks", F.lit(1).cast("long"))).cast("int").alias("deal"),
    )
    found = dealt.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(_sorter(length), _FOUND)
    # the blocks of a group that was dealt have listed each window once: the earliest of all blocks stays
    window = Window.partitionBy("f1", "f2")
    across = found.where("f1 is not null").withColumn("first", F.min(F.struct("doc_id", "lo")).over(window))
    across = across.where("struct(doc_id, lo) <> first").select("doc_id", "lo", "n")
    later = runs.join(classes, ["gram", "ctx"]).where("struct(doc_id, span) <> first")
    later = later.select("doc_id", F.expr("shiftright(span, 24)").alias("lo"), F.expr("shiftright(span, 12) & 4095").alias("n"))
    every = found.where("f1 is null").select("doc_id", "lo", "n").union(across).union(later)
    cut = every.groupBy("doc_id").agg(
        F.collect_list(F.struct("lo", (F.col("lo") + F.col("n") + (length - 1)).alias("hi"))).alias("cut")
    )
    return docs.join(cut, "doc_id", "left").select("doc_id", "text", "cut")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``KEPT`` for every row of ``docs`` (doc_id, text, ...): the bytes left and the ranges removed.

    Removed is each byte covered by a ``length``-byte string that also starts earlier: in a document of
    smaller doc_id, or earlier in the same one.  Strings are judged on the input.

    * Null or empty text, or fewer than ``length`` bytes: nothing is removed.
    * Null doc_id: nothing is removed, and nothing is a repeat of it.
    * Rows that repeat a doc_id are one document: a string at the same place in both is no repeat.
    * Other columns are ignored; an empty table gives no rows.
    """
    return removals(docs, length).mapInArrow(_kept, KEPT)


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``without_repeats`` with the SHA-256 of the bytes left in place of them."""
    return removals(docs, length).mapInArrow(_digest, DIGEST)


# documents are cut into pieces of 1000 bytes that overlap by 99, as finding a place in a long text takes long
ORACLE = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
piece AS (
  SELECT doc_id, c, substr(h, 2000 * c + 1, 2198) AS x
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2000 + 1)) AS c FROM b)
), spot AS (
  SELECT doc_id, 1000 * c + r AS p, substr(x, 2 * r + 1, 2) AS byte
  FROM (SELECT doc_id, c, x, unnest(range(0, least(1000, len(x) // 2))) AS r FROM piece)
), w AS (
  SELECT doc_id, 1000 * c + r AS p, md5(substr(x, 2 * r + 1, 200)) AS s
  FROM (SELECT doc_id, c, x, unnest(range(0, least(1000, len(x) // 2 - 99))) AS r FROM piece)
), dup AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w)
  WHERE k > 1
), covered AS (
  SELECT spot.doc_id, spot.p, byte, coalesce(max(dup.p) OVER (
    PARTITION BY spot.doc_id ORDER BY spot.p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), -1) >= 0 AS gone
  FROM spot LEFT JOIN dup ON dup.doc_id = spot.doc_id AND dup.p = spot.p
), edges AS (
  SELECT doc_id, p, byte, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS new FROM covered
), sums AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (new) AS n_spans,
         coalesce(string_agg(byte, '' ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM edges GROUP BY doc_id
)
SELECT b.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM b LEFT JOIN sums USING (doc_id)
"""
