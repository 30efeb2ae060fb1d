"""Hard negatives by inner product, found by pruning on lengths and on single coordinates.

Rows lie in blocks of one length bucket, with a sorted list of every coordinate of the unit vectors.  An
anchor with a threshold t looks at a block as follows: rows reach t only if their cosine with the anchor is
at least t by the product of the anchor's and the block's greatest length; blocks in which this is above 1
are never sent to it, and otherwise it bounds every coordinate.  The ranges of the anchor's largest
coordinates are cut out of the sorted lists and intersected, and what is left is multiplied exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import prepared, stored
from tidemark.operators.joins import join_aggregated

SCALE = 256
EVERY, MOVED, LABELS = 50, 7, 10  # anchors; rows that take the next label; labels
POSITIVES, NEGATIVES = 5, 3
BLOCK = 2048  # rows of a block, about
ANCHORS = 512  # anchors that go together, about
SHELF = 4  # blocks that anchors are sent to together, about
RATIO = 0.9  # of lengths in a bucket
FOCUS = 3  # coordinates looked at
SLACK = 1e-9  # for rounding of bounds, which are far coarser

VECTORS = "row long, vec_id long, label long, vector array<long>"
BLOCKS = "dim int, slot long, block long, longest double, only long, rows binary, ids binary, labels binary, kind string, values binary, orders binary"
ASKED = "dim int, slot long, row long, vec_id long, label long, vector array<long>, low long"


def vectors(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part, with their whole-number vectors."""
    value = F.col("embedding").cast("array<double>")
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label)
    rows = embeddings.where("vec_id is not null and label is not null and embedding is not null").where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
        F.transform(value, lambda x: F.floor(SCALE * x)).alias("vector"),
    )
    return rows.select(F.xxhash64("vec_id", "label", "vector").alias("row"), "vec_id", "label", "vector")


def products(rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Exact inner products, (asked, rows); those beyond 64 bits are held at the ends of that range."""
    top = [int(np.abs(x.astype(object)).max()) if x.dtype == np.int64 and x.size and x.min() == np.iinfo(np.int64).min
           else int(np.abs(x.astype(np.int64)).max(initial=0)) for x in (rows, asked)]
    most = top[0] * top[1] * max(rows.shape[1], 1)
    if most < 1 << 53:
        return (asked.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return asked.astype(np.int64) @ rows.astype(np.int64).T
    out = asked.astype(object) @ rows.astype(object).T
    ends = np.iinfo(np.int64)
    return np.clip(out, ends.min, ends.max).astype(np.int64)


def lengths(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.float64)
    return np.sqrt((values * values).sum(axis=1))


@dataclass
class Block:
    """Rows of one length bucket; ``orders[f]`` lists them by coordinate f of their unit vectors."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    longest: float
    orders: np.ndarray

    @staticmethod
    def units(values: np.ndarray) -> np.ndarray:
        length = lengths(values)
        return values / np.where(length > 0, length, 1)[:, None]

    @cached_property
    def unit(self) -> np.ndarray:
        return np.ascontiguousarray(self.units(self.values).T)

    def feasible(self, vector: np.ndarray, least: int) -> np.ndarray | None:
        """Places of the rows whose product with ``vector`` may reach ``least``; None for all."""
        if least <= 0:
            return None
        length = float(lengths(vector[None])[0])
        reach = length * self.longest
        bound = least / reach * (1 - SLACK) if reach else math.inf
        if bound > 1:
            return np.zeros(0, np.int64)
        unit, ranges = vector / length, []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            x = float(unit[f])
            width = math.sqrt(max(0.0, (1 - bound * bound) * (1 - x * x)))
            low = -1.0 if x < -bound else x * bound - width
            high = 1.0 if x > bound else x * bound + width
            listed = self.orders[f]
            along = self.unit[f]
            start = np.searchsorted(along, low - SLACK, "left", sorter=listed)
            stop = np.searchsorted(along, high + SLACK, "right", sorter=listed)
            ranges.append((stop - start, start, stop, f, low, high))
        ranges.sort()
        _, start, stop, f, _, _ = ranges[0]
        found = self.orders[f][start:stop].astype(np.int64)
        for _, _, _, f, low, high in ranges[1:]:
            at = self.unit[f][found]
            found = found[(at >= low - SLACK) & (at <= high + SLACK)]
        return None if 2 * len(found) > len(self.ids) else found

    def reaching(self, asked: np.ndarray, least: list[int | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector asked about: places of all rows whose product is at least ``least``, and the products."""
        found = [None if low is None else self.feasible(v, low) for v, low in zip(asked, least)]
        every = [k for k, at in enumerate(found) if at is None]
        whole = dict(zip(every, products(self.values, asked[every]))) if every else {}
        for k, (at, low) in enumerate(zip(found, least)):
            score = whole[k] if at is None else products(self.values[at], asked[k][None])[0]
            at = np.arange(len(self.ids)) if at is None else at
            if low is not None:
                at, score = at[score >= low], score[score >= low]
            yield at, score

    def ranked(self, at: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest product first, ties by smaller id; ~x keeps the order of -x without its overflow."""
        order = np.lexsort((self.ids[at], ~score))
        return at[order], score[order]


def _pack(batch: pa.Table, dim: int) -> dict:
    """A block's columns; rows given more than once count once."""
    rows, ids, labels = (np.array(batch.column(c)) for c in ("row", "vec_id", "label"))
    _, once = np.unique(np.stack([rows, ids]), axis=1, return_index=True)
    values = np.array(batch.column("vector").combine_chunks().flatten()).reshape(len(ids), dim)[once]
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = next(k for k in ("int16", "int32", "int64") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    orders = np.argsort(Block.units(values), axis=0, kind="stable").T.astype(np.uint16 if len(once) < 1 << 16 else np.uint32)
    return {
        "longest": float(lengths(values).max(initial=0.0)), "only": int(labels[0]) if (labels == labels[0]).all() else None,
        "rows": rows[once].tobytes(), "ids": ids[once].tobytes(), "labels": labels[once].tobytes(),
        "kind": kind, "values": values.astype(kind).tobytes(), "orders": np.ascontiguousarray(orders).tobytes(),
    }


def _packed(key: tuple, batch: pa.Table) -> pa.Table:
    dim, slot, _, block = (k.as_py() for k in key)
    row = {"dim": dim, "slot": slot, "block": block} | _pack(batch, dim)
    names = [field.split()[0] for field in BLOCKS.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), *[pa.binary()] * 3, pa.string(), *[pa.binary()] * 2]
    return pa.table([pa.array([row[n]], k) for n, k in zip(names, kinds)], names=names)


def _unpacked(row: dict) -> Block:
    ids = np.frombuffer(row["ids"], np.int64)
    orders = np.frombuffer(row["orders"], np.uint16 if len(ids) < 1 << 16 else np.uint32)
    return Block(
        np.frombuffer(row["rows"], np.int64), ids, np.frombuffer(row["labels"], np.int64),
        np.frombuffer(row["values"], row["kind"]).reshape(len(ids), row["dim"]), row["longest"], orders.reshape(row["dim"], len(ids)),
    )


def _blocks(rows: DataFrame) -> DataFrame:
    """BLOCKS of all rows.  A label's rows lie in one slot, and a slot's in as many blocks as they fill."""
    count = rows.count()
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    bucket = F.when(squares > 0, F.floor(F.log(squares) / (2 * math.log(1 / RATIO))))
    dealt = rows.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("label"), F.lit(max(1, math.ceil(count / BLOCK)))).alias("slot"),
        F.coalesce(bucket, F.lit(-(1 << 40))).alias("bucket"), "*",
    )
    sizes = dealt.groupBy("dim", "slot", "bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    dealt = join_aggregated(dealt, sizes, ["dim", "slot", "bucket"], "inner")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("parts"))).drop("parts")
    packed = dealt.groupBy("dim", "slot", "bucket", "block").applyInArrow(_packed, BLOCKS)
    packed = packed.select("*", F.xxhash64("dim", "slot", "longest", "block", "ids").alias("name"))
    return stored(packed, "blocks")


def _first_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of every block, each with the score of its last positive if it had none but those of its block."""
    names = [field.split()[0] for field in ASKED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    for batch in batches:
        for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            block = _unpacked(row)
            mine = np.flatnonzero(block.ids % EVERY == 0)
            out = []
            for k, (_, score) in zip(mine, block.reaching(block.values[mine], [None] * len(mine))):
                others = np.sort(score[(block.labels == block.labels[k]) & (block.ids != block.ids[k])])
                low = int(others[-POSITIVES]) if len(others) >= POSITIVES else None
                out.append((row["dim"], row["slot"], block.rows[k], block.ids[k], block.labels[k], block.values[k].astype(np.int64), low))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)


Seek = Callable[[Block, list[dict]], list[tuple]]


def _seek_positives(block: Block, anchors: list[dict]) -> list[tuple]:
    """(row, anchor_id, positive_id, score): the first others of each anchor's label in the block."""
    out = []
    asked = np.array([a["vector"] for a in anchors], np.int64).reshape(len(anchors), -1)
    for a, (at, score) in zip(anchors, block.reaching(asked, [a["low"] for a in anchors])):
        fits = (block.labels[at] == a["label"]) & (block.ids[at] != a["vec_id"])
        at, score = block.ranked(at[fits], score[fits])
        out += [(a["row"], a["vec_id"], int(block.ids[p]), int(s)) for p, s in zip(at[:POSITIVES], score)]
    return out


def _seek_negatives(block: Block, anchors: list[dict]) -> list[tuple]:
    """(row, anchor_id, place, positive_id, positive_score, negative_id, score): the first within each positive's range."""
    out = []
    asked = np.array([a["vector"] for a in anchors], np.int64).reshape(len(anchors), -1)
    for a, (at, score) in zip(anchors, block.reaching(asked, [a["low"] for a in anchors])):
        other = block.labels[at] != a["label"]
        at, score = block.ranked(at[other], score[other])
        for w in a["wanted"]:
            first = int(np.searchsorted(~score, ~np.int64(w["high"])))
            for p, s in zip(at[first:first + NEGATIVES], score[first:]):
                if s >= w["low"]:
                    out.append((a["row"], a["vec_id"], w["place"], w["positive_id"], w["positive_score"], int(block.ids[p]), int(s)))
    return out


def _met(seek: Seek, names: list[str], kinds: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if found := seek(_unpacked(row), row["anchors"]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), kinds)], names=names)

    return run


def _meetings(asked: DataFrame, blocks: DataFrame, same: bool) -> DataFrame:
    """Groups of anchors next to each block that may hold what they look for.

    ``asked`` has ASKED columns and whatever else ``seek`` reads.  Anchors are sent to shelves of a few
    blocks each: of their label's slot, or of all.
    """
    keys = ["dim", "slot"] if same else ["dim"]
    sizes = blocks.groupBy(keys).agg(F.ceil(F.count(F.lit(1)) / SHELF).alias("shelves"))
    parts = asked.groupBy("dim", "slot").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).alias("parts"))
    groups = join_aggregated(asked, parts, ["dim", "slot"], "inner")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    # the length a row must have to reach an anchor's threshold; none where there is no threshold above 0
    need = F.when(F.col("low") > 0, F.when(length > 0, F.col("low") / length).otherwise(float("inf"))).otherwise(0.0)
    own = [F.col(c) for c in asked.columns if c not in ("dim", "slot")]
    groups = groups.groupBy("dim", "slot", F.pmod("row", "parts").alias("part")).agg(
        F.min(need).alias("need"), F.when(F.min("label") == F.max("label"), F.min("label")).alias("label"),
        F.collect_list(F.struct(*own)).alias("anchors"),
    ).drop("part")
    groups = stored(groups, "anchors")
    sent = join_aggregated(groups, sizes, keys, "inner").withColumn("shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shelves") - 1)))
    held = join_aggregated(blocks, sizes, keys, "inner").withColumn("shelf", F.pmod("name", "shelves"))
    n = int(sizes.agg(F.sum("shelves")).first()[0] or 1)
    n = min(n, 10_000)  # tasks; a task takes any number of shelves
    sent = sent.select(*keys, "shelf", "need", "anchors", "label").repartition(n, *keys, "shelf")
    held = held.drop("shelves", *([] if same else ["slot"])).repartition(n, *keys, "shelf")
    near = held.join(sent, [*keys, "shelf"])
    near = near.where(F.col("longest") * (1 + SLACK) >= F.col("need"))
    if not same:  # a block of the anchors' own label alone has nothing for them
        near = near.where(~F.coalesce(F.col("only") == F.col("label"), F.lit(False)))
    return near.select("dim", "longest", "rows", "ids", "labels", "kind", "values", "orders", "anchors")


def mine(embeddings: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``embeddings`` (vec_id, embedding, label, ...).

    Components are taken as floor(256 * x).  Every 50th vec_id is an anchor; its positives are the first five
    others of its label by product, ties by smaller vec_id; the negatives of a positive are the first three of
    other labels whose product is 50% to 95% of the positive's.

    * Rows with a null vec_id, label, vector or component, or one not finite, take no part.
    * Rows whose vec_id is divisible by 7 first take the next label, modulo 10.
    * Only vectors of the anchor's length (number of components) have a product with it.
    * Rows that repeat one exactly count once; others of the same vec_id are rows of their own, though none
      of the anchor's own vec_id is its positive.
    * Products beyond 64 bits are held at the ends of that range; components likewise.
    * Other columns are ignored; an empty table gives no rows.
    """
    prepared(embeddings.sparkSession)
    rows = stored(vectors(embeddings), "vectors")
    blocks = _blocks(rows)
    anchors = stored(blocks.drop("name").mapInArrow(_first_look, ASKED), "anchors")
    long = pa.int64()
    look = _met(_seek_positives, ["row", "anchor_id", "positive_id", "score"], [long] * 4)
    found = _meetings(anchors, blocks, same=True).mapInArrow(look, "row long, anchor_id long, positive_id long, score long")
    first = Window.partitionBy("row", "anchor_id").orderBy(F.desc("score"), "positive_id")
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= POSITIVES)
    # 50 p <= 100 n <= 95 p in whole numbers: half of p rounded up, and p less a twentieth rounded up
    wanted = stored(found.select(
        "row", "anchor_id", "place", "positive_id", F.col("score").alias("positive_score"),
        F.expr("score div 2 + if(score > 0 and score % 2 = 1, 1, 0)").alias("low"),
        F.expr("score - (score div 20 + if(score > 0 and score % 20 > 0, 1, 0))").alias("high"),
    ).where("low <= high"), "positives")
    ranges = F.collect_list(F.struct("place", "positive_id", "positive_score", "low", "high")).alias("wanted")
    wanted = wanted.groupBy("row", F.col("anchor_id").alias("vec_id")).agg(ranges, F.min("low").alias("low"))
    asked = anchors.drop("low").join(wanted, ["row", "vec_id"])
    names = ["row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
    look = _met(_seek_negatives, names, [long, long, pa.int32(), long, long, long, long])
    kind = "row long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meetings(asked, blocks, same=False).mapInArrow(look, kind)
    first = Window.partitionBy("row", "anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 3
"""
