"""Near-duplicate embeddings: every pair above a cosine threshold, by traversing cover trees in pairs.

Unit vectors at cosine c lie sqrt(2 - 2c) apart, so the threshold is a distance.  Equal vectors become
one.  The rest are dealt to the nearest of a bounded set of centres, whose covering radii come from all
the data, and packed into blocks of bounded size; pairs of blocks that their radii keep apart are never
brought together.  Each block holds a cover tree: nested levels of centres whose radii halve.  Two trees
are traversed together, dropping a pair of nodes when their centres are further apart than both radii
and the threshold allow, and taking it whole when they are so near that every pair must link.

Blocks lie in the shared folder once, as files that tasks open themselves.  What is dealt to tasks are the
numbers of blocks that meet: were their contents dealt, each block would be shuffled once for each other one.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import components, smallest, stored, written
from tidemark.sources.paged import file_system

#: Vectors in a block, about; the most centres that blocks are dealt by.
BLOCK = 4096
CENTRES = 1024
#: Blocks that one is brought together with by a row of work at most, and pairs of blocks to a task, about.
PARTNERS, PAIRS = 32, 512
LEAF = 16
#: What rounding may add to a distance: bounds are widened by it, and pairs near them looked at.
SLACK = 1e-7
#: What single precision may take a cosine for too much or too little by.
SINGLE = 1e-5
#: Where one in so many pairs of two blocks' vectors is to be looked at, all their cosines are taken by a matrix product.
MANY = 1024
_TREE = [("start", np.int64), ("end", np.int64), ("centre", np.int64), ("first", np.int64), ("last", np.int64), ("radius", np.float64)]


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes) of the unit vectors ``points``: a node covers ``order[start:end]``.

    A node's children are centres more than the level's radius apart, the node's own centre first, each
    with the points it was the first to cover; the radius halves from level to level.  ``first`` and
    ``last`` bound a node's children among the nodes; leaves have none.
    """
    order = np.arange(len(points))
    nodes = np.zeros(1, _TREE)
    nodes[0]["end"] = len(points)
    rows, reach = [nodes[0].copy()], [2.0]
    rows[0]["radius"] = np.sqrt(((points - points[0]) ** 2).sum(axis=1).max())
    k = 0
    while k < len(rows):
        node, radius = rows[k], reach[k]
        start, end = int(node["start"]), int(node["end"])
        if end - start > LEAF and node["radius"] > 0:
            while radius >= node["radius"]:
                radius /= 2
            left, parts, centre = order[start:end], [], int(node["centre"])
            left = np.concatenate([[centre], left[left != centre]])
            while len(left):
                far = np.sqrt(np.maximum(2 - 2 * (points[left] @ points[left[0]]), 0))
                far[0] = 0
                near = far <= radius
                parts.append((left[near], float(far[near].max())))
                left = left[~near]
            rows[k]["first"], rows[k]["last"] = len(rows), len(rows) + len(parts)
            at = start
            for members, most in parts:
                child = np.zeros(1, _TREE)[0]
                child["start"], child["end"], child["centre"], child["radius"] = at, at + len(members), members[0], most
                order[at:at + len(members)] = members
                rows.append(child)
                reach.append(radius / 2)
                at += len(members)
        k += 1
    return order, np.array(rows, _TREE)


def _crossed(first_a, last_a, first_b, last_b):
    """Every (i, j) with i in [first_a, last_a) and j in [first_b, last_b), of each row."""
    a, b = last_a - first_a, last_b - first_b
    each = a * b
    row = np.repeat(np.arange(len(each)), each)
    place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    return first_a[row] + place // b[row], first_b[row] + place % b[row]


def _in_parts(first_a, last_a, first_b, last_b, most=1 << 18):
    """``_crossed`` in runs of rows of bounded size (one row may exceed it by its own size)."""
    each = (last_a - first_a) * (last_b - first_b)
    total, lo = np.cumsum(each), 0
    while lo < len(each):
        hi = max(int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")), lo + 1)
        yield _crossed(first_a[lo:hi], last_a[lo:hi], first_b[lo:hi], last_b[lo:hi])
        lo = hi


class Block:
    """Vectors of a block in the order of its cover tree."""

    def __init__(self, ids, copies, vectors, nodes, cosine):
        # times a power of two, which changes no cosine but keeps products in the range of doubles
        self.vectors = vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        self.ids, self.copies = ids, copies
        self.theta = math.sqrt(max(0.0, 2 - 2 * cosine))
        self.units = unit(vectors)
        self.single = self.units.astype(np.float32)
        self.singles = self.single[nodes["centre"]]
        # columns of their own, as pairs of nodes are many more than nodes
        self.start, self.end, self.centre, self.first, self.last, self.radius = (np.ascontiguousarray(nodes[c]) for c, _ in _TREE)
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.sums = np.concatenate([[0], np.cumsum(copies)])


def _by_radius(block: Block, first: int, last: int):
    """Nodes in runs of like radius, each with the largest radius in it."""
    order = first + np.argsort(block.radius[first:last], kind="stable")
    radius = block.radius[order]
    cuts = np.searchsorted(radius, [0, 0.05, 0.1, 0.2, 0.4, 0.8, 2.1], "right")
    for lo, hi in zip([0, *cuts], cuts):
        for at in range(lo, hi, 1024):
            yield order[at:min(at + 1024, hi)], radius[hi - 1]


def _far(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def _centres_apart(a: Block, b: Block, first_a, last_a, first_b, last_b):
    """(i, j, least and most that their centres may be apart) of the crossed nodes; wide rows by a matrix
    product in single precision, and of those only nodes that their radii don't keep apart."""
    wide = (last_a - first_a) * (last_b - first_b) > 4096
    for k in np.flatnonzero(wide):
        for u, r in _by_radius(a, first_a[k], last_a[k]):
            for v, t in _by_radius(b, first_b[k], last_b[k]):
                most = np.minimum(2.0, a.theta + r + t)
                cosine = (a.singles[u] @ b.singles[v].T).ravel()
                at = np.flatnonzero(cosine >= np.float32(1 - most * most / 2 - SINGLE))
                cosine = cosine[at].astype(float)
                yield u[at // len(v)], v[at % len(v)], _far(cosine + SINGLE), _far(cosine - SINGLE)
    for i, j in _in_parts(first_a[~wide], last_a[~wide], first_b[~wide], last_b[~wide]):
        far = _far(np.einsum("ij,ij->i", a.units[a.centre[i]], b.units[b.centre[j]]))
        yield i, j, far, far


class Links:
    """Links of the vectors of two blocks: how many each has, and the groups that they join."""

    def __init__(self, a: Block, b: Block, cosine: float):
        self.a, self.b, self.cosine = a, b, cosine
        self.counts = [np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)]
        self.edges: list[np.ndarray] = []
        self.near: np.ndarray | None = None

    def whole(self, a_lo, a_hi, b_lo, b_hi):
        """Ranges whose every pair links: counts by differences, edges that only join them."""
        for side, lo, hi, weight in (
            (0, a_lo, a_hi, self.b.sums[b_hi] - self.b.sums[b_lo]), (1, b_lo, b_hi, self.a.sums[a_hi] - self.a.sums[a_lo])
        ):
            change = np.zeros(len(self.counts[side]) + 1, np.int64)
            np.add.at(change, lo, weight)
            np.add.at(change, hi, -weight)
            self.counts[side] += np.cumsum(change)[:-1]
        one = np.arange(len(a_lo))
        for lo, hi, first_b in ((a_lo, a_hi, True), (b_lo, b_hi, False)):
            row = np.repeat(one, hi - lo)
            at = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
            pair = (at, b_lo[row]) if first_b else (a_lo[row], at)
            self.edges.append(np.stack(pair, 1))

    def checked(self, i, j):
        """Pairs of vectors: those that reach the cosine, in double precision (single precision only shortlists)."""
        a, b = self.a, self.b
        if self.near is None and len(i) * MANY > len(a.ids) * len(b.ids):
            self.near = a.single @ b.single.T >= np.float32(self.cosine - SINGLE)
        if self.near is not None:
            short = self.near[i, j]
            i, j = i[short], j[short]
        cosine = np.einsum("ij,ij->i", a.vectors[i], b.vectors[j]) / (a.norms[i] * b.norms[j])
        hit = cosine >= self.cosine
        i, j = i[hit], j[hit]
        np.add.at(self.counts[0], i, b.copies[j])
        np.add.at(self.counts[1], j, a.copies[i])
        self.edges.append(np.stack([i, j], 1))


def traverse(a: Block, b: Block, cosine: float, same: bool) -> Links:
    """All links between two blocks, or within one (``same``, where each ordered pair is met)."""
    found, theta = Links(a, b, cosine), a.theta
    p, q = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(p):
        next_p, next_q = [], []
        first_p, last_p, first_q, last_q = a.first[p], a.last[p], b.first[q], b.last[q]
        inner_x, inner_y, wide_x, wide_y = last_p > first_p, last_q > first_q, a.radius[p], b.radius[q]
        # the wider of the two opens, or both when one is not much wider
        open_x = inner_x & (~inner_y | (wide_x >= wide_y / 2))
        open_y = inner_y & (~inner_x | (wide_y >= wide_x / 2))
        done = ~open_x & ~open_y
        for i, j in _in_parts(a.start[p[done]], a.end[p[done]], b.start[q[done]], b.end[q[done]]):
            keep = i != j if same else slice(None)
            found.checked(i[keep], j[keep])
        more = ~done
        bounds = [
            np.where(open_x, first_p, p)[more], np.where(open_x, last_p, p + 1)[more],
            np.where(open_y, first_q, q)[more], np.where(open_y, last_q, q + 1)[more],
        ]
        for i, j, least, most in _centres_apart(a, b, *bounds):
            reach = a.radius[i] + b.radius[j]
            near = least <= theta + reach + SLACK
            inside = near & (most + reach < theta - SLACK)
            if same:
                inside &= i != j
            if inside.any():
                u, v = i[inside], j[inside]
                found.whole(a.start[u], a.end[u], b.start[v], b.end[v])
            next_p.append(i[near & ~inside])
            next_q.append(j[near & ~inside])
        p, q = (np.concatenate(w) if w else np.zeros(0, np.int64) for w in (next_p, next_q))
    return found


def _packer(dimension: int):
    """One block's rows to one row: ids, copies, vectors in the order of their cover tree, the tree, and how far from its centre they lie."""

    def pack(table: pa.Table) -> pa.Table:
        ids, copies = (np.array(table.column(k)).astype(np.int64) for k in ("vec_id", "copies"))
        vectors = np.array(table.column("vector").combine_chunks().flatten()).reshape(-1, dimension)
        by_id = np.argsort(ids)
        ids, copies, vectors = ids[by_id], copies[by_id], vectors[by_id]
        order, nodes = cover_tree(unit(vectors))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        nodes["centre"] = place[nodes["centre"]]
        return pa.table(
            {
                "block": table.column("block")[:1], "node": table.column("node")[:1],
                "radius": pa.array([float(np.array(table.column("far")).max())]),
                "ids": pa.array([ids[order].tobytes()]), "copies": pa.array([copies[order].tobytes()]),
                "vectors": pa.array([vectors[order].tobytes()]), "nodes": pa.array([nodes.tobytes()]),
            }
        )

    return pack


def _found(a: Block, b: Block, cosine: float) -> pa.RecordBatch | None:
    """(vec_id, links, label) of the vectors of two blocks, or of one, that link; nothing where none do."""
    same = a is b
    found = traverse(a, b, cosine, same)
    if same:  # each pair was met from both of its ends, so one side has it all
        ids, counts = a.ids, found.counts[0]
        edges = np.concatenate(found.edges) if found.edges else np.zeros((0, 2), np.int64)
    else:
        ids, counts = np.concatenate([a.ids, b.ids]), np.concatenate(found.counts)
        edges = np.concatenate(found.edges) + [0, len(a.ids)] if found.edges else np.zeros((0, 2), np.int64)
    has = counts > 0
    if not has.any():
        return None
    by_id = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[by_id] = np.arange(len(ids))
    label = ids[by_id][smallest(rank[edges], len(ids))][rank]
    return pa.RecordBatch.from_arrays([pa.array(x[has]) for x in (ids, counts, label)], names=["vec_id", "links", "label"])


def _linker(path: str, dimension: int, kind: type, cosine: float):
    """Over (block, partners): the links of each block with its partners, which are read from ``path``."""

    def link(batches):
        files, root = file_system(path)

        def read(block: int) -> Block:
            there = ds.dataset(f"{root}/block={block}", filesystem=files, format="parquet")
            row = there.to_table(columns=["ids", "copies", "vectors", "nodes"], use_threads=False).to_pylist()[0]
            return Block(
                np.frombuffer(row["ids"], np.int64), np.frombuffer(row["copies"], np.int64),
                np.frombuffer(row["vectors"], kind).reshape(-1, dimension).astype(float), np.frombuffer(row["nodes"], _TREE), cosine,
            )

        for batch in batches:
            for block, partners in zip(*(c.to_pylist() for c in batch.columns)):
                a = read(block)
                for partner in partners:
                    found = _found(a, a if partner == block else read(partner), cosine)
                    if found is not None:
                        yield found

    return link


def _partners(numbers: np.ndarray, nodes: np.ndarray, radii: np.ndarray, centres: np.ndarray, theta: float, most: int):
    """Over the places of blocks: (block, partners), ``most`` at once of the blocks from itself on that radii don't keep apart from it."""

    def pair(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                apart = np.sqrt(np.maximum(2 - 2 * centres[nodes[k:]] @ centres[nodes[k]], 0))
                meet = numbers[k:][apart <= radii[k:] + radii[k] + theta + SLACK]
                runs = [meet[lo:lo + most].tolist() for lo in range(0, len(meet), most)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(numbers[k])] * len(runs), pa.int32()), pa.array(runs, pa.list_(pa.int32()))], names=["block", "partners"]
                )

    return pair


def _nearest(vectors: pa.Array, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centre nearest to each vector, and how far it is."""
    near = unit(np.array(vectors.flatten()).astype(float).reshape(len(vectors), -1)) @ centres.T
    node = near.argmax(axis=1)
    return node.astype(np.int32), np.sqrt(np.maximum(2 - 2 * near[np.arange(len(node)), node], 0))


def _counter(centres: np.ndarray):
    """Over (vector): how many vectors are nearest to each centre."""

    def count(batches):
        n = np.zeros(len(centres), np.int64)
        for batch in batches:
            if batch.num_rows:
                n += np.bincount(_nearest(batch.column(0), centres)[0], minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n)], names=["node", "n"])

    return count


def _dealer(centres: np.ndarray):
    """Over (vec_id, copies, vector): the same rows with their nearest centre, and how far it is."""

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                node, far = _nearest(batch.column(2), centres)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node), pa.array(far)], names=["vec_id", "copies", "vector", "node", "far"])

    return deal


def _links(classes: DataFrame, dimension: int, cosine: float) -> DataFrame:
    """(vec_id, links, label): links of every class to others, and what block pairs join."""
    spark, n = classes.sparkSession, classes.count()
    most = max(1, min(CENTRES, math.ceil(n / BLOCK)))
    sample = classes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("vector").collect()
    centres = unit(np.array([r[0] for r in sample], float).reshape(-1, dimension)) if sample else np.zeros((0, dimension))
    vector = classes.schema["vector"].dataType
    # dealt once to count and once more into blocks, which takes less than to store vectors for it; a vector as near to
    # two centres may go to either, so every centre may have a block, and blocks tell their radii
    counts = classes.select("vector").mapInArrow(_counter(centres), "node int, n long").groupBy("node").agg(F.sum("n")).collect()
    counts = dict(map(tuple, counts))
    parts = [max(1, math.ceil(counts.get(node, 0) / BLOCK)) for node in range(len(centres))]
    parts = [(node, sum(parts[:node]), here) for node, here in enumerate(parts)]
    parts = spark.createDataFrame(parts, "node int, first int, parts int")
    dealt = classes.select("vec_id", "copies", "vector").mapInArrow(
        _dealer(centres), f"vec_id long, copies long, vector {vector.simpleString()}, node int, far double"
    )
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("block")
    blocks = dealt.join(F.broadcast(parts), "node").select(block, "node", "far", "vec_id", "copies", "vector")
    kind = "block int, node int, radius double, ids binary, copies binary, vectors binary, nodes binary"
    path = written(blocks.groupBy("block").applyInArrow(_packer(dimension), kind), "blocks", "block")
    # one row for each block, some thousands of vectors
    blocks = spark.read.parquet(path).select("block", "node", "radius").orderBy("block").collect() if sample else []
    numbers, nodes = (np.array([r[c] for r in blocks], np.int32) for c in ("block", "node"))
    theta = math.sqrt(max(0.0, 2 - 2 * cosine))
    # rows of a few numbers stand for much work, so how many tasks they make goes by pairs, and by cores where pairs are few
    cores, pairs = spark.sparkContext.defaultParallelism, max(1, len(blocks) * (len(blocks) + 1) // 2)
    tasks, most = min(pairs, max(4 * cores, pairs // PAIRS)), max(1, min(PARTNERS, pairs // (8 * cores)))
    pair = _partners(numbers, nodes, np.array([r["radius"] for r in blocks]), centres, theta, most)
    met = spark.range(len(blocks)).mapInArrow(pair, "block int, partners array<int>")
    number = np.float32 if vector.elementType == T.FloatType() else np.float64
    return met.repartition(tasks).mapInArrow(_linker(path, dimension, number, cosine), "vec_id long, links long, label long")


def _no_links(classes: DataFrame) -> DataFrame:
    return classes.limit(0).select(*[F.lit(0).cast("long").alias(c) for c in ("vec_id", "links", "label")])


def _digest() -> list:
    """Two 64-bit hashes, which tell vectors apart where rows find their class."""
    return [F.xxhash64("vector").alias("one"), F.xxhash64(F.lit(1), "vector").alias("two")]


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, ...).

    Two vectors link when their cosine in double precision is at least ``cosine`` (over 0).

    * Null or zero vectors, and those with null, NaN or infinite components: linked with nothing, kept.
    * Vectors of different lengths (numbers of components) are not linked.
    * Null vec_id: linked with nothing, component null, kept.
    * Rows that repeat a vec_id count as vectors of their own in ``n_links``, and are one in components.
    * Other columns are ignored; an empty table gives no rows.
    """
    # single precision is kept as it is, which is half of what doubles of the same values take
    kind = vectors.schema["embedding"].dataType
    kind = kind if isinstance(kind, T.ArrayType) and kind.elementType == T.FloatType() else T.ArrayType(T.DoubleType())
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(sound & F.exists("vector", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    classes = rows.where(sound).groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # numbered once, as a vec_id may have several vectors
    classes = stored(classes.select(F.monotonically_increasing_id().alias("number"), "rep", "copies", "vector"), "classes")
    names = stored(classes.select("number", "rep", "copies", *_digest()), "names")
    # vectors have a cosine with those of their own length only; a table has few lengths, one for each model
    lengths = [r["d"] for r in classes.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect()]
    numbered = classes.select(F.col("number").alias("vec_id"), "copies", "vector")
    found = [_links(numbered.where(F.size("vector") == d), d, cosine) for d in lengths]
    links = reduce(DataFrame.unionAll, found, _no_links(classes))
    links = stored(links, "links")
    counts = stored(links.groupBy("vec_id").agg(F.sum("links").alias("links")), "counts").withColumnRenamed("vec_id", "number")
    members = rows.where(sound).select("vec_id", *_digest()).join(names, ["one", "two"]).select("vec_id", "number", "rep", "copies")
    members = stored(members, "members")
    names = names.select("number", "rep")
    joined = links.select("vec_id", "label").distinct().join(names.toDF("vec_id", "u"), "vec_id").join(names.toDF("label", "v"), "label")
    group = components(
        joined.select("u", "v").union(members.select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    ).withColumnRenamed("node", "vec_id")
    linked = members.join(counts, "number", "left").select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    out = linked.unionAll(rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links")))
    component = F.coalesce("component", "vec_id")
    return out.join(group, "vec_id", "left").select(
        "vec_id", "n_links", component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: x * x), 'sum') > 0
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT reach.u, link.v FROM reach JOIN link ON link.u = reach.v
), least AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u),
n AS (SELECT u AS vec_id, count(*) AS n_links FROM link GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""
