"""The prefix trie of conversations: which share their first turns, and what sharing them saves.

Turns get dictionary ids, so a conversation is a row of numbers.  Distinct rows are dealt by range, so each
shard holds neighbours of the trie's order and builds a ternary search tree of them.  Only the nodes on the
paths of a shard's first and last rows can stand in other shards too; those are merged afterwards.
"""

from __future__ import annotations

import hashlib
import math
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import stored
from tidemark.operators.joins import join_aggregated

WORDS = r"[^\x20\x09-\x0D]+"
FAMILY = 20  # conversations that begin with turns of the same one
HEAD = 4  # below how many of them
SHARD = 200_000  # nodes of a search tree, about
ID_BLOCK = 16  # bits of a conversation's id within which members are listed together
NO_ENDS = hashlib.sha256(b"").hexdigest()

PIECES = (
    "shard int, side int, counted boolean, key binary, parent_key binary, depth long, words long, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"
)


class SearchTree:
    """A ternary search tree over rows of ids.  Node 0 is the root; as a link, 0 leads nowhere.

    ``eq`` leads to the next place of a row, ``lo`` and ``hi`` to smaller and larger ids of the same place.
    ``parent`` is the node of the place before; a node comes after its parent.
    """

    def __init__(self) -> None:
        self.ids, self.lo, self.hi, self.eq = [-1], [0], [0], [0]
        self.parent, self.depth, self.words = [0], [0], [0]

    def _new(self, x: int, parent: int, words: int) -> int:
        self.ids.append(x)
        for link in (self.lo, self.hi, self.eq):
            link.append(0)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.words.append(words)
        return len(self.ids) - 1

    def insert(self, row: Sequence[int], words: Sequence[int]) -> int:
        """The node at which the row ends."""
        ids, at = self.ids, 0
        for place, x in enumerate(row):
            link, owner = self.eq, at
            while (node := link[owner]) and ids[node] != x:
                link, owner = (self.lo if x < ids[node] else self.hi), node
            if not node:
                node = link[owner] = self._new(x, at, words[place])
            at = node
        return at

    def path(self, node: int) -> list[int]:
        """From the root to the node."""
        out = [node]
        while node:
            node = self.parent[node]
            out.append(node)
        return out[::-1]


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every range before what is left and right of it."""
    waiting = deque([(0, n)])
    while waiting:
        low, high = waiting.popleft()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(low, middle), (middle + 1, high)]


def _shard_rows(number: int, rows: list[tuple]) -> dict[str, list]:
    """PIECES of the sorted, distinct (ids, words, conv_id, n, ends)."""
    tree, end_of = SearchTree(), [0] * len(rows)
    for k in medians(len(rows)):
        end_of[k] = tree.insert(rows[k][0], rows[k][1])
    size = len(tree.ids)
    members, first, ends = [0] * size, [None] * size, [None] * size
    for node, (_, _, conv, n, listed) in zip(end_of, rows):
        members[node], first[node], ends[node] = n, conv, listed
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    paths = [tree.path(end_of[0]), tree.path(end_of[-1])]
    shared = {node for path in paths for node in path}
    for node in reversed(range(1, size)):  # every node before its parent
        up = tree.parent[node]
        members[up] += members[node]
        if first[up] is None or first[node] < first[up]:
            first[up] = first[node]
        if node not in shared:  # what a shared node adds to those above it is known after merging
            children[up] += 1
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * tree.words[node]
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    keys = {}
    for path in paths:
        key = b""
        for node in path:
            key = keys[node] = hashlib.blake2b(key + tree.ids[node].to_bytes(8, "big", signed=True), digest_size=16).digest()
    out = {name.split()[0]: [] for name in PIECES.split(", ")}

    def emit(node: int, side: int | None, counted: bool) -> None:
        up = tree.parent[node]
        whole = {"n_convs": members, "n_children": children, "n_leaves": leaves, "saved": saved}
        row = {name: values[node] if counted else 0 for name, values in whole.items()} | {
            "shard": number, "side": side, "counted": counted, "key": keys.get(node), "depth": tree.depth[node],
            "words": tree.words[node], "conv_id": first[node] if counted else None, "ends": ends[node],
            "parent_key": keys.get(up) if node else None,
            "parent_conv_id": first[up] if side is None and up not in shared else None,
        }
        for name, value in row.items():
            out[name].append(value)

    for node in range(size):
        if node not in shared:
            emit(node, None, True)
    seen = set()
    for side, path in enumerate(paths):
        for node in path:
            emit(node, side, node not in seen)
            seen.add(node)
    return out


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows += zip(*(batch.column(name).to_pylist() for name in ("ids", "words", "conv_id", "n", "ends")))
    if not rows:
        return
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in PIECES.split(", "))])
    found = pa.table(_shard_rows(TaskContext.get().partitionId(), rows), schema)
    yield from found.to_batches(max_chunksize=10_000)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, conv_id, n, ends) of rows (key, first, n, listed) in the order of their ids: the lists pass, never a whole one."""
    key, smallest, n, digest = None, None, 0, None
    names = ["key", "conv_id", "n", "ends"]

    def table(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    for batch in batches:
        done = []
        for k, conv, count, listed in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if key is not None:
                    done.append((key, smallest, n, digest.hexdigest()))
                key, smallest, n, digest = k, conv, 0, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(listed.encode())
            n += count
        if done:
            yield table(done)
    if key is not None:
        yield table([(key, smallest, n, digest.hexdigest())])


def encoded(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, id, words): the turns with their numbers in a dictionary of (role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    spoken = messages.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    spoken = stored(spoken, "spoken")
    numbers = stored(
        spoken.select("digest").distinct().select("digest", F.monotonically_increasing_id().alias("id")), "dictionary"
    )
    return spoken.join(numbers, "digest")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, words) of every conversation: the first h turns of its family's first, then its own after h.

    The family's first is ``conv_id - conv_id % 20``, h is the unsigned crc32 of the decimal id modulo 4.
    """
    base = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    said = F.sort_array(F.collect_list(F.struct("turn", "digest", "id", "words")))
    own = turns.select(base, "*").repartition("base").groupBy("base", "conv_id").agg(said.alias("said"))
    own = own.withColumn("said", F.transform("said", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))))
    head = F.when(F.col("conv_id") == F.col("base"), F.slice("said", 1, HEAD - 1))
    head = F.first(head, ignorenulls=True).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    own = own.select("conv_id", "said", F.coalesce(head, F.slice("said", 1, 0)).alias("head"), h.alias("h"))
    rest = F.slice("said", F.col("h") + 1, F.size("said") + 1)
    whole = own.select("conv_id", F.concat(F.slice("head", F.lit(1), F.col("h")), rest).alias("said"))
    return whole.select("conv_id", F.col("said.id").alias("ids"), F.col("said.words").alias("words"))


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``conversations`` (conv_id, ids, words) has one row per conversation: the dictionary ids of its turns, not
    their texts, so 16 bytes a turn.
    """
    name = F.unhex(F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")))
    whole = stored(conversations.select("conv_id", name.alias("key"), "ids", "words"), "rebuilt")
    # equal conversations are one row of the tree; their members are listed in blocks of ids, and only then together
    block = F.shiftright("conv_id", ID_BLOCK).alias("block")
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    members = whole.select("key", "conv_id").groupBy("key", block).agg(
        F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"), listed.alias("listed")
    )
    members = members.repartition("key").sortWithinPartitions("key", "block").select("key", "first", "n", "listed")
    ends = members.mapInArrow(_hash_ends, "key binary, conv_id long, n long, ends string")
    rows = stored(ends.select("conv_id", "n", "ends").join(whole.select("conv_id", "ids", "words"), "conv_id"), "rows")
    size = rows.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = rows.repartitionByRange(max(1, math.ceil(size / SHARD)), "ids").sortWithinPartitions("ids")
    pieces = stored(shards.mapInArrow(_build, PIECES), "pieces")
    shared = stored(_merged(pieces), "shared")
    inner = pieces.where("side is null")
    above = pieces.where("side is not null and counted").select("shard", "key")
    above = join_aggregated(above, shared.select("key", F.col("conv_id").alias("above")), ["key"], "inner")
    below = inner.where("parent_key is not null").withColumnRenamed("key", "own").withColumnRenamed("parent_key", "key")
    below = below.join(above, ["shard", "key"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    out = inner.where("parent_key is null").select(columns)
    out = out.unionByName(below.withColumn("parent_conv_id", F.col("above")).select(columns))
    parents = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = out.unionByName(join_aggregated(shared, parents, ["parent_key"], "left").select(columns))
    return out.select(
        *columns[:-2], F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    )


def _merged(pieces: DataFrame) -> DataFrame:
    """The nodes on the edges of shards, each once, with what lies below them in every shard."""
    paths = pieces.where("side is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    same = [F.first(c).alias(c) for c in ("parent_key", "depth", "words")]
    nodes = paths.groupBy("key").agg(
        *same, *sums, F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"),
        F.min(F.struct("shard", "side")).alias("home"),
    )
    kids = nodes.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    nodes = nodes.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    nodes = stored(nodes.drop("kids"), "edges")
    # every node adds what it has and what hangs below it in single shards to those above it, on one path that it lies on
    adds = nodes.select(
        "key", "home", ((F.col("n_convs") - 1) * F.col("words") + F.col("saved")).alias("own"),
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    steps = join_aggregated(paths.select("key", "shard", "side", "depth"), adds, ["key"], "inner")
    here = F.struct("shard", "side") == F.col("home")
    up = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select("key", *[F.sum(F.when(here, F.col(c)).otherwise(0)).over(up).alias(c) for c in ("own", "leaf")])
    total = steps.groupBy("key").agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    return nodes.join(total, "key").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", "n_children", F.col("leaf").alias("n_leaves"),
        F.col("own").alias("saved"), "ends",
    )


def prefixes(messages: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations of ``messages`` (conv_id, turn, role, text, ...).

    * Turns go by ``turn``, null first, ties by a digest of role and text; repeated rows are turns of their own.
    * Null role or text: empty.  Rows without conv_id belong to no conversation and are left out.
    * Conversations that have no turns once rebuilt are members of the root, and end there.
    * Other columns are ignored; an empty table has no nodes.

    Turns of equal 128-bit digests count as equal.  One conversation's ids are held together (not its texts),
    and the ids of equal conversations are hashed in order as they pass, by one task for each such group.
    """
    return trie(rebuilt(encoded(messages)))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, x, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS pos
  FROM (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
          md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x
        FROM conversations WHERE conv_id IS NOT NULL)
), bytes AS (
  SELECT conv_id, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])) AS b FROM (SELECT DISTINCT conv_id FROM t)
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(list_prepend(4294967295, b),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)))) % 4 AS h FROM bytes
), r AS (
  SELECT c.conv_id, x, words, pos FROM c JOIN t ON t.conv_id = c.base AND pos < h
  UNION ALL SELECT c.conv_id, x, words, pos FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h
), p AS (
  SELECT conv_id, words, row_number() OVER w AS depth, string_agg(x, '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM p GROUP BY ALL
), kids AS (
  SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), e AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path
), s AS (
  SELECT a.path, CAST(sum((d.n_convs - 1) * d.words) AS BIGINT) AS saved_tokens, count(*) FILTER (kids.path IS NULL) AS n_leaves
  FROM n a JOIN n d ON starts_with(d.path, a.path) LEFT JOIN kids ON kids.path = d.path GROUP BY a.path
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN kids USING (path) LEFT JOIN e USING (path)
  LEFT JOIN n up ON n.depth > 0 AND up.path = left(n.path, length(n.path) - 32)
"""
