"""Mixing sources to target weights, by a min-cost flow.

Documents are summed by membership pattern, the set of sources that they belong to.  Words flow from
patterns to the quotas of their sources; a pattern's words cost nothing the first time and more with
every repetition, so nothing is repeated while words of the same reach lie unused.  The flow says how
many words each pattern gives; documents are then taken in the order of a seeded hash up to that
number, found by histograms of the hash rather than by sorting a pattern's documents.
"""

from __future__ import annotations

from collections import deque
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import stored

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2, 10
#: Bits of the hash that one histogram cuts by, and histograms before documents are looked at.
BITS, LEVELS = 10, 2
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess is shared again."""
    out, open_, left = {}, sorted(sizes, key=lambda s: (s is None, s)), total
    while open_:
        rate = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if rate * weights[s] > most * sizes[s]]
        if not full:
            return out | {s: rate * weights[s] for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
        left = max(left, 0.0)
    return out


def flow(capacity: dict, quotas: dict, most: int) -> dict:
    """Words taken of every pattern's first, second, ... copies: {pattern: [first, second, ...]}.

    The cheapest largest flow from patterns (sets of sources, with their words) to quotas, where the
    k-th copy of a word costs k - 1: copies open in turn, and within each the flow is augmented along
    shortest paths, which may move words already given between the sources of a pattern.
    """
    given = {(p, s): 0 for p in capacity for s in p}
    need, taken = {s: round(q) for s, q in quotas.items()}, {p: [0] * most for p in capacity}
    holders: dict = {}
    for p, s in given:
        holders.setdefault(s, []).append(p)
    for copy in range(most):
        free = dict(capacity)
        while True:
            came: dict = {("p", p): None for p in capacity if free[p] > 0}
            queue, end = deque(came), None
            while queue and end is None:
                side, at = queue.popleft()
                steps = [("s", s) for s in sorted(at, key=str)] if side == "p" else [("p", p) for p in holders[at] if given[p, at] > 0]
                for step in steps:
                    if step not in came:
                        came[step] = (side, at)
                        if step[0] == "s" and need.get(step[1], 0) > 0:
                            end = step
                            break
                        queue.append(step)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            back = [given[path[k + 1][1], path[k][1]] for k in range(1, len(path) - 1, 2)]
            amount = min([free[path[0][1]], need[end[1]], *back])
            for k in range(len(path) - 1):
                if path[k][0] == "p":
                    given[path[k][1], path[k + 1][1]] += amount
                else:
                    given[path[k + 1][1], path[k][1]] -= amount
            free[path[0][1]] -= amount
            need[end[1]] -= amount
            taken[path[0][1]][copy] += amount
    return taken


def _name(sources: str) -> Column:
    """A pattern as text, nulls included."""
    return F.to_json(sources)


def _chosen(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """``rows`` (rid, pattern, size, u) that fill the quotas (pattern, quota), nearest from either side.

    Histograms of the hash, finer level by level, find the place where each pattern's quota ends; the
    few documents of the last bucket are added up one by one.  Then one document more or less is
    taken where that comes nearer to the quota.
    """
    rows = rows.join(F.broadcast(quotas), F.col("pattern") == F.col("of"))
    spot = rows.select("rid", "pattern", "size", "u", "quota", F.lit(0).cast("long").alias("before"))
    taken = []
    for level in range(LEVELS):
        bucket = F.shiftrightunsigned("u", 64 - BITS * (level + 1)).bitwiseAND((1 << BITS) - 1).cast("int")
        spot = stored(spot.withColumn("bucket", bucket), "spot")
        sums = spot.groupBy("pattern", "bucket", "quota", "before").agg(F.sum("size").alias("sum"))
        upto = F.sum("sum").over(Window.partitionBy("pattern").orderBy("bucket"))
        sums = sums.withColumn("upto", F.col("before") + upto)
        cut = stored(sums.where("upto > quota").groupBy("pattern").agg(
            F.min("bucket").alias("cut"), F.min_by(F.col("upto") - F.col("sum"), "bucket").alias("below")
        ), "cuts")
        spot = spot.join(F.broadcast(cut), "pattern", "left")
        taken.append(spot.where("cut is null or bucket < cut").select("rid", "pattern", "size"))
        spot = spot.where("bucket = cut").select("rid", "pattern", "size", "u", "quota", F.col("below").alias("before"))
    upto = F.sum("size").over(Window.partitionBy("pattern").orderBy("u", "rid").rowsBetween(Window.unboundedPreceding, 0))
    last = spot.withColumn("upto", F.col("before") + upto).where("upto <= quota").select("rid", "pattern", "size")
    for part in taken:
        last = last.unionAll(part)
    return stored(last, "taken")


def _nearest(rows: DataFrame, taken: DataFrame, quotas: DataFrame) -> DataFrame:
    """``taken`` after one more document of each pattern, the one that comes nearest to what is missing."""
    sums = taken.groupBy("pattern").agg(F.sum("size").alias("sum"))
    gap = quotas.join(sums, F.col("of") == F.col("pattern"), "left")
    gap = gap.select("of", (F.col("quota") - F.coalesce("sum", F.lit(0))).alias("gap"))
    rest = rows.join(taken.select("rid"), "rid", "left_anti").join(F.broadcast(gap), F.col("pattern") == F.col("of"))
    rest = rest.where("size > 0 and abs(gap - size) < gap")
    best = rest.groupBy("pattern").agg(F.min_by(F.struct("rid", "size"), F.struct(F.abs(F.col("gap") - F.col("size")), "u", "rid")).alias("b"))
    return taken.unionAll(best.select("b.rid", "pattern", "b.size"))


def mixed(
    docs: DataFrame, membership: Column | None = None, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """(rid, u, doc_id, size, sources, source_size, target, copies) for every row of ``docs``.

    ``docs`` has doc_id, text and source, or whatever ``membership`` makes its array of sources of.
    ``size`` is the number of words ``[^ \\t-\\r]+``.  Sources in the order of their code points, null
    last, weigh ``weights``, repeating, and share ``share`` times all words; none more than ``most``
    times its own.  ``source_size`` and ``target`` are sums over the row's sources.  ``copies`` times a
    document is taken whole, 0 to ``most``.

    * Null, empty or blank text: size 0, never taken.  Null source, or none: a source of its own.
    * Null doc_id and repeated rows: rows like others; rows equal in id, sources and text come together
      in the seeded order.
    * Sources and patterns, one row each, are what the driver sees.  Other columns are ignored.
    """
    member = F.array("source") if membership is None else membership
    member = F.coalesce(F.array_sort(F.array_distinct(member)), F.array(F.lit(None).cast("string")))
    member = F.when(F.size(member) == 0, F.array(F.lit(None).cast("string"))).otherwise(member)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.transform(member, lambda s: s.cast("string")).alias("sources"),
        F.xxhash64(F.lit(seed), "doc_id", member, F.col("text").cast("string")).alias("u"),
    )
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "sizes")
    patterns = rows.groupBy("sources").agg(F.sum("size").alias("size")).collect()
    capacity = {tuple(r["sources"]): r["size"] for r in patterns}
    order = sorted({s for p in capacity for s in p}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for p, n in capacity.items() if s in p) for s in order}
    weight = {s: Fraction(weights[k % len(weights)]) for k, s in enumerate(order)}
    # a word that several sources have counts for all of them, and once for the whole
    goal = targets(sizes, {s: float(w) for s, w in weight.items()}, share * sum(capacity.values()), most)
    plan = flow(capacity, goal, most)
    copies = None
    narrow = rows.select("rid", _name("sources").alias("pattern"), "size", "u")
    for copy in range(most):
        asked = [(list(p), float(n[copy])) for p, n in plan.items() if n[copy]]
        quotas = docs.sparkSession.createDataFrame(asked, "sources array<string>, quota double")
        quotas = quotas.select(_name("sources").alias("of"), "quota")
        some = _nearest(narrow, _chosen(narrow, quotas), quotas).select("rid", F.lit(1).alias("copies"))
        copies = some if copies is None else copies.unionAll(some)
    copies = copies.groupBy("rid").agg(F.sum("copies").alias("copies"))
    of_pattern = [(list(p), sum(sizes[s] for s in p), float(sum(goal[s] for s in p))) for p in capacity]
    info = docs.sparkSession.createDataFrame(of_pattern, "of array<string>, source_size long, target double")
    info = info.withColumn("of", _name("of"))
    return (
        rows.join(copies, "rid", "left").join(F.broadcast(info), _name("sources") == F.col("of"))
        .select("rid", "u", "doc_id", "size", "sources", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"))
    )


def taken(docs: DataFrame, **parameters) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words that the mix takes of every row."""
    return mixed(docs, **parameters).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mix(docs: DataFrame, seed: int = SEED, **parameters) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, ...), all columns, as often as the mix takes them.

    Rows equal in id, source and text are all taken as often as the one of them taken least.
    """
    plan = mixed(docs, seed=seed, **parameters).groupBy("u").agg(F.min("copies").alias("__copies"))
    member = F.array(F.col("source").cast("string"))
    u = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), member, F.col("text").cast("string"))
    found = docs.withColumn("__u", u).join(plan.where("__copies > 0").withColumnRenamed("u", "__u"), "__u")
    return found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(docs.columns)
